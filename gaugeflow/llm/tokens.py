"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker."""

from __future__ import annotations

import ctypes
import gc
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

# Signs below U+0250 whose class both regex engines agree on; a text with any other is encoded whole.
_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
_NUMBER = "0-9²³¹¼-¾"
_BLANK = "\\t-\\r\\x20"
_OTHER_SIGN = re.compile("[^\\t-\\r\\x20-\\x7e¡-ɏ]")
#: Classes of signs: white space, letters, digits, others, and the sign put behind each text (no text that is cut has it).
_SPACE, _LETTERS, _DIGITS, _OTHERS, _END = range(5)
_CLASS = np.full(0x250, _OTHERS, np.uint8)
for _kind, _signs in ((_SPACE, _BLANK), (_LETTERS, _LETTER), (_DIGITS, _NUMBER)):
    _CLASS[[k for k in range(0x250) if re.match(f"[{_signs}]", chr(k))]] = _kind
_CLASS[0] = _END
_ASCII = bytes(_CLASS[:128]) + bytes(128)

#: The sign put between words of each kind of vocabulary to encode many at once.
_BETWEEN = {"bytes": "\n", "words": " "}


def _cut(texts: list[str], kind: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The words of texts, encoded independently by the rule that stands in the file of a vocabulary:
    distinct words, the number of each word among them, and how many words each text has.

    "bytes": ``'s|'t|'re|'ve|'m|'ll|'d| ?L+| ?N+| ?O+|S+(?!\\S)|S+`` for letters, digits, others and white space;
    "words": the same endings, ``L+|N|O+``, and white space is left out.
    """
    data = "\0".join([*texts, ""]).encode()
    signs, c = np.frombuffer(data, np.uint8), np.frombuffer(bytearray(data.translate(_ASCII)), np.uint8)
    wide = np.flatnonzero(signs >= 0xC0)  # signs of two bytes, which get the class of the sign
    c[wide] = c[wide + 1] = _CLASS[((signs[wide].astype(np.int64) & 31) << 6) | (signs[wide + 1] & 63)]
    start = np.ones(len(c), bool)
    start[1:] = c[1:] != c[:-1]
    if kind == "bytes":
        start[1:] &= signs[:-1] != 32
        start[:-1] |= (c[:-1] == _SPACE) & (c[1:] != _SPACE) & (c[1:] != _END)
    else:
        start |= (c == _DIGITS) & (signs & 0xC0 != 0x80)
    short = np.flatnonzero(start & (signs == 39))
    signs = np.concatenate([signs, np.zeros(3, signs.dtype)])
    one, two = signs[short + 1], signs[short + 2]
    long_ = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
    length = np.where(long_, 3, np.where(np.isin(one, [ord(x) for x in "stmd"]), 2, 0))
    short, length = short[length > 0], length[length > 0]
    start[short + 1] = False
    start[(short + length)[c[short + length] == _LETTERS]] = True
    start |= c == _END
    edges = np.flatnonzero(start)
    offsets = np.append(edges, len(data))
    found = pa.LargeStringArray.from_buffers(len(edges), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
    ends = c[edges] == _END
    word = ~ends if kind == "bytes" else ~ends & (c[edges] != _SPACE)
    return found.dictionary.to_numpy(zero_copy_only=False).tolist(), found.indices.to_numpy()[word], np.diff(np.cumsum(word)[ends], prepend=0)


class Encoder:
    """Ids as ``Tokenizer.from_file(path).encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str, held: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.kind = "words" if any(t.endswith("</w>") for t in vocabulary) else "bytes"
        self.between = _BETWEEN[self.kind]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if (t.endswith("</w>") if self.kind == "words" else t == "Ċ")]] = True
        self.held = held
        self._clear()

    def _clear(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.used = np.zeros(1 << 20, np.uint32), 0
        self.start, self.size = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _store(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        """Hold new words, whose ids follow each other in ``ids``."""
        k, n, end = len(self.at), len(self.at) + len(words), self.used + len(ids)
        if n > len(self.start):
            self.start, self.size = np.resize(self.start, 2 * n), np.resize(self.size, 2 * n)
        if end > len(self.ids):
            self.ids = np.resize(self.ids, 2 * end)
        self.ids[self.used : end] = ids
        self.start[k:n], self.size[k:n] = self.used + np.cumsum(size) - size, size
        self.at.update(zip(words, range(k, n)))
        self.used = end

    def _store_whole(self, words: list[str]) -> None:
        if words:
            found = self.whole(words)
            self._store(words, np.concatenate(found), np.array([len(ids) for ids in found], np.int64))

    def _learn(self, words: list[str]) -> None:
        """Encode new words: many in one text, cut again where the sign between them shows."""
        joined = [w for w in words if not w.isspace()]
        if len(joined) < len(words):
            self._store_whole([w for w in words if w.isspace()])
        after = "" if self.kind == "words" else self.between
        for i in range(0, len(joined), 8192):
            part = joined[i : i + 8192]
            ids = np.concatenate(self.whole([self.between.join(part[k : k + 64]) + after for k in range(0, len(part), 64)]))
            marks = np.flatnonzero(self.ends[ids])
            if len(marks) != len(part):
                self._store_whole(part)
                continue
            size = np.diff(marks, prepend=-1)
            if after:
                ids, size = ids[~self.ends[ids]], size - 1
            self._store(part, ids, size)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain, views, rest = [], [], []
        for k, text in enumerate(texts):
            view = text.lower() if self.kind == "words" else text
            if _OTHER_SIGN.search(view) or any(s in text for s in self.special):
                rest.append(k)
                continue
            plain.append(k)
            views.append(view)
        for k, ids in zip(rest, self.whole([texts[k] for k in rest])):
            out[k] = ids
        words, of, counts = _cut(views, self.kind)
        found = np.fromiter(map(self.at.get, words, repeat(-1)), np.int64, len(words))
        missed = np.flatnonzero((found < 0) & (np.bincount(of, minlength=len(words)) > 0))
        new = [words[k] for k in missed.tolist()]
        keep, used = len(self.at) + len(new) <= self.held, self.used
        if new:
            self._learn(new)
            found[missed] = [self.at[w] for w in new]
        at = found[of]
        size = self.size[at]
        before = np.cumsum(size) - size
        flat = self.ids[np.repeat(self.start[at] - before, size) + np.arange(int(size.sum()))]
        place = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(counts)])]
        for k, a, b in zip(plain, place[:-1], place[1:]):
            out[k] = flat[a:b]
        if not keep:  # the words held first are the frequent ones and stay
            for word in new:
                del self.at[word]
            self.used = used
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def release() -> None:
    """Give the memory of this worker's encoders back, and what its tasks before have freed; for tasks of
    operators that do not encode. A worker process is used again by later stages and would hold it for good."""
    if _ENCODERS:
        _ENCODERS.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library keeps its own counsel
        pass


def portions(texts: list[str], limit: int = 1 << 20):
    """Index ranges of texts with about ``limit`` code points in all."""
    i = size = 0
    for j, text in enumerate(texts):
        size += len(text)
        if size >= limit:
            yield i, j + 1
            i, size = j + 1, 0
    if i < len(texts):
        yield i, len(texts)
