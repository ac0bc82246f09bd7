"""Words that are new, known, or not held give the ids of the tokenizers library, and are stored many at once."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gaugeflow.llm import tokens


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
@pytest.mark.parametrize("held", [0, 40, 300_000])
def test_new_known_and_dropped_words(name, held, monkeypatch):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), tokens.Encoder(path, held)

    def one_by_one(*_):
        raise AssertionError("words are cut one by one")

    monkeypatch.setattr(np, "split", one_by_one)
    texts = ["", " ", "one two  two\n\nthree's", "été naïve 42 + 1042!?", "\t\tone\r\n", *(f"w{k}x{k * k} w{k % 7}" for k in range(1500))]
    for part in (texts, texts[:3], texts[::-1]):
        for text, ids in zip(part, own.encode(part), strict=True):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids
        assert len(own.at) <= held


SIGNS = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", "'é", " ", "  ", "\n", "\t\r\n", "a", "Re", "lL", "é", "ß", "Ɏ", "ª", "7", "42", "²", "¾", ",", "?!", "¡", "×", "s", "d", "e"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_any_order_of_signs(name):
    path = public_tokenizers.path(name)
    plain, own = Tokenizer.from_file(path), tokens.Encoder(path)
    draw = np.random.default_rng(11)
    texts = ["".join(draw.choice(SIGNS, draw.integers(0, 14))) for _ in range(6000)]
    texts += [a + b + c for a in SIGNS for b in SIGNS for c in SIGNS] + ["x\0y", "日本 it's", "<|endoftext|>'s"]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_a_word_is_looked_up_once_however_often_it_stands(name):
    own = tokens.Encoder(public_tokenizers.path(name))
    looked = []

    class Words(dict):
        def get(self, word, *rest):
            looked.append(word)
            return super().get(word, *rest)

    own.at = Words()
    own.encode(["of the people " * 500, "by the people " * 500])
    assert len(looked) < 20
