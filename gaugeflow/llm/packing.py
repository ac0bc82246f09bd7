"""Best-fit packing of documents into sequences, after a dominance reduction.

The plan is made from the histogram of piece lengths (at most as many rows as a sequence has tokens), so
it costs the same for any number of documents; the pieces then find their places by rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import materialise
from .common import read, whole_text
from .tokens import encoder, portions

#: Tokens of a sequence and the id put after each document.
LENGTH, END = 2048, 0

#: Pattern of equal sequences: how many there are, and (length, times) in the order of their offsets.
Pattern = tuple[int, list[tuple[int, int]]]


def reduce_by_dominance(counts: np.ndarray, room: int) -> list[Pattern]:
    """Fix the sets that dominate every other set around one of their items; lowers ``counts`` in place.

    For an item of length ``a`` the best single partner is the longest ``b`` that fits. The set dominates,
    so some best packing holds it, when (1) nothing fits beside ``a``; (2) ``a + b`` fills the sequence;
    (3) two more items never fit; (4) three never fit and no two that fit are longer than ``b``.
    Runs over the lengths, longest first, until a whole pass fixes nothing. Each step uses up a length, so
    there are never more patterns than lengths, however many items there are.
    """
    fixed: list[Pattern] = []
    changed = True
    while changed:
        changed = False
        for a in range(room, 0, -1):
            while counts[a]:
                have = np.flatnonzero(counts)
                free = room - a
                counts[a] -= 1
                fits = [int(x) for x in have if x <= free and counts[x] > 0]
                counts[a] += 1
                if not fits:
                    fixed.append((int(counts[a]), [(a, 1)]))
                    counts[a] = 0
                    changed = True
                    break
                b = fits[-1]
                small: list[int] = []
                for x in fits:
                    small += [x] * int(min(3 - len(small), counts[x] - (x == a)))
                    if len(small) == 3:
                        break
                pair = len(small) > 1 and small[0] + small[1] <= free
                triple = len(small) > 2 and sum(small) <= free
                if b != free and pair and (triple or _longest_pair(fits, counts, a, free) > b):
                    break
                # fewer items make no condition harder, so all pairs of these two lengths are fixed at once
                times = int(min(counts[a], counts[b])) if a != b else int(counts[a] // 2)
                counts[a] -= times
                counts[b] -= times
                fixed.append((times, [(a, 1), (b, 1)] if a != b else [(a, 2)]))
                changed = True
    return fixed


def _longest_pair(fits: list[int], counts: np.ndarray, a: int, free: int) -> int:
    """The largest sum of two items besides one ``a`` that is at most ``free``."""
    best, i, j = 0, 0, len(fits) - 1
    while i <= j:
        total = fits[i] + fits[j]
        single = i == j and counts[fits[i]] - (fits[i] == a) < 2
        if total <= free:
            best = best if single else max(best, total)
            i += 1
        else:
            j -= 1
    return best


def best_fit(counts: np.ndarray, room: int) -> list[Pattern]:
    """Longest first, each item into the fullest sequence that still takes it; equal sequences as one."""
    open_: dict[int, list[Pattern]] = {}
    rooms: list[int] = []
    done: list[Pattern] = []

    def put(times: int, runs: list[tuple[int, int]], left: int) -> None:
        if left == 0:
            done.append((times, runs))
        else:
            if left not in open_ or not open_[left]:
                open_[left] = []
                insort(rooms, left)
            open_[left].append((times, runs))

    for a in range(room, 0, -1):
        n = int(counts[a])
        while n:
            k = bisect_left(rooms, a)
            if k == len(rooms):
                times, runs, left = -(-n // (room // a)), [], room
            else:
                left = rooms[k]
                times, runs = open_[left].pop()
                if not open_[left]:
                    rooms.pop(k)
            each = left // a  # the sequence just filled is the fullest again
            many = min(times, n // each)
            if many:
                put(many, [*runs, (a, each)], left - each * a)
                n -= many * each
            if many < times and 0 < n < each:
                put(1, [*runs, (a, n)], left - n * a)
                many, n = many + 1, 0
            if many < times and runs:
                put(times - many, runs, left)
    return done + [p for left in rooms for p in open_[left]]


def plan(histogram: dict[int, int], room: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Places by rank: arrays ``(rank from, length, times, sequence from, offset)``, ranks counted over all
    pieces in ascending length."""
    counts = np.zeros(room + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    before = np.concatenate([[0], np.cumsum(counts)[:-1]])
    patterns = reduce_by_dominance(counts, room)
    patterns += best_fit(counts, room)
    rows, used, sequence = [], before.copy(), 0
    for n, runs in patterns:
        offset = 0
        for length, times in runs:
            rows.append((int(used[length]), length, times, sequence, offset))
            used[length] += n * times
            offset += length * times
        sequence += n
    rows.sort()
    return tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 5


def _cut(path: str, end: int, room: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stop = np.array([end], np.uint32)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in portions(texts):
                rows = []
                for key, ids in zip(keys[i:j], encoder(path).encode(texts[i:j])):
                    ids = np.concatenate([ids, stop])
                    for piece, start in enumerate(range(0, len(ids), room)):
                        part = ids[start : start + room]
                        rows.append((key, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes())))
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return run


def _place(slots: tuple[np.ndarray, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, length, times, sequence, offset = slots
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            k = np.searchsorted(first, rank, "right") - 1
            bin_, turn = np.divmod(rank - first[k], times[k])
            made = {"sequence_id": pa.array(sequence[k] + bin_), "offset": pa.array(offset[k] + turn * length[k])}
            keep = [c for c in batch.schema.names if c != "rank"]
            yield pa.record_batch([*[batch.column(c) for c in keep], *made.values()], names=[*keep, *made])

    return run


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pack(df: DataFrame, vocabulary: str, room: int = LENGTH, end: int = END, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    Every whole text (null: empty) is encoded, ``end`` put after it, and cut only if longer than ``room``.
    Rows that repeat a key are documents of their own; null keys are kept. An empty table gives no rows. A
    very long text is encoded whole and becomes many pieces.
    The plan sent to the tasks has a few numbers per length and pattern, so ``room`` bounds it.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    pieces = materialise(docs.mapInArrow(_cut(vocabulary, end, room), PIECES), "pieces")
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # ``room`` rows
    ranked = number_rows(pieces, ["length", "doc_id", "piece"], "rank").withColumn("rank", F.col("rank") - 1)
    placed = ranked.select(*pieces.columns, "rank")
    return placed.mapInArrow(_place(plan(histogram, room)), f"{PIECES}, sequence_id long, offset long")


def best_fit_packing(spark, sf: str) -> DataFrame:
    """Sequences of every whole text of ``documents``."""
    import public_tokenizers

    return pack(read(spark, sf, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))
