"""Language-model scores by context-tree weighting over bytes.

Each byte is eight binary decisions. For every context of 0..DEPTH bytes and every decision there is a
node with counts of zeros and ones; its Krichevsky-Trofimov estimate is mixed half and half with the
product of its children (one byte longer contexts). The tree is that of the whole training part, and a
text is scored under the mixture given those counts.

Texts lie in blocks of some tens of MB. A block sends each distinct n-gram once, in byte-plane payloads
keyed by the last two context bytes, so all that belongs to one subtree meets in one task; the answers
go back to the blocks the same way. Nothing that grows with the corpus is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .common import read, remainder, whole_text
from .hashing import LOWER, flat, mix, slices, span_hashes, words

#: Context bytes; an n-gram of one byte more fits a 64-bit key, the nearest context byte on top.
DEPTH = 5
BLOCK = 32 << 20
#: Bytes of texts whose n-grams are cut at once.
TEXTS = 2 << 20
#: Payloads per block and kind of key.
BUCKETS = 128
GRAM, TOKEN = 0, 1

_PACKED = "block long, bucket int, kind int, keys binary, counts binary"
_FIELDS = [("block", pa.int64()), ("bucket", pa.int32()), ("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]


def pack(values: np.ndarray) -> bytes:
    """Eight- or four-byte numbers as byte planes, compressed."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1)
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw.T).tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).reshape(-1)


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every byte of every row and of one end sign (0) per row; a row begins after zeros."""
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    spread = np.zeros(len(data) + DEPTH * (n + 1), np.uint8)
    spread[np.arange(len(data)) + DEPTH * (row + 1)] = data
    key = spread[DEPTH:].astype(np.uint64)
    for back in range(1, DEPTH + 1):
        key |= spread[DEPTH - back : len(spread) - back].astype(np.uint64) << np.uint64(8 * (DEPTH + 1 - back))
    own = np.arange(len(data)) + DEPTH * row
    end = offsets[1:] + DEPTH * np.arange(n)
    return np.concatenate([key[own], key[end]]), np.concatenate([row, np.arange(n)])


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, row) of every word, A-Z lower-cased."""
    starts, ends, row = words(data, offsets)
    return (span_hashes(LOWER[data], starts, ends) if len(starts) else np.zeros(0, np.uint64)), row


def _bucket(keys: np.ndarray, kind: int) -> np.ndarray:
    subtree = keys >> np.uint64(8 * (DEPTH - 1)) if kind == GRAM else keys
    return (mix(subtree) % np.uint64(BUCKETS)).astype(np.int64)


def united(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    k, c = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(k, kind="stable")
    k, c = k[order], c[order]
    first = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.zeros(0, np.int64)
    return k[first], np.add.reduceat(c, first) if len(k) else c


class Tally:
    """Distinct keys with counts, united whenever as much again has come in."""

    def __init__(self):
        self.keys, self.counts, self.held, self.after = [], [], 0, 1 << 20

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.keys.append(keys)
        self.counts.append(counts)
        self.held += len(keys)
        if self.held > self.after:
            self.close()
            self.after = 2 * self.held + (1 << 20)

    def close(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        k, c = united(self.keys, self.counts)
        self.keys, self.counts, self.held = [k], [c], len(k)
        return k, c


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    current, tallies = None, [Tally(), Tally()]

    def close():
        for kind, tally in enumerate(tallies):
            keys, counts = tally.close()
            bucket = _bucket(keys, kind)
            order = np.argsort(bucket, kind="stable")
            cut = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
            rows = [(current, b, kind, pack_keys(keys[order[i:j]]), pack(counts[order[i:j]])) for b, (i, j) in enumerate(zip(cut[:-1], cut[1:])) if j > i]
            if rows:
                yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], names=[f for f, _ in _FIELDS])

    for batch in batches:
        blocks = batch.column("block").to_numpy()
        data, offsets = flat(batch.column("text"))
        train = ~np.asarray(batch.column("held_out"), bool)
        turn = np.flatnonzero(np.diff(blocks)) + 1
        for a, b in zip([0, *turn], [*turn, len(blocks)]):
            if a == b:
                continue
            if current is not None and blocks[a] != current:
                yield from close()
                tallies = [Tally(), Tally()]
            current = int(blocks[a])
            for i, j in slices(offsets[a : b + 1], TEXTS):
                i, j = a + i, a + j
                part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
                for tally, (keys, row) in zip(tallies, (grams(part, at), tokens(part, at))):
                    learnt, n = np.unique(keys[train[i:j][row]], return_counts=True)
                    tally.add(learnt, n)
                    only = np.unique(keys[~train[i:j][row]])
                    tally.add(only, np.zeros(len(only), np.int64))
    if current is not None:
        yield from close()


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after seven steps up; x > 0."""
    shift = np.ones_like(x)
    for k in range(7):
        shift = shift * (x + k)
    z = x + 7
    return (z - 0.5) * np.log(z) - z + 0.9189385332046727 + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(shift)


def log_kt(n: np.ndarray) -> np.ndarray:
    """Krichevsky-Trofimov probability of ``n`` (rows of zeros, ones), as a natural logarithm."""
    return _log_gamma(n[:, 0] + 0.5) + _log_gamma(n[:, 1] + 0.5) - _log_gamma(n.sum(1) + 1.0) - np.log(np.pi)


def _node(keys: np.ndarray, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """The node of decision ``step`` (0..7) of each n-gram at a depth, and the bit decided there."""
    symbol = keys & np.uint64(255)
    prefix = (np.uint64(1) << np.uint64(step)) | (symbol >> np.uint64(8 - step))
    return ((keys >> np.uint64(8 * (DEPTH + 1 - depth))) << np.uint64(8)) | prefix, ((symbol >> np.uint64(7 - step)) & np.uint64(1)).astype(np.int64)


def _nodes(keys: np.ndarray, counts: np.ndarray, depth: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct nodes that training saw, with counts of zeros and ones."""
    seen = counts > 0
    node, bit = _node(keys[seen], depth, step)
    ids, at = np.unique(node, return_inverse=True)
    return ids, np.bincount(2 * at + bit, weights=counts[seen], minlength=2 * len(ids)).reshape(-1, 2)


def weigh(n: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted log-probability of each node, and the share of its own estimate in it; ``below`` is the
    sum of its children's log-probabilities."""
    own = log_kt(n)
    total = np.logaddexp(own, below)
    return total - np.log(2), np.exp(own - total)


def _parents(ids: np.ndarray, parent: np.ndarray, logs: np.ndarray) -> np.ndarray:
    up = ((ids >> np.uint64(16)) << np.uint64(8)) | (ids & np.uint64(255))
    return np.bincount(np.searchsorted(parent, up), weights=logs, minlength=len(parent))


def levels(keys: np.ndarray, counts: np.ndarray, top: int, step: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Nodes at depths ``top``..DEPTH of one decision: (ids, counts, log-probability, own share)."""
    out = []
    for depth in range(DEPTH, top - 1, -1):
        ids, n = _nodes(keys, counts, depth, step)
        if depth == DEPTH:
            out.append((ids, n, log_kt(n), np.ones(len(ids))))
        else:
            out.append((ids, n, *weigh(n, _parents(out[-1][0], ids, out[-1][2]))))
    return out[::-1]


def _mixed(node: np.ndarray, bit: np.ndarray, level, deeper: np.ndarray) -> np.ndarray:
    """Probability of ``bit`` at a depth, given that one byte deeper; one half where training saw nothing."""
    ids, n, _, share = level
    if not len(ids):
        return np.full(len(node), 0.5)
    at = np.minimum(np.searchsorted(ids, node), len(ids) - 1)
    own = (n[at, bit] + 0.5) / (n[at].sum(1) + 1.0)
    return np.where(ids[at] == node, share[at] * own + (1 - share[at]) * deeper, 0.5)


def byte_logs(keys: np.ndarray, counts: np.ndarray, crown: list) -> np.ndarray:
    """log10 probability of the last byte of each n-gram. ``crown[step]``: the levels of depths 0 and 1."""
    out = np.zeros(len(keys))
    for step in range(8):
        below = levels(keys, counts, 2, step)
        p = np.full(len(keys), 0.5)
        for depth in range(DEPTH, -1, -1):
            node, bit = _node(keys, depth, step)
            p = _mixed(node, bit, crown[step][depth] if depth < 2 else below[depth - 2], p)
        out += np.log10(p)
    return out


_MODEL = "bucket int, kind int, keys binary, counts binary, crown binary, train long, distinct long"
_NODE = np.dtype([("step", "i4"), ("id", "u8"), ("n0", "f8"), ("n1", "f8"), ("log", "f8")])


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per (kind, bucket): the corpus counts of its keys and its nodes of depth 2."""
    for _, tally, (kind, bucket) in _tallies(batches):
        keys, counts = tally.close()
        nodes = []
        if kind == GRAM:
            for step in range(8):
                ids, n, logs, _ = levels(keys, counts, 2, step)[0]
                rows = np.zeros(len(ids), _NODE)
                rows["step"], rows["id"], rows["n0"], rows["n1"], rows["log"] = step, ids, n[:, 0], n[:, 1], logs
                nodes.append(rows)
        crown = np.concatenate(nodes).tobytes() if nodes else b""
        values = [bucket, kind, pack_keys(keys), pack(counts), crown, int(counts.sum()), int((counts > 0).sum())]
        kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]
        yield pa.record_batch([pa.array([v], t) for v, t in zip(values, kinds)], names=["bucket", "kind", "keys", "counts", "crown", "train", "distinct"])


def _tallies(batches):
    current, tally = None, None
    for batch in batches:
        for row in range(batch.num_rows):
            kind, bucket = batch.column("kind")[row].as_py(), batch.column("bucket")[row].as_py()
            if (kind, bucket) != current:
                if current is not None:
                    yield None, tally, current
                current, tally = (kind, bucket), Tally()
            tally.add(unpack_keys(batch.column("keys")[row].as_py()), unpack(batch.column("counts")[row].as_py(), np.int64))
    if current is not None:
        yield None, tally, current


def _crown(nodes: np.ndarray) -> list:
    """Levels of depths 0 and 1 from all nodes of depth 2 (at most 2^16 contexts x 255 decisions)."""
    out = []
    for step in range(8):
        own = nodes[nodes["step"] == step]
        own = own[np.argsort(own["id"])]
        level = (own["id"], np.stack([own["n0"], own["n1"]], 1), own["log"], None)
        found = []
        for _ in (1, 0):
            up = ((level[0] >> np.uint64(16)) << np.uint64(8)) | (level[0] & np.uint64(255))
            ids, at = np.unique(up, return_inverse=True)
            n = np.stack([np.bincount(at, weights=level[1][:, b], minlength=len(ids)) for b in (0, 1)], 1)
            level = (ids, n, *weigh(n, np.bincount(at, weights=level[2], minlength=len(ids))))
            found.append(level)
        out.append(found[::-1])
    return out


def _answer(crown):
    """Rows sorted by (kind, bucket, salt, block), the table (block -1) first: each block's keys get values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = values = None
        for batch in batches:
            out = []
            for row in range(batch.num_rows):
                block, kind = batch.column("block")[row].as_py(), batch.column("kind")[row].as_py()
                own = unpack_keys(batch.column("keys")[row].as_py())
                if block < 0:
                    counts = unpack(batch.column("counts")[row].as_py(), np.int64)
                    keys, values = own, byte_logs(own, counts, crown.value).astype(np.float32) if kind == GRAM else counts
                else:
                    out.append((block, kind, batch.column("keys")[row].as_py(), pack(values[np.searchsorted(keys, own)])))
            if out:
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.binary(), pa.binary()])], names=["block", "kind", "keys", "vals"])

    return run


def _score(total: int, distinct: int, ends: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, table = None, None, None
        base = lambda c: np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
        for batch in batches:
            kinds = batch.column("kind").to_numpy()
            blocks = batch.column("block").to_numpy()
            turn = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(kinds // 2) != 0)) + 1
            for a, b in zip([0, *turn], [*turn, len(blocks)]):
                if blocks[a] != current:
                    current, parts, table = blocks[a], ([], []), None
                if kinds[a] < 2:
                    for row in range(a, b):
                        kind = int(kinds[row])
                        parts[kind].append((unpack_keys(batch.column("keys")[row].as_py()), unpack(batch.column("vals")[row].as_py(), np.float32 if kind == GRAM else np.int64)))
                    continue
                if table is None:
                    table = []
                    for own in parts:
                        k = np.concatenate([x for x, _ in own]) if own else np.zeros(1, np.uint64)
                        v = np.concatenate([x for _, x in own]) if own else np.zeros(1)
                        order = np.argsort(k)
                        table.append((k[order], v[order]))
                    parts = ([], [])
                yield _documents(batch.slice(a, b - a), table, base, total, ends)

    return run


def _documents(batch, table, base, total, ends):
    data, offsets = flat(batch.column("text"))
    n = batch.num_rows
    score, plain, count, known = np.zeros(n), np.zeros(n), np.ones(n, np.int64), np.zeros(n, np.int64)
    for i, j in slices(offsets, TEXTS):
        part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        keys, row = grams(part, at)
        score[i:j] = np.bincount(row, weights=table[GRAM][1][np.searchsorted(table[GRAM][0], keys)], minlength=j - i)
        keys, row = tokens(part, at)
        c = table[TOKEN][1][np.searchsorted(table[TOKEN][0], keys)] if len(keys) else np.zeros(0)
        plain[i:j] = np.bincount(row, weights=base(c), minlength=j - i)
        count[i:j] += np.bincount(row, minlength=j - i)
        known[i:j] = np.bincount(row, weights=c > 0, minlength=j - i)
    columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(count), pa.array(known + (ends > 0)), pa.array(np.full(n, total)), pa.array(plain + base(ends)), pa.array(score)]
    return pa.record_batch(columns, names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


FOLDS = 10
_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_texts(df: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS, block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows whose key's remainder is not 0. ``score`` is the log10 probability of the whole
    text and its end under the context tree (divide by the bytes for code length); ``base_score`` that of
    a smoothed word count model. Null text counts as empty; null keys and repeated rows are rows like
    any other. Without training rows every decision has probability one half.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"), (remainder(key, folds) == 0).alias("held_out"))
    size = docs.agg(F.sum(F.octet_length("text") + F.lit(8)).alias("bytes"), F.sum((~F.col("held_out")).cast("long")).alias("train")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // block))
    ends = size["train"] or 0
    docs = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)))
    packed = materialise(docs.repartition("block").sortWithinPartitions("block").mapInArrow(_count, _PACKED), "grams")
    model = materialise(packed.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket").mapInArrow(_merge, _MODEL), "tree")
    row = model.where(F.col("kind") == TOKEN).agg(F.sum("train"), F.sum("distinct")).first()
    total, distinct = (row[0] or 0) + ends, (row[1] or 0) + (ends > 0)
    nodes = [np.frombuffer(r["crown"], _NODE) for r in model.where(F.col("kind") == GRAM).select("crown").collect()]
    crown = df.sparkSession.sparkContext.broadcast(_crown(np.concatenate(nodes) if nodes else np.zeros(0, _NODE)))
    salts = -(-blocks // 64)
    tables = model.select(F.lit(-1).cast("long").alias("block"), "bucket", "kind", "keys", "counts", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("salt"))
    asked = packed.select("block", "bucket", "kind", "keys", F.lit(None).cast("binary").alias("counts"), F.pmod("block", F.lit(salts)).alias("salt"))
    met = tables.union(asked).repartition("kind", "bucket", "salt").sortWithinPartitions("kind", "bucket", "salt", "block")
    answers = met.mapInArrow(_answer(crown), "block long, kind int, keys binary, vals binary")
    none = lambda t: F.lit(None).cast(t)
    answers = answers.select("block", "kind", "keys", "vals", none("long").alias("doc_id"), none("string").alias("text"), none("boolean").alias("held_out"))
    rows = docs.select("block", F.lit(2).alias("kind"), none("binary").alias("keys"), none("binary").alias("vals"), "doc_id", "text", "held_out")
    joined = answers.union(rows).repartition("block").sortWithinPartitions("block", "kind")
    return joined.mapInArrow(_score(total, distinct, ends), _RESULT)


def lm_scores(spark, sf: str) -> DataFrame:
    """Scores of every whole text of ``documents``."""
    return score_texts(read(spark, sf, "documents"))
