"""Quality classifier: logistic regression on hashed word n-grams, trained by follow-the-regularised-leader."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, remainder, whole_text
from .hashing import flat, mix, sequence_hash, slices, span_hashes, words
from .tokens import release

#: log2 of the number of weights.
BITS = 18
#: Labelled rows that the model is fitted on at most (those with the smallest hash of their key).
MAX_TRAINING_ROWS = 16_000
#: Learners that follow the leader side by side; their weights are averaged after each round.
SHARDS, ROUNDS = 4, 3
#: Slots of a learner's state in one row.
PART = 1 << 14

_CLASS = np.arange(256, dtype=np.uint8)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[128:] = ord("a"), ord("A"), ord("0"), ord("a")


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each word with letters, capitals and digits as classes and runs of a class as one."""
    kind = _CLASS[data]
    keep = np.ones(len(kind), bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[starts] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    return span_hashes(kind[keep], place[starts], place[ends])


def features(data: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value), sorted: word 1- and 2-grams, 1- to 3-grams of word shapes and a mark on words
    that repeat the one before. A value is the n-gram's share of the row's n-grams, under a square root."""
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    word, shape = span_hashes(data, starts, ends), _shapes(data, starts, ends)
    grams = [(row, word), (row, shape ^ np.uint64(0x5A))]
    for n, source, tag in ((2, word, 1), (2, shape, 2), (3, shape, 3)):
        if len(row) >= n:
            same = row[n - 1 :] == row[: len(row) - n + 1]
            grams.append((row[n - 1 :][same], sequence_hash([source[i : len(source) - n + 1 + i] for i in range(n)])[same] + np.uint64(tag)))
    if len(row) > 1:
        again = (row[1:] == row[:-1]) & (word[1:] == word[:-1])
        grams.append((row[1:][again], np.full(int(again.sum()), 7, np.uint64)))
    rows = np.concatenate([r for r, _ in grams])
    slot = (mix(np.concatenate([h for _, h in grams])) >> np.uint64(64 - bits)).astype(np.int64)
    keys, n = np.unique((rows << bits) | slot, return_counts=True)
    rows, slot = keys >> bits, keys & ((1 << bits) - 1)
    total = np.bincount(rows, weights=n)
    return rows, slot, np.sqrt(n / total[rows])


class Leader:
    """Follow-the-regularised-leader with per-coordinate rates and L1/L2 penalties."""

    def __init__(self, bits: int, alpha: float = 5.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.0002):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        return np.where(np.abs(z) <= self.l1, 0.0, -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, x: np.ndarray, y: float) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


BIAS = 0  # this slot is every row's


def _with_bias(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    other = at != BIAS
    return np.concatenate([[BIAS], at[other]]), np.concatenate([[1.0], x[other]])


def fit(labelled: DataFrame, bits: int = BITS, shards: int = SHARDS, rounds: int = ROUNDS, key: str = "doc_id", text: str = "text", label: str = "label"):
    """Weights from all rows of ``labelled`` (key, text, label 0/1); :func:`bounded_sample` bounds them.

    Each shard learns its own rows in a fixed order, starting from the state averaged over all shards.
    States go from round to round between tasks, ``PART`` slots to a row; only the weights of the last
    state, 4 bytes each, come to the driver. Rows without a label are left out. Without any row all weights
    are 0, so every score is one half.
    """
    rank = F.xxhash64(F.col(key).cast("string"), F.lit(17))
    rows = labelled.where(F.col(label).isNotNull()).select(
        rank.alias("rank"), whole_text(text).alias("text"), F.col(label).cast("double").alias("y")
    )
    rows = rows.withColumn("shard", F.pmod("rank", F.lit(shards)).cast("int"))

    def begin(pdf):
        return learned(Leader(bits), pdf)

    def follow(pdf, start):
        import pandas as pd

        if not len(pdf):  # a shard without rows has no state
            return pd.DataFrame({c: [] for c in ("part", "shard", "z", "n")})
        leader = Leader(bits)
        start = start.sort_values("part")
        leader.z, leader.n = (np.concatenate([np.frombuffer(x) for x in start[c]]) for c in ("z", "n"))
        return learned(leader, pdf)

    def learned(leader, pdf):
        import pandas as pd

        release()
        pdf = pdf.sort_values(["rank", "text", "y"])
        data, offsets = flat(pa.array(pdf["text"], pa.large_string()))
        for i, j in slices(offsets):
            row, slot, value = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
            cut = np.searchsorted(row, np.arange(j - i + 1))
            for k in range(j - i):
                leader.learn(*_with_bias(slot[cut[k] : cut[k + 1]], value[cut[k] : cut[k + 1]]), pdf["y"].iloc[i + k])
        at = range(0, 1 << bits, PART)
        cut = lambda x: [x[i : i + PART].tobytes() for i in at]
        return pd.DataFrame({"part": range(len(at)), "shard": pdf["shard"].iloc[0], "z": cut(leader.z), "n": cut(leader.n)})

    def mean(pdf):
        import pandas as pd

        pdf = pdf.sort_values("shard")
        z, n = (np.mean([np.frombuffer(x) for x in pdf[c]], axis=0) for c in ("z", "n"))
        leader = Leader(0)
        leader.z, leader.n = z, n
        weights = leader.weights().astype(np.float32)
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "z": [z.tobytes()], "n": [n.tobytes()], "w": [weights.tobytes()]})

    made = rows.groupBy("shard").applyInPandas(begin, "part int, shard int, z binary, n binary")
    for left in reversed(range(rounds)):
        state = made.groupBy("part").applyInPandas(mean, "part int, z binary, n binary, w binary")
        if left:
            start = state.select("part", "z", "n", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
            made = rows.groupBy("shard").cogroup(start.groupBy("shard")).applyInPandas(follow, made.schema)
    weights = np.zeros(1 << bits, np.float32)
    for row in state.select("part", "w").collect():
        weights[row["part"] * PART : (row["part"] + 1) * PART] = np.frombuffer(row["w"], np.float32)
    return weights


def bounded_sample(labels: DataFrame, limit: int = MAX_TRAINING_ROWS, key: str = "doc_id") -> DataFrame:
    """``limit`` rows at most, those with the smallest hash of their key."""
    return labels.orderBy(F.xxhash64(F.col(key).cast("string"), F.lit(17)), key).limit(limit)


def score(df: DataFrame, weights: np.ndarray, text: str = "text", output: str = "score") -> DataFrame:
    """Add ``output``: the probability of label 1 from a sparse dot product over the whole text.

    Null and empty texts get the probability that the bias alone gives; very long texts are read whole, in a
    slice of their own. Repeated rows get equal scores. Other columns stay; one called ``output`` is replaced.
    """
    bits = len(weights).bit_length() - 1
    held = df.sparkSession.sparkContext.broadcast(weights)  # 4 bytes a weight
    df = df.drop(output)
    schema = df.schema
    column = df.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        w = held.value.astype(np.float64)
        for batch in batches:
            data, offsets = flat(batch.column(column))
            out = np.full(batch.num_rows, w[BIAS])
            for i, j in slices(offsets):
                row, slot, value = features(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], bits)
                value = np.where(slot == BIAS, 0.0, value)
                out[i:j] += np.bincount(row, weights=w[slot] * value, minlength=j - i)[: j - i]
            p = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(p)], names=[*[str(i) for i in range(batch.num_columns)], "p"])

    from pyspark.sql.types import DoubleType, StructField, StructType

    plain = StructType([StructField(str(i), f.dataType) for i, f in enumerate(schema)] + [StructField("p", DoubleType())])
    scored = df.toDF(*[str(i) for i in range(len(df.columns))]).mapInArrow(run, plain)
    return scored.toDF(*df.columns, output)


THRESHOLD = 0.3
FOLDS = 5


def train(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Weights from the labelled rows whose key's remainder is not 0; the sample's keys are broadcast, as
    ``limit`` bounds the labels. A key that is repeated among documents or labels gives a training row for
    each pair; null keys and null labels give none. Without labels all scores are one half."""
    known = labels.where(F.col("quality").isNotNull() & (remainder("doc_id", FOLDS) != 0)).select("doc_id", F.col("quality").alias("label"))
    sample = bounded_sample(known, limit)
    return fit(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id"))


def quality_classifier(spark, sf: str) -> DataFrame:
    """Scores of every whole text of ``documents``."""
    docs = read(spark, sf, "documents")
    scored = score(docs.select("doc_id", "text"), train(docs, read(spark, sf, "labels")))
    return scored.select(
        "doc_id",
        (remainder("doc_id", FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
