"""From documents to packed training sequences: reject poor texts, drop copies, keep one of each group of
near copies, mix the sources, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read
again as the next one's ``docs``. All but the last return the columns of ``documents`` with the values they
had, whatever their names. Null texts count as empty; empty tables pass through; repeated rows are rows of
their own until copies are dropped; very long texts are read whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import common, exact_dedup, mixing, packing, quality, shingle_join
from gaugeflow.session import materialise


def _apart(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``work`` on ``docs`` whose extra columns have names that no operator uses; then their own again."""
    names = {c: f"__own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text", "source")}
    out = work(docs.withColumnsRenamed(names))
    return out.select(*[F.col(f"`{names.get(c, c)}`").alias(c) for c in docs.columns])


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold of the quality classifier."""
    weights = quality.train(docs.select("doc_id", "text"), common.read(spark, sf_dir, "labels"))
    return _apart(docs, lambda own: quality.score(own, weights, output="__score").where(F.col("__score") >= quality.THRESHOLD))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each normalised text."""
    return _apart(docs, exact_dedup.drop_duplicates)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingles of five words, at least 0.8 alike."""
    return _apart(docs, lambda own: shingle_join.keep_one(own, width=5, percent=80))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    times = F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))
    return _apart(docs, lambda own: mixing.mix(own).where("copies > 0").withColumn("__copy", times))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    import public_tokenizers

    return packing.pack(docs.select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality classifier", classify_quality),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Training, components and packing are beyond SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = common.read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
