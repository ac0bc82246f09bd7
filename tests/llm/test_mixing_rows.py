"""Mixing numbers its rows once."""

from collections import Counter

from pyspark.sql import functions as F

from gaugeflow.llm import mixing


def test_rows_read_again_in_other_partitions(spark, tmp_path):
    rows = [(i, "w " * (1 + i % 37), "ab"[i % 2]) for i in range(400)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    materialise = mixing.materialise

    def dealt_anew(df, label):
        """As when executors come or go: what is read after a table was written is cut into other partitions."""
        out = materialise(df, label)
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
        return out

    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    mixing.materialise = dealt_anew
    try:
        got = mixing.mix(spark.read.parquet(path)).select("doc_id", "size", "source", "copies", F.length("text").alias("n")).collect()
    finally:
        mixing.materialise = materialise
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
    assert Counter((r["doc_id"], r["size"], r["source"]) for r in got) == Counter((i, 1 + i % 37, s) for i, _, s in rows)
    assert all(r["n"] == 2 * r["size"] for r in got)


def test_reruns_agree_in_any_partitions(spark):
    """The same rows dealt and ordered anew, repeated rows among them, give the same copies."""
    rows = [(i % 350, "w " * (1 + i % 41), ["a", "b", None][i % 3], i % 2) for i in range(390)]
    found = []
    for parts in (1, 4, 50):
        df = spark.createDataFrame(rows[parts:] + rows[:parts], "doc_id long, text string, source string, other int").repartition(parts)
        got = mixing.mix(df).select("doc_id", "source", "other", "size", "copies").collect()
        found.append(Counter(map(tuple, got)))
    assert found[0] == found[1] == found[2] and sum(found[0].values()) == 390
