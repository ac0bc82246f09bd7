"""Text and byte blobs, file listings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import from_utf8


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file, column ``text``."""
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("text"))


def read_bytes_as_text(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``: whole files decoded as UTF-8."""
    return spark.read.format("binaryFile").load(path).select("path", from_utf8(F.col("content")).alias("text"))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(name, length, modified)`` by name. File contents are not read: the column is pruned."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select(
        name.alias("name"), F.col("length"), F.col("modificationTime").alias("modified")
    ).orderBy("name")


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One string column as UTF-8 text lines."""
    df.write.mode(mode).text(path)
