"""Splits and folds that depend only on a row's key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_bucket(key: Column, buckets: int, offset: int = 0) -> Column:
    """Bucket 0..buckets-1 from 32 bits of the key's MD5, starting at hex digit ``offset``.

    Unlike ``randomSplit`` the outcome does not change with partitioning, file layout or a re-run task.
    """
    digest = F.md5(key.cast("string").cast("binary"))
    return (F.conv(F.substring(digest, offset + 1, 8), 16, 10).cast("long") % buckets).cast("int")


def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` by key hash."""
    bucket = hash_bucket(F.col(key), 100)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def with_fold(df: DataFrame, key: str, folds: int, output: str = "fold") -> DataFrame:
    """Fold number per row, from other hash bits than the split so that the two are independent."""
    return df.withColumn(output, hash_bucket(F.col(key), folds, offset=8))
