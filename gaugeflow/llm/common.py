"""What the operators of this package share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package

#: ASCII white space and its complement, as every contract of this package defines words.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf: str, table: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{table}.parquet")


def remainder(key: str, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(modulus))


def whole_text(text: str = "text") -> Column:
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, pa.Table]]:
    """Cut a stream sorted by ``key`` into (value, rows); only one value's rows are held at a time."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        values = batch.column(key).to_pylist()
        start = 0
        for i, value in enumerate(values):
            if held or i > start:
                if value != current:
                    if i > start:
                        held.append(batch.slice(start, i - start))
                    yield current, pa.Table.from_batches(held)
                    held, start = [], i
            current = value
        if values:
            held.append(batch.slice(start))
    if held:
        yield current, pa.Table.from_batches(held)
