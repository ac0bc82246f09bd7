"""Delimited text: scans without inference, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.quality import repair_decimals
from ..operators.schema import drop_unnamed


def read_delimited(
    spark: SparkSession,
    path: str,
    sep: str = ";",
    header: bool = True,
    columns: Sequence[str] | None = None,
    expected: Sequence[str] | None = None,
) -> DataFrame:
    """Every field as text; empty fields are null.

    ``columns`` gives an all-string schema up front (the header is still checked against it).
    ``expected`` names columns that the header must have; a file read with the wrong separator
    fails here instead of turning into one wide column.
    """
    reader = spark.read.option("sep", sep).option("header", header).option("inferSchema", False)
    if columns is not None:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema).option("enforceSchema", not header)
    df = reader.csv(path)
    missing = [c for c in (expected or []) if c not in df.columns]
    if missing:
        raise ValueError(f"columns {missing} not found in {path}; got {df.columns}")
    return df


def read_decimal_comma(
    spark: SparkSession, path: str, numeric: Sequence[str], sep: str = ";", **options
) -> DataFrame:
    """Delimited scan whose listed columns have a decimal comma."""
    return repair_decimals(read_delimited(spark, path, sep, **options), numeric)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Comma-separated scan with typed columns; empty fields are null. Also for ``.txt`` files.

    Types are inferred only without a schema, at the price of one more pass over the file.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("nullValue", "")
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_named_columns(spark: SparkSession, path: str, sep: str = ";", **options) -> DataFrame:
    """Delimited scan without the unnamed trailing columns that trailing separators produce."""
    return drop_unnamed(read_delimited(spark, path, sep, **options))


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV with header, one file per partition."""
    df.write.mode(mode).option("header", True).option("sep", sep).csv(path)
