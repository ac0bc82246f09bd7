"""Projection and schema operators."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    """Back-quote a column name so that dots and brackets in it are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename by map in one projection; absent columns are ignored."""
    return df.withColumnsRenamed(dict(names))


def drop_unnamed(df: DataFrame) -> DataFrame:
    """Drop columns with a blank name, including the ``_c15`` style names Spark gives blank headers."""
    keep = [c for c in df.columns if c.strip() and not re.fullmatch(r"_c\d+", c)]
    return df.select(*[F.col(quoted(c)) for c in keep])


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. One aggregate job decides the schema."""
    counts = df.agg(*[F.count(F.col(quoted(c))).alias(c) for c in df.columns]).first()
    return df.drop(*[c for c, n in zip(df.columns, counts) if n == 0])


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop named columns; unknown names are ignored."""
    return df.drop(*names)


def select_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(quoted(n)) for n in names])


def columns_of_type(df: DataFrame, types: tuple = (T.NumericType,), exclude: Iterable[str] = ()) -> list[str]:
    """Names of columns of the given types minus exclusions, in schema order. Runs no job."""
    left_out = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, types) and f.name not in left_out]


def feature_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Double, integer and long columns minus exclusions: the default model inputs."""
    return columns_of_type(df, (T.DoubleType, T.IntegerType, T.LongType), exclude)


def with_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add or overwrite several columns in one projection."""
    return df.withColumns(dict(columns))


def dataset_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, non-null count. A single aggregate, unpivoted."""
    counted = df.agg(*[F.count(F.col(quoted(f.name))).alias(f"n{i}") for i, f in enumerate(df.schema)])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("dtype"),
            F.col(f"n{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ]
    return counted.select(F.inline(F.array(*rows)))


def preview(df: DataFrame, order_by: Sequence, n: int) -> DataFrame:
    """First ``n`` rows under an explicit order, so the result does not depend on partitioning."""
    return df.orderBy(*order_by).limit(n)


def lookup_join(
    df: DataFrame, key: str, dimension: DataFrame, dimension_key: str, value: str, alias: str, default=None
) -> DataFrame:
    """Left join to a label table with a default for unknown keys.

    No broadcast hint: the engine broadcasts the dimension only when its measured size is below the
    session threshold, and otherwise shuffles with adaptive skew handling. Dimension keys must be unique.
    """
    labels = dimension.select(F.col(dimension_key).alias("__key"), F.col(value).alias("__value"))
    out = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    return (
        df.join(labels, F.col(key) == F.col("__key"), "left")
        .withColumn(alias, out)
        .drop("__key", "__value")
    )
