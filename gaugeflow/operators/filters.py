"""Row filters."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .schema import quoted


def require_target(df: DataFrame, target: str) -> DataFrame:
    """Keep rows with a target."""
    return df.filter(F.col(quoted(target)).isNotNull())


def target_counts(df: DataFrame, target: str) -> DataFrame:
    """``(rows_in, rows_kept, rows_dropped)`` of :func:`require_target`, from one aggregate that reads
    only the target column."""
    rows_in, kept = F.count(F.lit(1)), F.count(F.col(quoted(target)))
    return df.agg(rows_in.alias("rows_in"), kept.alias("rows_kept"), (rows_in - kept).alias("rows_dropped"))


def drop_blank_rows(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Drop rows in which every (listed) column is null."""
    return df.filter(reduce(or_, [F.col(quoted(c)).isNotNull() for c in subset or df.columns]))


def drop_incomplete_rows(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any listed column."""
    return df.filter(reduce(and_, [F.col(quoted(c)).isNotNull() for c in subset], F.lit(True)))


def above(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.filter(F.col(quoted(column)) > limit)


def equal_to(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(quoted(column)) == F.lit(value))


def member_of(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    return df.filter(F.col(quoted(column)).isin(*values))
