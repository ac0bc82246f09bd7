"""Data-quality operators: repair, missing-value profile, imputation, binarisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import numbers
from .quantile import exact_median
from .schema import quoted


def present(df: DataFrame, columns: Sequence[str]) -> list[str]:
    have = set(df.columns)
    return [c for c in columns if c in have]


def repair_decimals(df: DataFrame, columns: Sequence[str], decimal: str = ",") -> DataFrame:
    """Locale decimal text to double for every listed column, in one projection."""
    return df.withColumns(
        {c: numbers.locale_double(F.col(quoted(c)), decimal) for c in present(df, columns)}
    )


def null_out_sentinel(df: DataFrame, columns: Sequence[str], sentinel: float) -> DataFrame:
    """Replace the missing marker by null in the listed columns."""
    return df.withColumns(
        {c: numbers.sentinel_to_null(F.col(quoted(c)), sentinel) for c in present(df, columns)}
    )


def _per_column(df: DataFrame, columns: Sequence[str], measure, alias: str) -> DataFrame:
    single = df.agg(*[measure(F.col(quoted(c))).alias(f"v{i}") for i, c in enumerate(columns)])
    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"v{i}").alias(alias)) for i, c in enumerate(columns)
    ]
    return single.select(F.inline(F.array(*rows)))


def missing_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing)`` for every column, from one aggregate over one scan."""
    return _per_column(df, columns or df.columns, lambda c: F.count_if(c.isNull()), "missing")


def missing_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Only the columns that have missing values."""
    return missing_counts(df, columns).filter(F.col("missing") > 0)


def null_fractions(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, null_fraction)`` from one aggregate."""
    return _per_column(df, columns, lambda c: F.avg(c.isNull().cast("double")), "null_fraction")


def drop_sparse_columns(
    df: DataFrame, columns: Sequence[str], threshold: float
) -> tuple[DataFrame, list[str], dict[str, float]]:
    """Drop listed columns whose null fraction is strictly above ``threshold``.

    Returns the frame, the columns kept and the fraction of every listed column. All fractions come
    from one aggregate job instead of one count per column.
    """
    listed = present(df, columns)
    if not listed:
        return df, [], {}
    row = df.agg(*[F.avg(F.col(quoted(c)).isNull().cast("double")).alias(c) for c in listed]).first()
    fractions = {c: (0.0 if v is None else v) for c, v in zip(listed, row)}
    dropped = [c for c in listed if fractions[c] > threshold]
    return df.drop(*dropped), [c for c in listed if c not in dropped], fractions


def mean_struct(df: DataFrame, columns: Sequence[str]) -> Column:
    """Column means as a one-row scalar subquery: computed once on the executors, no join needed."""
    means = F.struct(*[F.avg(F.col(quoted(c))).alias(c) for c in columns])
    return df.agg(means.alias("means")).scalar()


def impute_mean(df: DataFrame, columns: Sequence[str], reference: DataFrame | None = None) -> DataFrame:
    """Fill nulls with the column mean (of ``reference`` if given). A column without values stays null.

    Order matters: imputing before a null-target filter puts means into the target. Filter first
    unless that is wanted.
    """
    if not columns:
        return df
    means = mean_struct(df if reference is None else reference, columns)
    return df.withColumns({c: F.coalesce(F.col(quoted(c)), means.getField(c)) for c in columns})


def fill_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Replace nulls by per-column defaults; an absent column is added with its default."""
    have = set(df.columns)
    return df.withColumns(
        {
            c: numbers.default_for_missing(F.col(quoted(c)), v) if c in have else F.lit(v)
            for c, v in defaults.items()
        }
    )


def binarise_by_median(df: DataFrame, column: str, output: str) -> tuple[DataFrame, float | None]:
    """``1`` where the value is strictly above the exact median, else ``0`` (also for null).

    Compute it on data that is not imputed: with mean-imputed data the mean can become the median.
    """
    middle = exact_median(df, column)
    flag = F.coalesce(F.col(quoted(column)) > F.lit(middle), F.lit(False)).cast("int")
    return df.withColumn(output, flag), middle
