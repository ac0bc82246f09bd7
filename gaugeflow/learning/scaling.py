"""Standardisation as plain columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.schema import quoted


def standardise(df: DataFrame, columns: Sequence[str], ddof: int = 1, reference: DataFrame | None = None) -> DataFrame:
    """Centre and scale columns in place by the statistics of ``reference`` (default: ``df``).

    ``ddof=1`` divides by the sample deviation (Spark ML's scaler), ``ddof=0`` by the population
    deviation (scikit-learn's). A constant column becomes 0. Statistics come as a one-row scalar
    subquery from a single aggregate.
    """
    if ddof not in (0, 1):
        raise ValueError("ddof is 0 or 1")
    spread = F.stddev_samp if ddof else F.stddev_pop
    parts = [
        F.struct(F.avg(F.col(quoted(c))).alias("mean"), spread(F.col(quoted(c))).alias("spread")).alias(c)
        for c in columns
    ]
    stats = (df if reference is None else reference).agg(F.struct(*parts).alias("stats")).scalar()

    def scaled(name):
        s = stats.getField(name)
        centred = F.col(quoted(name)) - s.getField("mean")
        ratio = F.try_divide(centred, s.getField("spread"))
        return F.when(s.getField("spread") == 0, centred * 0.0).otherwise(ratio)

    return df.withColumns({c: scaled(c) for c in columns})
