"""Ordering, ranking and latest/first selection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise

def rank_groups(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, mean_value, rank)``: groups ranked 0.. by ascending mean, ties by group key.

    Works for any number of groups: the aggregated rows are numbered range by range.
    """
    means = df.groupBy(group).agg(F.avg(value).alias("mean_value"))
    return number_rows(means, ["mean_value", group], "__n").withColumn("rank", (F.col("__n") - 1).cast("int")).drop("__n")


def argsort_descending(df: DataFrame, array_column: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep.., place, position, value)`` per array element: largest value first within each row's
    array, ties by position. Sorts inside the row, so nothing is shuffled."""
    cells = F.transform(
        array_column,
        lambda x, i: F.struct((-x).alias("minus"), i.alias("position"), x.alias("value")),
    )
    rows = df.select(*keep, F.posexplode(F.array_sort(cells)).alias("place", "cell"))
    return rows.select(*keep, "place", "cell.position", "cell.value")


def top_n(df: DataFrame, order_by: Sequence[Column], n: int) -> DataFrame:
    """Top ``n`` under a total order; planned as a per-task top-n and one small merge."""
    return df.orderBy(*order_by).limit(n)


def latest_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order`` (columns compared in turn).

    A mergeable aggregate, not a window: every task reduces its own rows to one per key before the
    shuffle, so a key holding a third of the rows puts no more on the network than any other.
    """
    return _extreme_per(df, keys, order, F.max_by)


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key by ``order``; see :func:`latest_per`."""
    return _extreme_per(df, keys, order, F.min_by)


def _extreme_per(df, keys, order, pick) -> DataFrame:
    names = df.columns
    rest = [c for c in names if c not in keys]
    picked = pick(F.struct(*rest), F.struct(*order)).alias("picked")
    return df.groupBy(*keys).agg(picked).select(*keys, "picked.*").select(*names)


def number_rows(df: DataFrame, order: str | Sequence[str], output: str) -> DataFrame:
    """Consecutive numbers 1.. in the order of one or more columns of any orderable type, nulls first.

    One path at every size: rows are dealt into ranges of ``order``, sorted where they lie, written to
    shared scratch space with their place in the range, and shifted by the size of the ranges before
    them. Only the range sizes (one row per task) meet in one window. A value that fills a range by
    itself is a task of its own at worst when it is the whole order; add a second column to split it.
    The result reads that table; give it to :func:`~gaugeflow.session.release` when it is no longer needed.
    """
    columns = [F.col(c).asc_nulls_first() for c in ([order] if isinstance(order, str) else order)]
    ranged = df.repartitionByRange(*columns).sortWithinPartitions(*columns)
    # the high bits hold the partition, the low 33 bits the place within it
    placed = materialise(ranged.withColumn("__at", F.monotonically_increasing_id()), "numbered")
    path = placed._gaugeflow_path
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    sizes = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + F.lit(1)
    numbered = (
        placed.join(offsets, "__part")
        .withColumn(output, (within + F.col("__offset")).cast("long"))
        .drop("__part", "__at", "__offset")
    )
    numbered._gaugeflow_path = path
    return numbered
