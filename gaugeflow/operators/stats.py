"""Aggregations and statistics."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import nearest_centre
from ..session import ship_package
from .partials import gather, partial_rows, rows_of
from .schema import quoted


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def summary(df: DataFrame, column: str) -> DataFrame:
    """Mean, maximum and minimum of a column, one row."""
    c = F.col(quoted(column))
    return df.agg(F.avg(c).alias("mean_value"), F.max(c).alias("max_value"), F.min(c).alias("min_value"))


def array_column_summary(df: DataFrame, column: str) -> DataFrame:
    """Per array position over the whole table: sum, mean, max, min."""
    value = F.col("value").cast("double")
    return (
        df.select(F.posexplode(column).alias("position", "value"))
        .groupBy("position")
        .agg(
            F.sum(value).alias("total"),
            F.avg(value).alias("mean_value"),
            F.max(value).alias("max_value"),
            F.min(value).alias("min_value"),
        )
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value."""
    return (
        df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), F.col(column).asc())
    )


def group_means(df: DataFrame, keys: Sequence[str | Column], columns: Sequence[str]) -> DataFrame:
    """Row count and the mean of every listed column (as ``mean_<column>``) per group."""
    means = [F.avg(F.col(quoted(c))).alias(f"mean_{c}") for c in columns]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *means)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long-form Pearson matrix ``(column_a, column_b, correlation)``, pairwise-complete.

    All pairs come from one aggregate over one scan; the symmetric half is mirrored from it.
    """
    pairs = list(combinations_with_replacement(columns, 2))
    single = df.agg(
        *[F.corr(F.col(quoted(a)), F.col(quoted(b))).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    cells = []
    for i, (a, b) in enumerate(pairs):
        for left, right in {(a, b), (b, a)}:
            cells.append(
                F.struct(
                    F.lit(left).alias("column_a"),
                    F.lit(right).alias("column_b"),
                    F.col(f"r{i}").alias("correlation"),
                )
            )
    return single.select(F.inline(F.array(*cells)))


def _extent(df: DataFrame, column: str) -> tuple[Column, Column]:
    c = F.col(quoted(column))
    box = df.agg(F.struct(F.min(c).alias("lo"), F.max(c).alias("hi")).alias("box")).scalar()
    flat = box.getField("lo") == box.getField("hi")
    shift = F.when(flat, 0.5).otherwise(0.0)
    return box.getField("lo") - shift, box.getField("hi") + shift


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based bin of ``value`` in ``bins`` equal intervals; the maximum belongs to the last bin."""
    place = F.floor(F.lit(float(bins)) * (value - low) / (high - low))
    return F.least(place, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """``(bin, low_edge, high_edge, n)`` for the non-empty bins.

    The extent is a one-row scalar subquery; the count aggregates on each task before the shuffle.
    """
    low, high = _extent(df, column)
    value = F.col(quoted(column))
    counted = (
        df.filter(value.isNotNull())
        .groupBy(equal_width_bin(value, low, high, bins).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (high - low) / F.lit(float(bins))
    return counted.select(
        "bin",
        (low + F.col("bin") * width).alias("low_edge"),
        (low + (F.col("bin") + 1) * width).alias("high_edge"),
        "n",
    )


#: Bins of the density per bandwidth, and moments kept of a bin.
KERNEL_BINS, MOMENTS = 16, 8


def density(df: DataFrame, column: str, points: int = 200, cut: float = 0.0) -> DataFrame:
    """Gaussian kernel density ``(position, x, density)`` with Scott's bandwidth on an even grid.

    The grid is fixed in size and reaches ``cut`` bandwidths past the extent. Rows are binned, 16 bins to the
    bandwidth, with the first eight moments of their distances to the bin's middle; a kernel seen from the
    middle of a bin is a Hermite series in those distances, so no row meets the grid. Cutting the series after
    eight terms changes the density by less than 1e-14 of a kernel's height (105 / 8! * 32^-8). There are
    never more bins than rows or than 16 to each bandwidth of the extent.
    """
    value = F.col(quoted(column)).cast("double")
    value = F.when(~F.isnan(value), value)
    n, spread, low, high = df.agg(F.count(value), F.stddev_samp(value), F.min(value), F.max(value)).first()
    schema = "position int, x double, density double"
    if not n or n < 2 or not spread:
        return df.sparkSession.createDataFrame([], schema)
    ship_package(df.sparkSession)
    width = spread * n ** (-1 / 5)
    start, stop = low - cut * width, high + cut * width
    grid = start + np.arange(points) * ((stop - start) / (points - 1))
    place = (value - F.lit(low)) / F.lit(width)  # in bandwidths
    at = F.floor(place * KERNEL_BINS)
    away = place - (at + 0.5) / KERNEL_BINS
    rows = df.where(value.isNotNull()).select(at.alias("bin"), away.alias("t"))
    powers = [F.count(F.lit(1)).cast("double"), F.sum("t"), *[F.sum(F.pow("t", F.lit(p))) for p in range(2, MOMENTS)]]
    bins = rows.groupBy("bin").agg(F.array(*powers).alias("moments")).select(F.concat(F.array(F.col("bin").cast("double")), "moments").alias("x"))
    factorial = np.array([math.factorial(p) for p in range(MOMENTS)], float)

    def fold(batches):
        mass = np.zeros(points)
        for batch in batches:
            cells = rows_of(batch)
            for i in range(0, len(cells), 1024):
                part = cells[i : i + 1024]
                u = (grid[None] - low) / width - (part[:, :1] + 0.5) / KERNEL_BINS
                before, hermite = np.zeros_like(u), np.ones_like(u)
                series = np.zeros_like(u)
                for p in range(MOMENTS):
                    series += hermite * part[:, p + 1 : p + 2] / factorial[p]
                    before, hermite = hermite, u * hermite - p * before
                mass += (np.exp(-0.5 * u * u) * series).sum(axis=0)
        yield partial_rows([(0, mass)])

    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mass = gather(bins, fold, lambda _, parts: np.sum(parts, axis=0), tasks)[0]
    curve = mass / (n * width * math.sqrt(2 * math.pi))
    return df.sparkSession.createDataFrame([(i, float(x), float(d)) for i, (x, d) in enumerate(zip(grid, curve))], schema)


def scatter_bins(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Binned scatter ``(bin_x, bin_y, n)`` over the extents of both columns.

    The data behind a scatter plot whose size does not depend on the number of rows.
    """
    both = df.filter(F.col(quoted(x)).isNotNull() & F.col(quoted(y)).isNotNull())
    x_low, x_high = _extent(both, x)
    y_low, y_high = _extent(both, y)
    return both.groupBy(
        equal_width_bin(F.col(quoted(x)), x_low, x_high, bins).alias("bin_x"),
        equal_width_bin(F.col(quoted(y)), y_low, y_high, bins).alias("bin_y"),
    ).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, plus ``macro avg`` and ``weighted avg``.

    A ratio with nothing below the line counts as 0. The input is reduced to its confusion matrix
    first; everything after works on at most classes squared rows.
    """
    cells = confusion(df, label, prediction)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.inline(
        F.array(
            F.struct(F.col("label").alias("class"), hit.alias("tp"), F.col("n").alias("actual"), F.lit(0).cast("long").alias("named")),
            F.struct(F.col("prediction").alias("class"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("actual"), F.col("n").alias("named")),
        )
    )
    totals = (
        cells.select(sides)
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("tp", "actual", "named")])
    )
    ratio = lambda top, bottom: F.coalesce(F.try_divide(F.col(top).cast("double"), F.col(bottom).cast("double")), F.lit(0.0))
    scored = totals.withColumns({"precision": ratio("tp", "named"), "recall": ratio("tp", "actual")})
    both = F.col("precision") + F.col("recall")
    scored = scored.withColumn(
        "f1", F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    )
    measures = ("precision", "recall", "f1")
    rolled = scored.rollup("class").agg(
        F.grouping("class").alias("is_total"),
        *[F.avg(m).alias(m) for m in measures],
        *[(F.sum(F.col(m) * F.col("actual")) / F.sum("actual")).alias(f"weighted_{m}") for m in measures],
        F.sum("actual").alias("support"),
    )
    plain = lambda name, prefix="": F.struct(
        name.alias("class"), *[F.col(f"{prefix}{m}").alias(m) for m in measures], F.col("support")
    )
    lines = F.when(
        F.col("is_total") == 1, F.array(plain(F.lit("macro avg")), plain(F.lit("weighted avg"), "weighted_"))
    ).otherwise(F.array(plain(F.col("class").cast("string"))))
    return rolled.select(F.inline(lines))


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.agg(F.avg(hit).alias("accuracy"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``n, mse, rmse, mae, r2`` from one aggregate; rows with a null on either side are ignored."""
    y, error = F.col(label).cast("double"), F.col(label).cast("double") - F.col(prediction).cast("double")
    usable = df.filter(F.col(label).isNotNull() & F.col(prediction).isNotNull())
    sums = usable.agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(y).alias("variance"),
    )
    r2 = F.lit(1.0) - F.try_divide(F.col("mse"), F.col("variance"))
    return sums.select("n", "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"))


def inertia(df: DataFrame, column: str, centres: Sequence[Sequence[float]]) -> DataFrame:
    """Sum over rows of the squared distance to the nearest of the given centres."""
    nearest = nearest_centre(F.col(quoted(column)), centres)
    return df.select(nearest.getField("distance2").alias("d")).agg(F.sum("d").alias("inertia"))


def scatter_about_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Total squared distance to the mean over the columns: the inertia of a single cluster."""
    total = None
    for name in columns:
        part = F.var_pop(F.col(quoted(name))) * F.count(F.col(quoted(name)))
        total = part if total is None else total + part
    return df.agg(total.alias("inertia"))
