"""Array column expressions: element-wise arithmetic, reshape, reductions, distances."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def array_of(values: Sequence[float]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def matrix_of(rows: Sequence[Sequence[float]]) -> Column:
    return F.array(*[array_of(row) for row in rows])


def number_range(start: Column | int, stop: Column | int) -> Column:
    """Half-open integer range ``[start, stop)``; empty when ``stop <= start``."""
    first = start if isinstance(start, Column) else F.lit(start)
    last = stop if isinstance(stop, Column) else F.lit(stop)
    return F.when(last > first, F.sequence(first, last - F.lit(1))).otherwise(F.array().cast("array<int>"))


def add_scalar(col: Column, number: float) -> Column:
    return F.transform(col, lambda x: x + F.lit(number))


def multiply_scalar(col: Column, number: float) -> Column:
    return F.transform(col, lambda x: x * F.lit(number))


def array_sum(col: Column) -> Column:
    return F.aggregate(col, F.lit(0.0), lambda acc, x: acc + x.cast("double"))


def array_mean(col: Column) -> Column:
    """Null for an empty array."""
    return F.try_divide(array_sum(col), F.size(col).cast("double"))


def reshape(col: Column, rows: int, columns: int) -> Column:
    """Row-major reshape; a size mismatch fails the job."""
    shaped = F.transform(
        F.sequence(F.lit(0), F.lit(rows - 1)),
        lambda i: F.slice(col, i * columns + 1, columns),
    )
    message = F.concat(F.lit(f"cannot reshape to {rows}x{columns} from size "), F.size(col).cast("string"))
    return F.when(col.isNull() | (F.size(col) == rows * columns), shaped).otherwise(F.raise_error(message))


#: Centres up to which each is met by every row.
FEW_CENTRES = 16


def _centre_groups(table):
    """``(pivots, radii, members)``: centres by the nearest of about as many pivots as members, farthest first."""
    import numpy as np

    if len(table) <= FEW_CENTRES:
        return table[:1], np.array([np.inf]), [np.arange(len(table))]
    away, own, pivots = np.full(len(table), np.inf), np.zeros(len(table), int), []
    for number in range(int(len(table) ** 0.5)):
        pivots.append(int(away.argmax()))
        distance = np.sqrt(((table - table[pivots[-1]]) ** 2).sum(axis=1))
        closer = distance < away
        own[closer], away[closer] = number, distance[closer]
    members = [np.flatnonzero(own == g) for g in range(len(pivots))]
    return table[pivots], np.array([away[m].max() if len(m) else -np.inf for m in members]), members


def nearest_of(points, table, groups):
    """``(number, squared distance, distances measured)`` of the nearest centre per row, ties to the lowest
    number. A group of centres is met only by rows that its pivot and radius let have a nearer one in it."""
    import numpy as np

    pivots, radii, members = groups
    best, least, measured = np.zeros(len(points), "int32"), np.full(len(points), np.inf), 0

    def meet(group, rows):
        nonlocal measured
        for number in members[group]:
            distance = ((points[rows] - table[number]) ** 2).sum(axis=1)
            closer = (distance < least[rows]) | ((distance == least[rows]) & (number < best[rows]))
            best[rows[closer]], least[rows[closer]] = number, distance[closer]
        measured += len(rows) * len(members[group])

    if len(members) == 1:
        meet(0, np.arange(len(points)))
        return best, least, measured
    away = np.sqrt(np.stack([((points - p) ** 2).sum(axis=1) for p in pivots], axis=1))
    measured += away.size
    first = away.argmin(axis=1)
    for group in np.unique(first):
        meet(group, np.flatnonzero(first == group))
    for group in range(len(members)):
        bound = (away[:, group] - radii[group]) * (1 - 1e-9)  # equal distances must not be lost to rounding
        meet(group, np.flatnonzero((first != group) & (np.maximum(bound, 0) ** 2 <= least)))
    return best, least, measured


def nearest_centre(vector: Column, centres: Sequence[Sequence[float]]) -> Column:
    """``struct(cluster, distance2)``: nearest fixed centre by squared Euclidean distance, ties to the
    lowest number. Null for a null vector or one with a null element; a wrong length fails the job.

    Works on whole Arrow batches. Interpreted higher-order functions take several times as long, and
    one compiled expression per coordinate exceeds what can be compiled. The centres are a fitted model
    that the driver holds; they go to each executor once, and a batch meets them one by one, so memory
    does not grow with their number. Many centres are grouped around pivots once, and the triangle
    inequality spares a row the groups that cannot hold its nearest one (see :func:`nearest_of`).
    """
    import numpy as np

    table = np.asarray(centres, dtype="float64")
    if table.ndim != 2 or not table.size:
        raise ValueError("need at least one centre, all of one length")
    groups = _centre_groups(table)

    @F.arrow_udf("struct<cluster: int, distance2: double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        usable = vectors.is_valid().to_numpy(zero_copy_only=False)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)[usable]
        if (lengths != table.shape[1]).any():
            raise ValueError(f"vector length differs from the centre length {table.shape[1]}")
        cells = vectors.filter(pa.array(usable)).flatten().to_numpy(zero_copy_only=False)
        points = cells.astype("float64").reshape(-1, table.shape[1])
        best, least, _ = nearest_of(points, table, groups)
        least[np.isnan(points).any(axis=1)] = np.nan
        cluster, distance2 = np.zeros(len(usable), "int32"), np.full(len(usable), np.nan)
        cluster[usable], distance2[usable] = best, least
        missing = np.isnan(distance2)
        return pa.StructArray.from_arrays(
            [pa.array(cluster), pa.array(distance2)], names=["cluster", "distance2"], mask=pa.array(missing)
        )

    return nearest(vector)
