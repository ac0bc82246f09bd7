"""Whitening of embeddings by singular values of the centred rows.

Tasks fold blocks of centred rows into triangles by QR, and triangles meet in a reduction tree, so the
covariance matrix is never formed. The last triangle, as wide as the vectors whatever their number, is
bidiagonalised by Householder reflections; the differential quotient-difference algorithm with shifts
finds its singular values to high relative accuracy, and twisted factorisations its directions.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, ship_package
from .common import read

#: Fixed-point grid: ``x = floor(GRID * c) + OFFSET``.
GRID, OFFSET = 64, 1_000_000
#: Components returned, and rows a task folds at once.
COMPONENTS, BLOCK = 16, 4096
#: Partial results of so many tasks meet in one task of the reduction tree.
FAN = 32
#: An entry of at least this size has no exact place on the grid and counts as non-finite.
LARGEST = 2.0**31
EPS = np.finfo(float).eps


# -- the triangle -> singular values and directions -------------------------------------------------------


def bidiagonalise(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, V)``: ``U.T @ r @ V`` has the diagonal ``a`` and the superdiagonal ``b``, with V orthogonal."""
    m, d = r.astype(float).copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.linalg.norm(x)
        if not size or len(x) < 2:
            return None
        h = x.copy()
        h[0] += math.copysign(size, x[0])
        return h / np.linalg.norm(h)

    for k in range(d):
        h = reflector(m[k:, k])
        if h is not None:
            m[k:, k:] -= 2 * np.outer(h, h @ m[k:, k:])
        h = reflector(m[k, k + 1 :]) if k + 2 < d else None
        if h is not None:
            m[:, k + 1 :] -= 2 * np.outer(m[:, k + 1 :] @ h, h)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ h, h)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float] | None:
    """One shifted quotient-difference sweep; None if the shift exceeds the smallest eigenvalue."""
    n = len(q)
    out_q, out_e, d = np.empty(n), np.empty(n - 1), q[0] - shift
    least = d
    for i in range(n - 1):
        out_q[i] = d + e[i]
        if d < 0:
            return None
        ratio = q[i + 1] / out_q[i] if out_q[i] > 0 else 1.0  # 0 / 0: the zero moves on
        out_e[i] = e[i] * ratio
        d = d * ratio - shift
        least = min(least, d)
    out_q[-1] = d
    return None if least < 0 else (out_q, out_e, least)


def singular_squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of the bidiagonal, falling, by dqds with deflation."""
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not scale:
        return np.zeros(len(a))
    todo, found = [((a / scale) ** 2, (b / scale) ** 2, 0.0)], []
    while todo:
        q, e, total = todo.pop()
        turns = 0
        while len(q):
            if len(q) == 1:
                found.append(total + q[0])
                break
            small = e <= (EPS * EPS) * np.minimum(q[:-1] + total, q[1:] + total)
            if turns > 400:  # far beyond what any bidiagonal took: settle for absolute accuracy
                small |= e <= EPS * EPS * max(q.max(), total)
            if small.any():
                at = int(np.flatnonzero(small)[-1])
                todo.append((q[: at + 1], e[:at], total))
                q, e, turns = q[at + 1 :], e[at + 1 :], 0
                continue
            if q[-1] > 1.5 * q[0]:  # the same values, graded the way the sweep likes
                q, e = q[::-1], e[::-1]
            # smallest eigenvalue of the last two rows: an upper bound that is close near the end
            tail = q[-1] + e[-1] + q[-2]
            root = max(0.0, tail * tail - 4 * q[-1] * q[-2])
            guess = 2 * q[-1] * q[-2] / (tail + math.sqrt(root)) if tail > 0 else 0.0
            step = None
            for part in (1 - 1e-3, 0.75, 0.4, 0.1):
                step = _dqds(q, e, part * guess) if guess > 0 else None
                if step is not None:
                    total += part * guess
                    break
            if step is None:
                step = _dqds(q, e, 0.0)
            if step is None:  # cannot happen for non-negative q and e; ends the loop if it does
                step = (np.maximum(q, 0), np.zeros(len(e)), 0.0)
            q, e = step[0], step[1]
            turns += 1
    return np.sort(np.maximum(np.array(found), 0))[::-1] * scale * scale


def twisted(a: np.ndarray, b: np.ndarray, value: float, choice: int = 0) -> np.ndarray:
    """Unit direction of the bidiagonal for the squared singular value ``value``.

    The stationary transform factorises ``B.T B - value`` from the top and the progressive one from the
    bottom; they are joined at the row whose residual is the ``choice``-th smallest.
    """
    q, e, off, n = a * a, b * b, a[:-1] * b, len(a)
    tiny = EPS * EPS * max(q.max(), value, 1e-300)
    pivot = lambda x: x if abs(x) > tiny else math.copysign(tiny, x)
    s, low = np.empty(n), np.empty(n - 1)
    s[0] = -value
    for i in range(n - 1):
        d = pivot(s[i] + q[i])
        low[i] = off[i] / d
        s[i + 1] = e[i] * s[i] / d - value
    p, up = np.empty(n), np.empty(n - 1)
    p[-1] = q[-1] - value
    for i in range(n - 2, -1, -1):
        d = pivot(e[i] + p[i + 1])
        up[i] = off[i] / d
        p[i] = (p[i + 1] * q[i] / d if e[i] else q[i]) - value
    r = int(np.argsort(np.abs(s + p + value), kind="stable")[min(choice, n - 1)])
    z = np.zeros(n)
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -low[i] * z[i + 1]
    for i in range(r, n - 1):
        z[i + 1] = -up[i] * z[i]
    return z / np.linalg.norm(z)


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Orthonormal columns, one per squared singular value in ``values`` (falling).

    Values closer than a thousandth share a group, within which directions are made orthogonal: a twist
    at another row, or inverse iteration, gives one that the group lacks, and a rotation inside the
    group's plane makes them singular directions again.
    """
    t = np.diag(a * a) + np.diag(np.r_[0.0, b * b]) + np.diag(a[:-1] * b, 1) + np.diag(a[:-1] * b, -1)
    out, start = np.zeros((len(a), len(values))), 0
    for i, value in enumerate(values):
        if i and values[i - 1] - value > 1e-3 * values[i - 1]:
            start = i
        near = out[:, start:i]
        for choice in range(len(a) + 1):
            if choice < len(a):
                z = twisted(a, b, value, choice)
            else:
                z = np.random.default_rng(i).standard_normal(len(a))
                for _ in range(4):
                    z -= near @ (near.T @ z)
                    z = np.linalg.solve(t - (value * (1 + 4 * EPS)) * np.eye(len(a)), z / np.linalg.norm(z))
                    z /= np.linalg.norm(z)
            z = z - near @ (near.T @ z)
            size = np.linalg.norm(z)
            if size > 0.05 or choice == len(a):
                z /= size
                z -= near @ (near.T @ z)
                out[:, i] = z / np.linalg.norm(z)
                break
        if i > start:
            group = out[:, start : i + 1]
            _, turn = np.linalg.eigh(group.T @ t @ group)
            out[:, start : i + 1] = group @ turn[:, ::-1]
    return out


def components_of(r: np.ndarray, n: int, wanted: int) -> tuple[np.ndarray, np.ndarray, float]:
    """``(variances, directions in columns, total variance)`` of rows whose triangle is ``r``; a variance
    that is zero up to rounding has no component."""
    a, b, v = bidiagonalise(r)
    squares = singular_squares(a, b)
    total = float((r * r).sum())
    keep = int((squares[:wanted] > (len(a) * EPS) ** 2 * total).sum())
    found = v @ directions(a, b, squares[:keep]) if keep else np.zeros((len(a), 0))
    top = np.abs(found).argmax(axis=0)
    found = found * np.where(found[top, np.arange(keep)] < 0, -1.0, 1.0)
    return squares[:keep] / n, found, total / n


# -- passes over the rows ---------------------------------------------------------------------------------


def _points(vector: str) -> Column:
    """The grid point of a vector; null unless all its entries are finite and have a place on the grid."""
    cells = F.transform(F.col(vector), lambda c: c.cast("double"))
    # null fails the comparison, NaN is larger than any number
    fits = F.forall(cells, lambda c: F.coalesce(F.abs(c) < F.lit(LARGEST), F.lit(False)))
    x = F.transform(cells, lambda c: F.floor(c * F.lit(float(GRID))) + F.lit(OFFSET))
    return F.when((F.size(cells) > 0) & fits, x)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - sums / n``, exact but for the last rounding."""
    whole, rest = np.array([s // n for s in sums]), np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _triangles(n: int, sums: list[int]):
    d = len(sums)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for batch in batches:
            x = _matrix(batch.column(0), d)
            for i in range(0, len(x), BLOCK):
                r = np.linalg.qr(np.vstack([r, _centred(x[i : i + BLOCK], n, sums)]), mode="r")
        if len(r):
            yield _partial(r)

    return fold


def _partial(cells: np.ndarray) -> pa.RecordBatch:
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    return pa.record_batch([pa.array([part], pa.int64()), pa.array([cells.ravel()], pa.list_(pa.float64()))], names=["part", "cells"])


def _join_triangles(parts: list[np.ndarray], d: int) -> np.ndarray:
    r = np.zeros((0, d))
    for cells in parts:
        r = np.linalg.qr(np.vstack([r, cells.reshape(-1, d)]), mode="r")
    return r


def _moments(n: int, sums: list[int], scaled: np.ndarray):
    """Per task: rows, mean and centred products of the whitened values."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            w = _centred(_matrix(batch.column(0), len(sums)), n, sums) @ scaled
            if len(w):
                mean = w.mean(axis=0)
                parts.append(np.concatenate([[len(w)], mean, ((w - mean).T @ (w - mean)).ravel()]))
                parts = [_join_moments(parts, scaled.shape[1])]
        if parts:
            yield _partial(parts[0])

    return fold


def _join_moments(parts: list[np.ndarray], k: int) -> np.ndarray:
    rows, mean, products = 0.0, np.zeros(k), np.zeros((k, k))
    for cells in parts:
        m, other = cells[0], cells[1 : k + 1]
        gap = other - mean
        products = products + cells[k + 1 :].reshape(k, k) + np.outer(gap, gap) * (rows * m / (rows + m))
        mean = mean + gap * (m / (rows + m))
        rows += m
    return np.concatenate([[rows], mean, products.ravel()])


def _gathered(partials: DataFrame, join, size: int) -> np.ndarray | None:
    """One result from the tasks' partial results of ``size`` numbers: by a tree whose nodes join a few,
    of which the driver joins the last."""
    fan = max(2, min(FAN, (64 << 20) // (8 * size)))
    partials = materialise(partials, "partials")
    while partials.count() > fan:

        def node(key, pdf, join=join):
            import pandas as pd

            cells = join([np.array(c) for c in pdf.sort_values("part")["cells"]])
            return pd.DataFrame({"part": [key[0]], "cells": [cells.ravel()]})

        grouped = partials.groupBy(F.floor(F.col("part") / fan).alias("node"))
        partials = materialise(grouped.applyInPandas(node, "part long, cells array<double>"), "partials")
    rows = sorted(partials.collect())
    return join([np.array(r["cells"]) for r in rows]) if rows else None


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``(key, component, n, deviation, whitened, explained, identity_error)``, one row per vector and
    component, components numbered from 1 by falling variance.

    Vectors are put on the grid ``floor(64 c) + 1000000`` and fitted on the distinct grid points; a copy
    weighs nothing. ``deviation`` is the exact sum of ``(n x - sums)^2``, null beyond the range of a long.
    ``identity_error`` is the largest absolute entry of the fitted rows' whitened covariance minus the
    identity. The largest loading of a component is positive, so reruns agree in sign.

    A vector that is null or empty, holds a null, NaN or infinite entry or one of 2^31 or more, or whose
    length differs from the most frequent one (of equally frequent ones the longest), is left out. Repeated
    rows and null or repeated keys each give their own rows. Directions without variance give no component:
    equal vectors, one vector and an empty table give no rows. Other columns are not read. Long vectors cost
    the square of their length in each partial result and the cube on the driver.
    """
    outputs = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    if key in outputs:
        raise ValueError(f"the key needs a name other than {key}")
    spark = df.sparkSession
    ship_package(spark)
    rows = df.select(F.col(f"`{key}`").alias("key"), _points(f"`{vector}`").alias("x")).where("x IS NOT NULL")
    sizes = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("m"))
    d = sizes.agg(F.max_by("d", F.struct("m", "d"))).first()[0]
    kind = df.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if d is None:
        return spark.createDataFrame([], schema)
    rows = rows.where(F.size("x") == d)
    fit = materialise(rows.select("x").distinct(), "fit")
    n, *sums = fit.agg(F.count(F.lit(1)), *[F.sum(F.get("x", F.lit(i))) for i in range(d)]).first()

    partial = "part long, cells array<double>"
    r = _gathered(fit.mapInArrow(_triangles(n, sums), partial), lambda parts: _join_triangles(parts, d), d * d)
    variances, found, total = components_of(r, n, components)
    k = len(variances)
    if not k:
        return spark.createDataFrame([], schema)
    scaled = found / np.sqrt(variances)
    moments = _gathered(fit.mapInArrow(_moments(n, sums, scaled), partial), lambda parts: _join_moments(parts, k), k * k)
    identity_error = float(np.abs(moments[k + 1 :].reshape(k, k) / n - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, rest = np.array([s // n for s in sums]), np.array([s % n for s in sums])
        for batch in batches:
            x = _matrix(batch.column("x"), d)
            gap = x - whole
            if len(x) and d * (n * (int(np.abs(gap).max()) + 1)) ** 2 >= 1 << 63:
                exact = [sum((n * int(g) - int(s)) ** 2 for g, s in zip(line, rest)) for line in gap]
                deviation = pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())
            else:
                deviation = pa.array(((n * gap - rest) ** 2).sum(axis=1), pa.int64())
            w = _centred(x, n, sums) @ scaled
            cells = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, k), pa.int32()), pa.array(w.ravel()))
            yield pa.record_batch([batch.column("key"), deviation, cells], names=["key", "deviation", "w"])

    wide = rows.mapInArrow(project, f"key {kind}, deviation long, w array<double>")
    explained = F.array(*[F.lit(float(v / total)) for v in variances])
    long = wide.select("key", "deviation", F.posexplode("w").alias("i", "whitened"))
    return long.select(
        F.col("key").alias(key), (F.col("i") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("i")).alias("explained"), F.lit(identity_error).alias("identity_error"),
    )


def whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whiten(read(spark, sf, "embeddings"))
