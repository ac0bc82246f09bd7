"""Principal components of wide tables by a random block Krylov space."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.partials import gather, partial_rows, rows_of
from ..session import ship_package

#: Directions beyond those wanted that a block carries.
SPARE = 8


class Components(NamedTuple):
    """Mean, components in columns (largest loading positive), their variances, and the variance of all."""

    mean: np.ndarray
    directions: np.ndarray
    variances: np.ndarray
    total: float


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, mean, square = 0, 0.0, 0.0
    for batch in batches:
        x = rows_of(batch)
        if len(x):
            own, m = x.mean(axis=0), len(x)
            gap = own - mean
            square = square + ((x - own) ** 2).sum() + (gap * gap).sum() * n * m / (n + m)
            mean, n = mean + gap * (m / (n + m)), n + m
    if n:
        yield partial_rows([(0, np.concatenate([[n, square], mean]))])


def _join_sums(_, parts):
    n, square, mean = 0.0, 0.0, 0.0
    for p in parts:
        gap, m = p[2:] - mean, p[0]
        square += p[1] + (gap * gap).sum() * n * m / (n + m)
        mean, n = mean + gap * (m / (n + m)), n + m
    return np.concatenate([[n, square], mean])


def _product(mean: np.ndarray, block: np.ndarray):
    """Per task, the centred rows' product with themselves and the block, never as wide as it is long."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros_like(block)
        for batch in batches:
            x = rows_of(batch)
            if len(x):
                x = x - mean
                out += x.T @ (x @ block)
        yield partial_rows([(0, out)])

    return fold


def fit_components(df: DataFrame, k: int, features: str = "features", tol: float = 1e-9, seed: int = 42) -> Components:
    """The first ``k`` principal components of a vector column.

    Each turn is one scan that multiplies a block of ``k + SPARE`` directions by the covariance matrix, which
    is itself never formed: a task and the driver hold ``width * (k + SPARE)`` numbers per turn. The space of
    all blocks so far is searched for the best directions, until each is an eigenvector within ``tol`` of the
    largest variance or the space is the whole. Null rows and rows with NaN are left out; a constant column
    has loading 0; components without variance are left out.
    """
    ship_package(df.sparkSession)
    x = df.where(F.col(features).isNotNull()).select(vector_to_array(F.col(features)).alias("x"))
    found = gather(x, _sums, _join_sums)
    if not found or found[0][0] < 2:
        raise ValueError("need two rows at least")
    n, total, mean = found[0][0], found[0][1], found[0][2:]
    d = len(mean)
    multiply = lambda block: gather(x, _product(mean, block), lambda _, parts: np.sum(parts, axis=0))[0].reshape(block.shape) / (n - 1)
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, min(d, k + SPARE))))[0]
    space, images = np.zeros((d, 0)), np.zeros((d, 0))
    while True:
        image = multiply(block)
        space, images = np.hstack([space, block]), np.hstack([images, image])
        small = space.T @ images
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1][:k], turn[:, ::-1][:, :k]
        best = space @ turn
        rest = np.linalg.norm(images @ turn - best * values, axis=0)
        if space.shape[1] >= d or rest.max() <= tol * max(values[0], 1e-300):
            break
        block = image
        for _ in range(2):
            block = block - space @ (space.T @ block)
        u, size, _ = np.linalg.svd(block, full_matrices=False)
        block = u[:, size > 1e-12 * max(values[0], 1e-300)][:, : d - space.shape[1]]
        block = np.linalg.qr(block - space @ (space.T @ block))[0] if block.size else block
        if not block.shape[1]:
            break  # the space holds all rows
    keep = values > 1e-13 * max(total / (n - 1), 1e-300)
    best, values = best[:, keep], values[keep]
    top = np.abs(best).argmax(axis=0)
    best = best * np.where(best[top, np.arange(best.shape[1])] < 0, -1.0, 1.0)
    return Components(mean, best, values, total / (n - 1))


def project(df: DataFrame, found: Components, features: str = "features", output: str = "pc") -> DataFrame:
    """Add the array ``output`` of each row's centred coordinates on the components; null for a null vector
    or one with a null or NaN."""
    mean, directions = found.mean, found.directions

    @F.arrow_udf("array<double>")
    def coordinates(vectors: pa.Array) -> pa.Array:
        there = vectors.is_valid().to_numpy(zero_copy_only=False)
        cells = vectors.filter(pa.array(there)).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(mean))
        places = np.full((len(vectors), directions.shape[1]), np.nan)
        places[there] = (cells - mean) @ directions
        gone = ~there
        gone[there] = np.isnan(cells).any(axis=1)
        edges = np.arange(len(vectors) + 1, dtype=np.int32) * np.int32(directions.shape[1])
        return pa.ListArray.from_arrays(pa.array(edges), pa.array(places.ravel()), mask=pa.array(gone))

    return df.withColumn(output, coordinates(F.when(F.col(features).isNotNull(), vector_to_array(F.col(features)))))
