"""Linear models from moments: one scan gives each fold's means and centred products, from which every
penalty and every left-out fold is solved without reading the rows again."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.schema import quoted
from ..session import ship_package
from ..operators.partials import gather, partial_rows, rows_of


class Moments(NamedTuple):
    """Rows, means and centred products of the features and, last, the label."""

    n: float
    mean: np.ndarray
    products: np.ndarray

    def cells(self) -> np.ndarray:
        return np.concatenate([[self.n], self.mean, self.products.ravel()])


def from_cells(cells: np.ndarray, width: int) -> Moments:
    return Moments(float(cells[0]), cells[1 : width + 1], cells[width + 1 :].reshape(width, width))


def merged(parts: Sequence[Moments]) -> Moments:
    """Moments of all rows of the parts; merging loses no digits to a large common mean."""
    n, mean, products = 0.0, np.zeros_like(parts[0].mean), np.zeros_like(parts[0].products)
    for part in parts:
        if not part.n:
            continue
        gap, total = part.mean - mean, n + part.n
        products = products + part.products + np.outer(gap, gap) * (n * part.n / total)
        mean = mean + gap * (part.n / total)
        n = total
    return Moments(n, mean, products)


def _measure(width: int):
    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Moments] = {}
        for batch in batches:
            rows = rows_of(batch)
            for key in np.unique(rows[:, -1]) if len(rows) else ():
                x = rows[rows[:, -1] == key, :-1]
                mean = x.mean(axis=0)
                part = Moments(float(len(x)), mean, (x - mean).T @ (x - mean))
                held[int(key)] = merged([held[int(key)], part]) if int(key) in held else part
        if held:
            yield partial_rows((key, m.cells()) for key, m in held.items())

    return fold


def fold_moments(df: DataFrame, features: Sequence[str], label: str, fold: str | None = None) -> dict[int, Moments]:
    """Moments by fold (all rows are fold 0 without one), in one scan. Rows in which a feature, the label or
    the fold is null or NaN are left out. A task holds one matrix per fold, as wide as the features."""
    ship_package(df.sparkSession)
    cells = [F.col(quoted(c)).cast("double") for c in (*features, label)]
    number = F.lit(0.0) if fold is None else F.col(quoted(fold)).cast("double")
    width = len(cells)
    join = lambda key, parts: merged([from_cells(p, width) for p in parts]).cells()
    found = gather(df.select(F.array(*cells, number).alias("x")), _measure(width), join)
    return {key: from_cells(part, width) for key, part in sorted(found.items())}


def elastic_net(m: Moments, penalty: float, mix: float, tol: float = 1e-12, max_iter: int = 100_000) -> tuple[np.ndarray, float]:
    """``(coefficients, intercept)`` that minimise half the mean squared error plus
    ``penalty * (mix * |w| + (1 - mix) / 2 * w^2)``, label and features in units of their deviation.

    Coordinate descent on the moments; with the population deviation this is the objective of Spark's linear
    regression with standardisation. A constant feature has no coefficient; a constant label gives its mean.
    """
    spread = np.sqrt(np.maximum(np.diag(m.products) / m.n, 0))
    x, y = spread[:-1], spread[-1]
    w = np.zeros(len(x))
    if y > 0:
        used = x > 0
        scale = np.where(used, x, 1)
        gram = m.products[:-1, :-1] / m.n / np.outer(scale, scale)
        right = m.products[:-1, -1] / m.n / (scale * y)
        lasso, ridge = penalty / y * mix, penalty / y * (1 - mix)
        for _ in range(max_iter):
            most = 0.0
            for j in np.flatnonzero(used):
                pull = right[j] - gram[j] @ w + gram[j, j] * w[j]
                new = math.copysign(max(abs(pull) - lasso, 0.0), pull) / (gram[j, j] + ridge)
                most = max(most, abs(new - w[j]))
                w[j] = new
            if most <= tol:
                break
        w = np.where(used, w * y / scale, 0.0)
    return w, float(m.mean[-1] - m.mean[:-1] @ w)


def squared_error(m: Moments, coefficients: Sequence[float], intercept: float) -> float:
    """Sum of squared errors of a linear model on the rows of ``m``."""
    v = np.append(-np.asarray(coefficients, float), 1.0)
    return float(v @ m.products @ v + m.n * (m.mean @ v - intercept) ** 2)


class Setting(NamedTuple):
    penalty: float
    mix: float
    fold_rmse: tuple[float, ...]

    @property
    def rmse(self) -> float:
        return sum(self.fold_rmse) / len(self.fold_rmse)


def search(
    df: DataFrame, features: Sequence[str], label: str, fold: str, penalties: Sequence[float], mixes: Sequence[float]
) -> list[Setting]:
    """Cross-validated error of every setting, penalties outermost: fitted on all folds but one, measured on
    that one. The rows are read once, however many folds and settings there are."""
    folds = fold_moments(df, features, label, fold)
    if len(folds) < 2:
        raise ValueError("need rows in two folds at least")
    out = []
    for penalty in penalties:
        for mix in mixes:
            errors = []
            for left, own in folds.items():
                model = elastic_net(merged([m for key, m in folds.items() if key != left]), penalty, mix)
                errors.append(math.sqrt(max(squared_error(own, *model), 0.0) / own.n))
            out.append(Setting(penalty, mix, tuple(errors)))
    return out
