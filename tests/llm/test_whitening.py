"""Whitening against plain linear algebra on the whole matrix."""

import math

import numpy as np
import pytest

from gaugeflow.llm import whitening
from gaugeflow.llm.common import read

SCHEMA = "vec_id long, embedding array<double>, w string, part long, x long"


def _frame(spark, vectors):
    rows = [(i, None if v is None else [None if c is None else float(c) for c in v], "w", 1, 2) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def _plain(vectors):
    x = [[math.floor(64 * c) + 1000000 for c in v] for v in vectors]
    fit = np.array(sorted(set(map(tuple, x))))
    v = np.cov(fit.T, bias=True).reshape(fit.shape[1], -1)
    e, u = np.linalg.eigh(v)
    return np.array(x), fit, e[::-1], u[:, ::-1], np.trace(v)


@pytest.mark.parametrize("seed", range(6))
def test_singular_values_and_directions(seed):
    rng = np.random.default_rng(seed)
    d = [1, 2, 3, 17, 40, 64][seed]
    r = np.linalg.qr(rng.standard_normal((d + 9, d)) * 10.0 ** rng.uniform(-3, 3, d), mode="r")
    if seed == 4:
        r[:, 5] = r[:, 6]  # one direction without variance
    a, b, v = whitening.bidiagonalise(r)
    squares = whitening.singular_squares(a, b)
    exact = np.linalg.svd(r, compute_uv=False)
    assert np.allclose(np.sqrt(squares), exact, rtol=1e-12, atol=1e-13 * exact[0])
    found = v @ whitening.directions(a, b, squares[: min(16, d - (seed == 4))])
    k = found.shape[1]
    assert np.abs(found.T @ found - np.eye(k)).max() < 1e-10
    assert np.abs(r.T @ (r @ found) - found * squares[:k]).max() < 1e-12 * squares[0] * d


def test_equal_singular_values():
    for r in (np.eye(20), np.diag([3.0] * 10 + [2.0] * 10), np.triu(np.ones((20, 20)) * 0) + 5 * np.eye(20)):
        values, found, total = whitening.components_of(r, 7, 16)
        assert np.abs(found.T @ found - np.eye(16)).max() < 1e-12 and total == pytest.approx((r * r).sum() / 7)
        assert np.abs(r.T @ r @ found - found * values * 7).max() < 1e-12


def test_small_values_are_accurate():
    """A graded bidiagonal: the smallest value keeps its digits although the largest is 1e12 times larger."""
    a, b = 10.0 ** np.arange(0, -13, -1.0), np.full(12, 1e-14)
    assert np.allclose(np.sqrt(whitening.singular_squares(a, b)), a, rtol=1e-10)


def test_against_plain(spark):
    rng = np.random.default_rng(3)
    vectors = [list(rng.standard_normal(20) * np.linspace(0.2, 2, 20)) for _ in range(300)]
    kept = vectors + [vectors[0]] * 150
    frame = _frame(spark, [*kept, None, [], [None] * 20, [math.nan] * 20, [math.inf] + [0.0] * 19, [1.0] * 7])
    out = whitening.whiten(frame).toPandas()
    x, fit, e, u, trace = _plain(kept)
    n, sums = len(fit), fit.sum(axis=0)
    assert len(out) == len(kept) * 16 and set(out["vec_id"]) == set(range(len(kept))) and (out["n"] == n).all()
    wide = out.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    plain = (x - sums / n) @ u[:, :16] / np.sqrt(e[:16])
    sign = np.sign((wide * plain).sum(axis=0))
    assert np.abs(wide - plain * sign).max() < 1e-8
    deviation = out.drop_duplicates("vec_id").set_index("vec_id")["deviation"].sort_index()
    assert list(deviation) == [int(((n * line - sums) ** 2).sum()) for line in x]
    explained = out.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(explained, e[:16] / trace, rtol=1e-10) and out["identity_error"].max() < 1e-9


def test_reduction_tree_agrees(spark, monkeypatch):
    rng = np.random.default_rng(8)
    frame = _frame(spark, [list(rng.standard_normal(6)) for _ in range(200)]).repartition(40)
    one = whitening.whiten(frame).orderBy("vec_id", "component").toPandas()
    monkeypatch.setattr(whitening, "FAN", 2)
    two = whitening.whiten(frame).orderBy("vec_id", "component").toPandas()
    assert np.allclose(one["whitened"], two["whitened"], atol=1e-10)


def test_edges(spark):
    schema = whitening.whiten(_frame(spark, [])).schema
    assert whitening.whiten(_frame(spark, [])).count() == 0
    for vectors in ([[1.0, 2.0]], [[1.0, 2.0]] * 9, [None, []]):
        found = whitening.whiten(_frame(spark, vectors))
        assert found.count() == 0 and found.schema.simpleString() == schema.simpleString()
    line = whitening.whiten(_frame(spark, [[0.0, 5.0], [1.0, 5.0], [2.0, 5.0], [1e300, 1.0]])).toPandas()
    assert len(line) == 3 and sorted(line["whitened"].round(6)) == [-1.224745, 0, 1.224745]
    far = whitening.whiten(_frame(spark, [[2e9], [-2e9], [0.0]])).toPandas()  # squares beyond a long
    assert far["deviation"].isna().sum() == 2


def test_whole_table(spark, sf):
    out = whitening.whitening(spark, sf)
    n = read(spark, sf, "embeddings").where("embedding IS NOT NULL").count()
    assert out.count() == 16 * n and out.agg({"identity_error": "max"}).first()[0] < 1e-9
