"""Near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pytest

from gaugeflow.llm import projection_forest
from gaugeflow.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, v string, row int, node string"


def _frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else [None if x is None else float(x) for x in v], 1, "a", 2, "b") for k, v in rows], SCHEMA).repartition(6)


def _unit(x):
    return x / np.linalg.norm(x, axis=-1, keepdims=True)


def _groups(rng, d, sizes, noise):
    return np.concatenate([_unit(_unit(rng.standard_normal(d)) + rng.standard_normal((n, d)) * noise / math.sqrt(d)) for n in sizes])


def _plain(vectors, cosine=0.95):
    v = _unit(np.array(vectors, np.float32).astype(float))
    near = v @ v.T >= cosine
    np.fill_diagonal(near, False)
    root = np.arange(len(v))
    while True:
        least = np.minimum(root, np.where(near, root[None, :], len(v)).min(axis=1))
        if (least == root).all():
            return near, root
        root = least


def _check(found, near, root, least=1.0):
    assert sorted(found["vec_id"]) == list(range(len(root)))
    found = found.set_index("vec_id").sort_index()
    links = near.sum(axis=1)
    assert (found["n_links"] <= links).all() and found["n_links"].sum() >= least * links.sum()
    if least == 1.0:
        assert (found["component_id"] == root).all()
    assert (found["kept"] == (found["component_id"] == found.index)).all()


@pytest.mark.parametrize("leaf", [64, 1024])
def test_against_all_pairs(spark, leaf):
    """Copies from two to hundreds, loose groups at the threshold, and vectors in reach of a large group."""
    rng = np.random.default_rng(leaf)
    tight = _groups(rng, 64, [500, 60, 20, 5, 2, 2, 2], 0.12)
    loose = _groups(rng, 64, [80, 30, 10, 3, 3], 0.23)  # about half of the pairs are links
    exact = np.repeat(_unit(rng.standard_normal((2, 64))), [300, 4], axis=0)
    around = _unit(tight[0] + rng.standard_normal((40, 64)) * 0.28 / 8)
    alone = _unit(rng.standard_normal((900, 64)))
    vectors = rng.permutation(np.concatenate([tight, loose, exact, around, alone])) * rng.uniform(0.1, 9, (1961, 1))
    near, root = _plain(vectors)
    found = projection_forest.link(_frame(spark, enumerate(vectors)), leaf=leaf).toPandas()
    _check(found, near, root, 0.97)
    assert (found.set_index("vec_id").sort_index()["component_id"].to_numpy() == root).mean() > 0.99


def test_edges(spark):
    inf, nan = math.inf, math.nan
    rows = [
        (1, [1, 0, 0]), (2, [2, 0, 0]), (2, [0, 1, 0]), (3, [0, 0, 0]), (4, None), (5, [None, 1, 0]), (6, [inf, 0, 0]),
        (7, [nan, 0, 0]), (8, []), (9, [1, 0]), (None, [0, 0, 1]), (None, [0, 0, 2]), (11, [0, 0, 1e30]), (None, None), (12, [1e-30, 0, 0]),
    ]
    found = projection_forest.link(_frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == sorted(
        [(1, 2, 1, True), (2, 2, 1, False), (2, 0, 2, True), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 0, 6, True), (7, 0, 7, True),
         (8, 0, 8, True), (9, 0, 9, True), (None, 2, 11, False), (None, 2, 11, False), (11, 2, 11, True), (None, 0, None, True), (12, 2, 1, False)],
        key=str,
    )
    empty = projection_forest.link(_frame(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "n_links", "component_id", "kept"]


def test_one_group_is_the_table(spark):
    """Equal vectors beyond a leaf, and near copies of one vector: no split parts them for good."""
    rng = np.random.default_rng(1)
    for vectors in (np.repeat(rng.standard_normal((1, 8)), 700, axis=0), _groups(rng, 64, [700], 0.1)):
        near, root = _plain(vectors)
        _check(projection_forest.link(_frame(spark, enumerate(vectors)), leaf=50).toPandas(), near, root)


def test_components_in_several_tasks(spark, monkeypatch):
    """Rounds of joins, hubs included, give what one task gives."""
    from gaugeflow.llm import components as module

    rng = np.random.default_rng(2)
    edges = [(0, i) for i in range(1, 200)] + [(i, i + 1) for i in range(300, 380)] + [tuple(map(int, rng.integers(400, 700, 2))) for _ in range(200)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(7)
    one = sorted(map(tuple, components(frame).collect()))
    monkeypatch.setattr(module, "TOGETHER", 40)
    monkeypatch.setattr(module, "HUB", 20)
    assert sorted(map(tuple, components(frame).collect())) == one
