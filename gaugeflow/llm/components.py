"""Connected components of an edge table: stars within a task, then alternating stars by joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise, release

#: Edges that a task looks at together. More are taken in turns, which costs rounds but nothing else.
TOGETHER = 1 << 19
#: A node with more edges than this is met by them without moving them.
HUB = 1 << 16


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from the smallest node of each component of ``(u, v)`` to each other node of it."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[a] != root[b]).any():
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]
    other = root != np.arange(len(nodes))
    return nodes[root[other]], nodes[other]


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def row():
        u, v = stars(*(np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("u", "v")))
        return pa.record_batch([pa.array(u), pa.array(v)], names=["u", "v"])

    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= TOGETHER:
            yield row()
            held, n = [], 0
    if n:
        yield row()


def _contracted(edges: DataFrame) -> tuple[DataFrame, int]:
    """The edges as stars of the tasks that look at them, and the number of tasks that were enough for all."""
    own = materialise(edges.select("u", "v").mapInArrow(_contract, "u long, v long"), "edges")
    rows = own.count()
    tasks = -(-rows // TOGETHER)
    if own.rdd.getNumPartitions() > max(1, tasks):  # fewer tasks, each still with a bounded number of edges
        fewer = materialise(own.coalesce(max(1, tasks)).mapInArrow(_contract, "u long, v long"), "edges")
        release(own)
        own = fewer
    return own, tasks


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node hangs on one root at most, and no root on any."""
    twice = edges.groupBy("v").agg(F.count(F.lit(1)).alias("hangs")).where("hangs > 1")
    return twice.isEmpty() and edges.select(F.col("u").alias("root")).distinct().join(edges.select("v"), F.col("root") == F.col("v"), "left_semi").isEmpty()


def _with_least(edges: DataFrame, node: str, least: DataFrame) -> DataFrame:
    """``edges`` with the ``m`` of their ``node``. Nodes of very many edges are few, at most one in ``HUB``
    edges, and meet their edges where these lie."""
    hubs = least.where(F.col("degree") > HUB).select(node, "m")
    others = least.where(F.col("degree") <= HUB).select(node, "m")
    return edges.join(others, node).unionByName(edges.join(F.broadcast(hubs), node))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)``: the smallest node reachable from each node of ``(u, v)`` (longs, any order).

    Each task first turns the edges it has into stars; as many tasks look at the stars again as their number
    asks for, so a table of up to ``TOGETHER`` edges is finished by one bounded task. Otherwise a round hangs
    every larger neighbour of a node on the smallest one, then every smaller one too, and the tasks turn what
    they get into stars again, until the whole table is stars. The sum of the nodes over all edges falls in
    each round, so it ends; rounds are about log2 of the longest path at most, and few where tasks see many
    edges. The smallest neighbour comes from an aggregate, and edges of a node with more than ``HUB`` of them
    stay where they are for it. A round's table is deleted once the next is written.
    """
    own, tasks = _contracted(edges.where("u != v").distinct())
    while tasks > 1 and not _are_stars(own):
        before = own
        both = own.union(own.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count(F.lit(1)).alias("degree"))
        large = _with_least(both, "u", least).where("v > u").select(F.col("m").alias("u"), "v").where("u != v").distinct()
        # small star: u < v, so a node's smaller neighbours are the rows in which it stands on the right
        least = large.groupBy("v").agg(F.min("u").alias("m"), F.count(F.lit(1)).alias("degree"))
        small = _with_least(large, "v", least)
        hung = small.select(F.col("m").alias("u"), "v").union(small.select(F.col("m").alias("u"), F.col("u").alias("v")))
        own, tasks = _contracted(hung.where("u != v").distinct())
        release(before)
    roots = own.select(F.col("u").alias("node"), F.col("u").alias("component")).distinct()
    return own.select(F.col("v").alias("node"), F.col("u").alias("component")).union(roots)
