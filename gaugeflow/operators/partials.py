"""Sums of arrays over a table: one partial result per task and key, joined by a tree."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise

#: Partial results of so many tasks meet in one task of the tree, and at most so many at the driver.
FAN = 32
SCHEMA = "key long, part long, cells array<double>"


def partial_rows(cells: Iterable[tuple[int, np.ndarray]]) -> pa.RecordBatch:
    """A task's results by key, as rows of ``SCHEMA``."""
    from pyspark import TaskContext

    keys, arrays = zip(*cells)
    part = TaskContext.get().partitionId()
    return pa.record_batch(
        [pa.array(keys, pa.int64()), pa.array([part] * len(keys), pa.int64()), pa.array([a.ravel() for a in arrays], pa.list_(pa.float64()))],
        names=["key", "part", "cells"],
    )


def gather(
    df: DataFrame, fold: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    join: Callable[[int, list[np.ndarray]], np.ndarray], tasks: int | None = None, fan: int = FAN,
) -> dict[int, np.ndarray]:
    """One array per key: ``fold`` turns a task's batches into :func:`partial_rows`, ``join(key, arrays)``
    merges some of them.

    Up to ``fan`` tasks it is a single job; beyond, tasks merge ``fan`` neighbours at a time, so neither a
    task nor the driver ever holds more than ``fan`` results of a key. ``tasks`` is the most that ``df`` has; if
    not given, it is asked for, which runs the shuffles that ``df`` still has before it.
    """
    partials = df.mapInArrow(fold, SCHEMA)
    tasks = tasks or df.rdd.getNumPartitions()
    while tasks > fan:

        def node(key, pdf):
            cells = join(int(key[0]), [np.asarray(c) for c in pdf.sort_values("part")["cells"]])
            return pd.DataFrame({"key": [key[0]], "part": [key[1]], "cells": [cells.ravel()]})

        grouped = partials.groupBy("key", F.floor(F.col("part") / fan).alias("part"))
        partials = materialise(grouped.applyInPandas(node, SCHEMA), "partials")
        tasks = -(-tasks // fan)
    found: dict[int, list] = {}
    for row in partials.collect():
        found.setdefault(row["key"], []).append((row["part"], np.asarray(row["cells"])))
    return {key: join(key, [c for _, c in sorted(parts, key=lambda p: p[0])]) for key, parts in found.items()}


def rows_of(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The complete rows of an array column as a matrix; null rows and rows with null or NaN are left out."""
    lists = batch.column(column)
    lists = lists.filter(lists.is_valid())
    if not len(lists):
        return np.zeros((0, 0))
    lengths = np.asarray(lists.value_lengths())
    if (lengths != lengths[0]).any():
        raise ValueError("vectors differ in length")
    x = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), -1)
    return x[~np.isnan(x).any(axis=1)]
