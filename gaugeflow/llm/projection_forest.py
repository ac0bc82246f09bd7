"""Near-duplicate embeddings by a forest of random-projection trees.

A node that holds too many vectors is split by random directions, at thresholds learned from a bounded
sample of its own vectors, and vectors near a threshold go to both sides (spill). All nodes of all trees are
split side by side, level by level, so the forest is a table and grows with the data. Vectors that share a
leaf are compared in double precision; links are united to components.

Large groups of near copies would be cut by any split, and their pairs grow with the square of their size.
A first tree without spill finds them as balls: within half the threshold's angle of one centre all pairs are
links by the triangle inequality, so a ball is counted and not compared. Vectors outside a ball that may
reach into it are compared with its members in blocks. Each pair is counted once: in its ball, else in the
first block, else in the first leaf that both are in.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, release, ship_package
from .common import read, runs
from .components import components, stars
from .hashing import mix

#: Cosine of a link, trees, and vectors in a leaf.
COSINE, TREES, LEAF = 0.95, 6, 1024
#: Vectors of a node's sample (expected), levels split at once, and the smallest part of a sample that is a leaf.
SAMPLE, LEVELS, FEW = 2048, 5, 24
#: Vectors of a node that are routed together.
PART = 1024
#: Half-width of the spill around a threshold, and the largest part of a node that spills.
MARGIN, SPILLED = 0.02, 0.2
#: Members of a ball in a node's sample, and balls found in a node at once; others are found in later rounds.
CORE, BALLS = 16, 16
ROW = "row long, v array<double>"


def _points(column) -> np.ndarray:
    cells = column.flatten().to_numpy(zero_copy_only=False) if isinstance(column, pa.Array) else np.concatenate([np.asarray(x) for x in column])
    return cells.reshape(len(column), -1)


def _units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of length 1; null where one has no direction."""
    for batch in batches:
        lists = batch.column("v")
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        out: list[np.ndarray | None] = [None] * len(lists)
        for size in np.unique(sizes[sizes > 0]):
            rows = np.flatnonzero(sizes == size)
            v = _points(lists.take(pa.array(rows)))  # a null entry becomes NaN
            top = np.abs(v).max(axis=1)
            sound = np.isfinite(top) & (top > 0)
            v = v[sound] / top[sound, None]  # keeps squares in range
            for row, unit in zip(rows[sound], v / np.linalg.norm(v, axis=1)[:, None]):
                out[row] = unit
        yield pa.record_batch([batch.column("key"), pa.array(out, pa.list_(pa.float64()))], names=["key", "v"])


def _directions(node: int, levels: int, d: int) -> np.ndarray:
    """Unit directions of a node's next levels, one per level, from the node's number alone."""
    rng = np.random.default_rng(int(node) & ((1 << 63) - 1))
    u = rng.standard_normal((levels, d))
    return u / np.linalg.norm(u, axis=1)[:, None]


def _child(node: np.ndarray | int, turn: np.ndarray | int) -> np.ndarray:
    """The number of a node's child; 62 bits of a hash, so that nodes of all trees differ."""
    with np.errstate(over="ignore"):
        x = mix(np.asarray(node, np.int64).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.asarray(turn).astype(np.uint64) + np.uint64(1))
    return (x >> np.uint64(2)).astype(np.int64)


def _shaken(p: np.ndarray, row: np.ndarray, node: int) -> np.ndarray:
    """Projections plus a part in 10^9 that depends on the row, so that equal vectors can be parted."""
    return p + _child(row, node & 0xFFFF) * (1e-9 / 2**62)


def _threshold(p: np.ndarray, spill: bool) -> tuple[float, float]:
    """A threshold in the middle part of the projections where they are thinnest, and its half-width."""
    p = np.sort(p)
    n = len(p)
    cuts = p[np.linspace(int(0.3 * n), int(0.7 * n), 17).astype(int)]
    inside = lambda c, w: np.searchsorted(p, c + w, "right") - np.searchsorted(p, c - w)
    crowd = np.array([inside(c, MARGIN) for c in cuts])
    cut = float(cuts[np.lexsort((np.abs(np.arange(17) - 8), crowd))[0]])
    width = MARGIN
    if spill:
        while width > 1e-12 and inside(cut, width) > SPILLED * n:
            width *= 0.7
    return cut, width if spill and width > 1e-12 else 0.0


def _balls(v: np.ndarray, cosine: float) -> list[np.ndarray]:
    """Centres within half the link's angle of which many of the sample lie, densest first."""
    within, out = math.cos(math.acos(cosine) / 2 * 0.999), []
    free = np.ones(len(v), bool)
    near = v @ v.T >= cosine
    while len(out) < BALLS:
        count = (near & free[None, :]).sum(axis=1) * free
        at = int(count.argmax())
        if count[at] < CORE:
            break
        centre = v[near[at] & free].mean(axis=0)
        centre /= np.linalg.norm(centre)
        own = (v @ centre >= within) & free
        free &= ~(own | near[at])
        if own.sum() >= CORE:
            out.append(centre)
    return out


def _learner(cosine: float, spill: bool, leaf: int):
    """From a node's sample to ``centres`` (balls) and ``cuts``: a threshold and a half-width for each inner
    node of the next levels, in heap order; NaN ends a branch."""

    def learn(key, pdf):
        node, v, row = int(key[0]), _points(pdf["v"]), pdf["row"].to_numpy()
        centres = [] if spill else _balls(v, cosine)
        rest = np.ones(len(v), bool)
        for c in centres:
            rest &= v @ c < math.cos(math.acos(cosine) / 2 * 0.999)
        v, row = v[rest], row[rest]
        part = leaf * len(pdf) / max(1, int(pdf["n"].iloc[0]))  # so many of the sample stand for a leaf
        u = _directions(node, LEVELS, pdf["v"].iloc[0].size)
        cuts = np.full(((1 << LEVELS) - 1, 2), np.nan)
        groups = {0: np.arange(len(v))}
        for level in range(LEVELS):
            onward: dict[int, np.ndarray] = {}
            for at, rows in groups.items():
                if len(rows) <= max(part, FEW):
                    continue
                p = _shaken(v[rows] @ u[level], row[rows], node)
                cut, width = _threshold(p, spill)
                cuts[at] = cut, width
                onward[2 * at + 1], onward[2 * at + 2] = rows[p <= cut + width], rows[p > cut - width]
            groups = onward
        return pd.DataFrame({"node": [node], "centres": [np.concatenate(centres) if centres else np.zeros(0)], "cuts": [cuts.ravel()]})

    return learn


def _router(cosine: float):
    """Rows ``(row, v, node, centres, cuts)`` in which a head with centres and cuts comes before the vectors of
    its part of a node, to ``(row, v, node, kind)``: kind 0 goes on, 1 is a member of the ball ``node``, 2 may
    have links into it."""
    inner, reach = math.cos(math.acos(cosine) / 2 * 0.999), math.cos(min(math.pi, math.acos(cosine) * 1.5 + 1e-6))

    def places(v, row, node, centres, cuts):
        out, left = [], np.arange(len(v))
        to = lambda rows, turn, kind: out.append((rows, np.full(len(rows), _child(node, turn)), np.full(len(rows), kind, np.int32)))
        for i, c in enumerate(centres.reshape(-1, v.shape[1])):
            p = v[left] @ c
            to(left[p >= inner], 1 << 20 | i, 1)
            to(left[(p < inner) & (p >= reach)], 1 << 20 | i, 2)
            left = left[p < inner]
        cuts, u, groups = cuts.reshape(-1, 2), _directions(node, LEVELS, v.shape[1]), {0: left}
        for level in range(LEVELS):
            onward: dict[int, np.ndarray] = {}
            for at, rows in groups.items():
                cut, width = cuts[at]
                if math.isnan(cut):
                    to(rows, at, 0)
                    continue
                p = _shaken(v[rows] @ u[level], row[rows], node)
                onward[2 * at + 1], onward[2 * at + 2] = rows[p <= cut + width], rows[p > cut - width]
            groups = onward
        for at, rows in groups.items():
            to(rows, at, 0)
        return (np.concatenate(x) for x in zip(*out))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = None
        for batch in batches:
            heads = np.flatnonzero(batch.column("row").is_null().to_numpy(zero_copy_only=False))
            for a, b in zip([-1, *heads], [*heads, batch.num_rows]):
                if a >= 0:
                    head = [int(batch.column("node")[a].as_py()), *(np.array(batch.column(c)[a].as_py(), float) for c in ("centres", "cuts"))]
                part = batch.slice(a + 1, b - a - 1)
                if not part.num_rows:
                    continue
                take, node, kind = places(_points(part.column("v")), part.column("row").to_numpy(), *head)
                yield pa.record_batch(
                    [part.column("row").take(pa.array(take)), part.column("v").take(pa.array(take)), pa.array(node, pa.int64()), pa.array(kind)],
                    names=["row", "v", "node", "kind"],
                )

    return route


def _split(todo: DataFrame, cosine: float, spill: bool, leaf: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Split all nodes of ``todo`` (row, v, node) until each holds ``leaf`` vectors at most. Returns the parts
    of the leaves (row, node) and of the balls (row, v, node, kind)."""
    done, balls = [], []
    turn = 0
    while True:
        counts = materialise(todo.groupBy("node").agg(F.count(F.lit(1)).alias("n")), "counts")
        large = counts.where(F.col("n") > leaf)
        done.append(todo.join(counts.where(F.col("n") <= leaf).select("node"), "node").select("row", "node"))
        if large.isEmpty():
            return done, balls
        # a fair part of each node by the hash of the row: SAMPLE vectors expected, whatever the node's size
        chance = F.pmod(F.xxhash64("row", "node", F.lit(turn)), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sampled = todo.join(large, "node").where(chance * F.col("n") < SAMPLE).select("node", "n", "row", "v")
        learned = sampled.groupBy("node").applyInPandas(_learner(cosine, spill, leaf), "node long, centres array<double>, cuts array<double>")
        # a node is dealt in parts, each with its head in front, so that one of any size is routed by many tasks
        parts = F.ceil(F.col("n") / PART).cast("int")
        heads = learned.join(large, "node").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
        body = todo.join(large, "node").withColumn("part", F.pmod(F.xxhash64("row", F.lit(turn)), parts).cast("int"))
        dealt = heads.unionByName(body, allowMissingColumns=True).repartition("node", "part").sortWithinPartitions("node", "part", "row")
        dealt = dealt.select("row", "v", "node", "centres", "cuts")
        routed = materialise(dealt.mapInArrow(_router(cosine), f"{ROW}, node long, kind int"), "routed")
        if not spill:
            balls.append(routed.where("kind > 0"))
        todo = routed.where("kind = 0").select("row", "v", "node")
        turn += 1


def _united(u: np.ndarray, v: np.ndarray) -> pa.Table:
    a, b = stars(u, v) if len(u) else (u, v)
    return pa.table({"row": pa.array(a, pa.int64()), "other": pa.array(b, pa.int64()), "links": pa.nulls(len(a), pa.int64())})


def _counted(rows: np.ndarray, links: np.ndarray) -> pa.Table:
    return pa.table({"row": pa.array(rows[links > 0], pa.int64()), "other": pa.nulls(int((links > 0).sum()), pa.int64()), "links": pa.array(links[links > 0], pa.int64())})


FOUND = "row long, other long, links long"


def _sets(column: pa.ChunkedArray, pick: np.ndarray) -> list[frozenset]:
    return [frozenset(x or ()) for x in column.take(pa.array(pick)).to_pylist()]


def _leaf(cosine: float):
    """Leaves, one after another, to counts of links and edges of their spanning stars."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for node, rows in runs(batches, "node"):
            v, row = _points(rows.column("v").combine_chunks()), rows.column("row").to_numpy()
            ball = rows.column("ball").fill_null(-1).to_numpy()
            a, b = [], []
            for i in range(0, len(v), 2048):
                x, y = np.nonzero(np.triu(v[i : i + 2048] @ v[i:].T >= cosine, 1))
                x, y = x + i, y + i
                other = (row[x] != row[y]) & ((ball[x] < 0) | (ball[x] != ball[y]))
                a.append(x[other])
                b.append(y[other])
            a, b = (np.concatenate(s) if s else np.zeros(0, int) for s in (a, b))
            if not len(a):
                continue
            met = np.unique(np.concatenate([a, b]))
            place = np.full(len(v), -1)
            place[met] = np.arange(len(met))
            # leaves before this one, and balls of which a pair has a member and a vector in reach
            cells, known = [], {}
            for i, leaves in enumerate(_sets(rows.column("leaves"), met)):
                cells += [(i, known.setdefault(x, len(known))) for x in leaves if x < node]
            grid = np.zeros((len(met), max(1, len(known))), np.float32)
            if cells:
                grid[tuple(np.array(cells).T)] = 1
            seen = (grid @ grid.T) > 0
            reach = _sets(rows.column("reach"), met)
            own = ball[met]
            for i, balls in enumerate(reach):
                if balls:
                    hit = np.isin(own, list(balls))
                    seen[i] |= hit
                    seen[:, i] |= hit
            new = ~seen[place[a], place[b]]
            links = np.bincount(np.concatenate([a[new], b[new]]), minlength=len(v))
            yield from _counted(row, links).to_batches()
            yield from _united(row[a], row[b]).to_batches()

    return compare


def _block(cosine: float):
    """Blocks of a ball's members and of vectors in reach of it, to counts and edges."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in runs(batches, "block"):
            v, row = _points(rows.column("v").combine_chunks()), rows.column("row").to_numpy()
            node = int(rows.column("node")[0].as_py())
            ball = rows.column("ball").fill_null(-1).to_numpy()
            inside = rows.column("kind").to_numpy() == 1
            m, s = np.flatnonzero(inside), np.flatnonzero(~inside)
            if not len(m) or not len(s):
                continue
            a, b = np.nonzero(v[m] @ v[s].T >= cosine)
            a, b = m[a], s[b]
            # of two balls that reach into each other the one with the smaller number counts the pair
            met = np.unique(a)
            reach = dict(zip(met, _sets(rows.column("reach"), met)))
            new = np.array([not (0 <= ball[y] < node and ball[y] in reach[x]) for x, y in zip(a, b)], bool)
            yield from _counted(row, np.bincount(np.concatenate([a[new], b[new]]), minlength=len(v))).to_batches()
            yield from _united(row[a], row[b]).to_batches()

    return compare


def _ball_blocks(balls: DataFrame, members: DataFrame, reach: DataFrame, size: int) -> DataFrame:
    """Rows of balls dealt so that each member meets each vector in reach in one block of bounded size."""
    sizes = balls.groupBy("node").agg(F.count_if(F.col("kind") == 1).alias("inside"), F.count_if(F.col("kind") == 2).alias("outside"))
    parts = lambda c: F.ceil(F.col(c) / size).cast("int")
    sizes = sizes.where("inside > 0 AND outside > 0").select("node", parts("inside").alias("ins"), parts("outside").alias("outs"))
    dealt = balls.join(sizes, "node")
    deal = lambda c: F.pmod(F.xxhash64("row", F.lit(7)), F.col(c)).cast("int")
    steps = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    to = F.when(F.col("kind") == 1, F.transform(steps("outs"), lambda j: deal("ins") * F.col("outs") + j))
    to = to.otherwise(F.transform(steps("ins"), lambda i: i * F.col("outs") + deal("outs")))
    dealt = dealt.select("row", "v", "node", "kind", F.explode(to).alias("part")).withColumn("block", F.xxhash64("node", "part"))
    return dealt.join(members, "row", "left").join(reach, "row", "left")


def link(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", cosine: float = COSINE, trees: int = TREES,
    leaf: int = LEAF,
) -> DataFrame:
    """``(key, n_links, component_id, kept)`` for each row of ``df``: links with other rows of a cosine of at
    least ``cosine`` (0.5 or more, in double precision), the smallest key that links lead to, and whether it
    is the row's own.

    The forest is approximate: each pair that is found is a link, a link can be missed in all ``trees``
    trees; tests hold recall against brute force. Pairs inside a ball of near copies and between a ball and
    the vectors met with it are never missed. Each round learns thresholds from ``SAMPLE`` vectors of each
    node, a documented bound; every vector is indexed.

    Vectors that are null, empty, zero or hold null or non-finite entries, or whose length is not the most
    frequent one, link with nothing. Repeated rows are rows like others: equal vectors link, rows that share
    a key count each other and are kept or not alike. A null key is larger than any other; a row alone is
    kept. Other columns are not read. Nothing but the number of nodes left is brought to the driver.
    """
    if not 0.5 <= cosine < 1:
        raise ValueError("the cosine is at least 0.5 and below 1")
    if key in ("n_links", "component_id", "kept"):
        raise ValueError(f"the key needs a name other than {key}")
    ship_package(df.sparkSession)
    kind = df.schema[key].dataType.simpleString()
    cells = F.transform(F.col(f"`{vector}`"), lambda c: c.cast("double"))
    rows = df.select(F.col(f"`{key}`").alias("key"), cells.alias("v")).mapInArrow(_units, f"key {kind}, v array<double>")
    rows = materialise(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    lengths = rows.where("v IS NOT NULL").groupBy(F.size("v").alias("d")).agg(F.count(F.lit(1)).alias("m"))
    d = lengths.agg(F.max_by("d", F.struct("m", "d"))).first()[0]
    vectors = rows.where(F.size("v") == (d or 0)).select("row", "v")

    _, found = _split(vectors.withColumn("node", F.lit(1).cast("long")), cosine, False, leaf)
    empty = "row long, v array<double>, node long, kind int"
    balls = df.sparkSession.createDataFrame([], empty)
    for part in found:
        balls = balls.unionByName(part)
    balls = materialise(balls, "balls")
    members = balls.where("kind = 1").select("row", F.col("node").alias("ball"))
    reach = balls.where("kind = 2").groupBy("row").agg(F.collect_set("node").alias("reach"))

    seeds = F.explode(F.array(*[F.lit(int(_child(0, 1 << 30 | t))) for t in range(trees)])).alias("node")
    done, _ = _split(vectors.select("row", "v", seeds), cosine, True, leaf)
    leaves = done[0]
    for part in done[1:]:
        leaves = leaves.unionByName(part)
    leaves = materialise(leaves, "leaves")
    known = leaves.groupBy("row").agg(F.collect_set("node").alias("leaves"))  # few: trees and their spill
    placed = vectors.join(known, "row").join(members, "row", "left").join(reach, "row", "left")
    placed = placed.select("row", "v", "ball", "reach", "leaves", F.explode("leaves").alias("node"))
    placed = placed.repartition("node").sortWithinPartitions("node")
    pairs = materialise(placed.mapInArrow(_leaf(cosine), FOUND), "links")

    blocks = _ball_blocks(balls, members, reach, leaf).repartition("block").sortWithinPartitions("block")
    across = materialise(blocks.select("row", "v", "node", "kind", "ball", "reach", "block").mapInArrow(_block(cosine), FOUND), "links")
    both = pairs.unionByName(across)
    inside = members.groupBy("ball").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("least"))
    balled = members.join(inside, "ball")
    counted = both.where("links IS NOT NULL").select("row", "links").unionByName(balled.select("row", (F.col("n") - 1).alias("links")))
    counted = counted.groupBy("row").agg(F.sum("links").alias("n_links"))

    edges = both.where("other IS NOT NULL").selectExpr("row AS u", "other AS v").unionByName(balled.selectExpr("least AS u", "row AS v"))
    joined = components(edges).withColumnRenamed("node", "row")
    joined = materialise(rows.select("row", "key").join(joined, "row", "left").join(counted, "row", "left"), "rows")
    first = joined.where("component IS NOT NULL").groupBy("component").agg(F.min("key").alias("first"))
    out = joined.join(first, "component", "left")
    component = F.when(F.col("component").isNull(), F.col("key")).otherwise(F.col("first"))
    out = out.select(
        F.col("key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.col("key").eqNullSafe(component).alias("kept"),
    )
    for table in (balls, leaves):
        release(table)
    return out


def near_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return link(read(spark, sf, "embeddings"))


#: All pairs of vectors; for tables of some thousand rows.
SQL = """
WITH RECURSIVE sound AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, x -> x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, x -> x <> 0)) > 0
), unit AS (
  SELECT vec_id, list_transform(v, x -> x / sqrt(list_sum(list_transform(v, y -> y * y)))) AS v FROM sound
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM unit a JOIN unit b ON a.vec_id <> b.vec_id AND list_dot_product(a.v, b.v) >= 0.95
), reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM reached r JOIN links l ON r.other = l.a
), n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(other)::BIGINT AS component_id, vec_id = min(other) AS kept
FROM reached LEFT JOIN n USING (vec_id) GROUP BY vec_id"""
