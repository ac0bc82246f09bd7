"""Near-duplicate join on word shingles by count vectors in an R-tree.

A document is the set of its distinct shingles. Shingles are hashed into groups, and the counts per group
are a point; the overlap of two sets is at most the sum of the coordinate minima, for points as for the
boxes of an R-tree. Only pairs that this bound lets through are verified on the sets.

Equal sets become one first. Which points can meet at all follows from the same counts: sets that differ
in at most t shingles agree wholly in one of t + 1 groups, so the contents of the groups are keys that
route points to common clusters. Clusters are cut into leaves of bounded size along the tree's order, and
a task joins two leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import materialise, release
from .common import read, runs, whole_text
from .components import components
from .hashing import LOWER, flat, mix, sequence_hash, slices, span_hashes, words
from .tokens import release as release_encoders

#: Shingle length, similarity in hundredths, and dimensions of a point.
WIDTH, PERCENT, GROUPS = 4, 85, 64
#: Distinct texts in a leaf.
LEAF = 192
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.zeros(0, np.int64)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row; a row with fewer words has its whole sequence as one."""
    n = len(offsets) - 1
    starts, ends, row = words(data, offsets)
    if not len(starts):
        return [np.zeros(0, np.uint64)] * n
    word = span_hashes(LOWER[data], starts, ends)
    cut = np.searchsorted(row, np.arange(n + 1))
    full = sequence_hash([word[i : len(word) - width + 1 + i] for i in range(width)]) if len(word) >= width else word[:0]
    out = []
    for a, b in zip(cut[:-1], cut[1:]):
        if b - a >= width:
            out.append(np.unique(full[a : b - width + 1]))
        elif b > a:
            out.append(sequence_hash([word[i : i + 1] for i in range(a, b)]))
        else:
            out.append(word[:0])
    return out


def _set_hash(own: np.ndarray, salt: int) -> int:
    if not len(own):
        return 0
    total = np.add.reduce(mix(own + np.uint64(salt)), keepdims=True) + np.array([len(own)], np.uint64) * _GOLD
    return int(mix(total).astype(np.int64)[0])


@lru_cache(None)
def size_class(n: int, percent: int) -> tuple[int, int]:
    """(class of size n, largest size of that class); partners of a size are in its class or a neighbour's."""
    k, low = 0, 1
    while True:
        high = low * 100 // percent
        if n <= high:
            return k, high
        k, low = k + 1, high + 1


@lru_cache(None)
def _level(k: int, percent: int) -> tuple[int, int, int]:
    """(most shingles in which two linked sets of sizes up to class k differ, number of groups, spare ones).

    Of t + 1 + s groups linked sets agree in s + 1 at least, so each may leave s of its keys out. These are
    the keys that say least: those of empty groups, of which the smallest sets of the level (of the class
    before) have s less four deviations, then those that many sets have.
    """
    low = before = 1
    for _ in range(k):
        low, before = low * 100 // percent + 1, low
    high = low * 100 // percent
    differ = 2 * high * (100 - percent) // (100 + percent)
    for spare in range(2, high):
        groups = differ + 1 + spare
        share = math.exp(-before / groups)  # of the groups, empty
        if spare >= groups * share + 4 * math.sqrt(groups * share * (1 - (1 + before / groups) * share)):
            break
    else:
        spare = 2
    return differ, differ + 1 + spare, spare


def routing_keys(own: np.ndarray, percent: int, hot: np.ndarray = _NONE, often: np.ndarray = _NONE) -> np.ndarray:
    """Keys of which linked, different sets share at least one (at the larger one's size class). ``hot`` are
    keys of many sets, sorted, and ``often`` says how many; any such list gives keys with this property.

    Keys have one order for all sets: not hot, hot by number, of empty groups. A set leaves out the last ``spare``
    of its keys, as far as they are hot or of empty groups. Of the spare + 1 keys that linked sets share at
    least, the first has ``spare`` others behind it on both sides, so both keep it.
    """
    k, _ = size_class(len(own), percent)
    out = []
    for level in (k, k + 1):
        differ, groups, spare = _level(level, percent)
        if not differ:
            continue  # at this size only equal sets link
        group = (mix(own ^ np.uint64(level + 1)) % np.uint64(groups)).astype(np.int64)
        order = np.argsort(group, kind="stable")
        ids, first = np.unique(group[order], return_index=True)
        content, weight = np.zeros(groups, np.uint64), np.full(groups, 1 << 62, np.int64)
        content[ids], weight[ids] = np.add.reduceat(mix(own)[order], first), 0
        key = mix(content ^ mix(np.arange(groups, dtype=np.uint64) + np.uint64(level << 32))).astype(np.int64)
        if len(hot):
            at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
            weight = np.where((hot[at] == key) & (weight == 0), often[at], weight)
        if np.count_nonzero(weight) <= spare:
            out.append(key[weight == 0])
        else:
            out.append(key[np.lexsort((key, weight))[: groups - spare]])
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def _each_set(batch: pa.RecordBatch, column: str, width: int) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = flat(batch.column(column))
    for i, j in slices(offsets):
        for k, own in enumerate(shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], width)):
            yield i + k, own


def _signatures(width: int):
    def run(batches):
        release_encoders()
        for batch in batches:
            sets = _each_set(batch, "text", width)
            rows = [(len(own), _set_hash(own, 1), _set_hash(own, 2), fine_point(own).tobytes()) for _, own in sets]
            if rows:
                kept = [batch.column("doc_id"), batch.column("hash")]
                made = [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64()] * 3 + [pa.binary()])]
                yield pa.record_batch([*kept, *made], names=["doc_id", "hash", "n_shingles", "s1", "s2", "point"])

    return run


#: Keys that a task gives at a time, and sets that it remembers to have given the keys of.
PORTION, SEEN = 1 << 16, 1 << 16


def _keys(width: int, percent: int, hot: np.ndarray = _NONE, often: np.ndarray = _NONE):
    """(key, salt, node) of every distinct set, about PORTION rows at a time, as a set of a few hundred shingles
    has hundreds of keys; keys in ``hot`` of which more than a task's worth are left are dealt over SALTS salts."""
    many = hot[often >= HOT]

    def portion(keys, nodes):
        key, node = np.concatenate(keys), np.concatenate(nodes)
        salt = np.where(np.isin(key, many), node % SALTS, 0)
        return pa.record_batch([pa.array(key), pa.array(salt), pa.array(node)], names=["key", "salt", "node"])

    def run(batches):
        release_encoders()
        seen: set[int] = set()
        for batch in batches:
            keys, nodes, held = [], [], 0
            for _, own in _each_set(batch, "text", width):
                node = _set_hash(own, 1)
                if len(own) and node not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()  # what is met again gives its keys again
                    seen.add(node)
                    keys.append(routing_keys(own, percent, hot, often))
                    nodes.append(np.full(len(keys[-1]), node, np.int64))
                    held += len(keys[-1])
                    if held >= PORTION:
                        yield portion(keys, nodes)
                        keys, nodes, held = [], [], 0
            if keys:
                yield portion(keys, nodes)

    return run


def _meetings(many: np.ndarray):
    """Edges ``(key, u, v)`` among the nodes of each key and salt, in a stream sorted by (key, salt, node): all
    pairs of PAIRS nodes or fewer (``key`` 1), else from the first node to the others (``key`` 0). The first
    node of each salt of a key in ``many`` is given as well (``u`` null), as the key goes on in other salts."""

    def edges(rows: np.ndarray, goes_on: bool):
        """Of whole keys; only the first one may have begun before."""
        begin = np.flatnonzero(np.concatenate([[True], (rows[:2, 1:] != rows[:2, :-1]).any(0)]))
        length = np.diff(np.append(begin, rows.shape[1]))
        few = (length <= PAIRS) & ~np.isin(rows[0, begin], many)
        few[0] &= not goes_on
        close = np.repeat(few, length)
        node, first, end = rows[2], np.repeat(rows[2, begin], length), np.repeat(begin + length, length)
        star = ~close & (first != node)
        u, v = [first[star]], [node[star]]
        at = np.flatnonzero(close)
        for step in range(1, PAIRS):
            at = at[at + step < end[at]]
            u.append(node[at])
            v.append(node[at + step])
        kind = np.repeat([0, 1], [len(u[0]), sum(map(len, u[1:]))])
        u, v = np.concatenate(u), np.concatenate(v)
        out = np.unique(np.stack([kind, u, v])[:, u != v], axis=1)
        rims = np.isin(rows[0, begin], many)
        rims[0] &= not goes_on
        heads = rows[:, begin[rims]]
        key = np.concatenate([out[0], heads[0]])
        u = pa.array(np.concatenate([out[1], heads[2]]), mask=np.arange(len(key)) >= out.shape[1])
        return pa.record_batch([pa.array(key), u, pa.array(np.concatenate([out[2], heads[2]]))], names=["key", "u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, goes_on = np.zeros((3, 0), np.int64), False
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("key", "salt", "node")])], axis=1)
            rows = rows[:, np.concatenate([[True], (rows[:, 1:] != rows[:, :-1]).any(0)])]  # copies have the same node
            others = np.flatnonzero((rows[:2] != rows[:2, -1:]).any(0))
            last = int(others[-1]) + 1 if len(others) else 0
            if rows.shape[1] - last <= PAIRS and not (goes_on and last == 0):
                if last:  # the last key may go on
                    yield edges(rows[:, :last], goes_on)
                    goes_on = False
                held = rows[:, last:]
            else:
                yield edges(rows, goes_on)
                held, goes_on = rows[:, last : last + 1], True
        if held.shape[1]:
            yield edges(held, goes_on)

    return run


#: Nodes of a key that are compared with each other.
PAIRS = 64
#: One row in so many is looked at to find hot keys; those of so many of them at least are hot, and from so
#: many their nodes are dealt over so many parts. None of these changes results.
LOOK, WARM, HOT, SALTS = 16, 3, 64, 64
#: Hot keys at most; every task has them.
HELD = 100_000


def _bounded(edges: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """The edges ``(u, v)`` whose ends may link by the bound that their points give."""
    points = signed.where("n_shingles > 0").groupBy(F.col("s1").alias("node")).agg(F.min(F.struct(F.col("n_shingles").alias("n"), "point")).alias("p"))
    side = lambda c: points.select(F.col("node").alias(c), F.col("p.n").alias(f"n{c}"), F.col("p.point").alias(f"p{c}"))
    near = edges.join(side("u"), "u").join(side("v"), "v").where(f"100 * least(nu, nv) >= {percent} * greatest(nu, nv)")

    def run(batches):
        for batch in batches:
            sizes = batch.column("nu").to_numpy() + batch.column("nv").to_numpy()
            bound = np.array([_overlap(a, b) for a, b in zip(batch.column("pu").to_pylist(), batch.column("pv").to_pylist())], np.int64)
            fits = pa.array((100 + percent) * bound >= percent * sizes)
            yield pa.record_batch([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(fits)

    return near.select("u", "v", "nu", "nv", "pu", "pv").mapInArrow(run, "u long, v long")


def _overlap(a: bytes, b: bytes) -> int:
    """The most that sets of these fine points can share; partners have as many groups or twice as many."""
    a, b = sorted((np.frombuffer(a, np.int32), np.frombuffer(b, np.int32)), key=len)
    return int(np.minimum(a, b.reshape(-1, len(a)).sum(0)).sum())


def candidate_edges(texts: DataFrame, signed: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """``(u, v)`` that connect all sets sharing a routing key that may link, and the table that they read.
    The pairs of a key of few sets are looked at one by one; other keys connect all their sets."""
    few = texts.where(F.pmod("hash", F.lit(LOOK)) == 0).select("text").mapInArrow(_keys(width, percent), "key long, salt long, node long")
    found = few.groupBy("key").count().where(F.col("count") >= WARM).orderBy(F.desc("count"), "key").limit(HELD).orderBy("key").toArrow()
    hot, often = (found.column(c).to_numpy() for c in ("key", "count"))
    keys = texts.select("text").mapInArrow(_keys(width, percent, hot, often), "key long, salt long, node long")
    met = keys.repartition("key", "salt").sortWithinPartitions("key", "salt", "node")
    found = materialise(met.mapInArrow(_meetings(hot[often >= HOT]), "key long, u long, v long").distinct(), "chains")
    rims = found.where("u is null").groupBy("key").agg(F.min("v").alias("u"))
    across = found.where("u is null").select("key", "v").join(rims, "key").select("u", "v")
    sure = found.where("u is not null and key = 0").select("u", "v").union(across).where("u != v")
    return sure.union(_bounded(found.where("u is not null and key = 1").select("u", "v"), signed, percent)), found


class Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def unite(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def fine_point(own: np.ndarray) -> np.ndarray:
    """A point with a power of two of groups, so that about 4 to 8 shingles fall into each of them; adding
    its halves gives the point with half as many groups."""
    groups = max(GROUPS, 1 << max(0, (len(own) - 1).bit_length() - 3))
    return np.bincount((own % np.uint64(groups)).astype(np.int64), minlength=groups).astype(np.int32)


def points(sets: list[np.ndarray], groups: int = GROUPS) -> np.ndarray:
    out = np.zeros((len(sets), groups), np.int32)
    for i, own in enumerate(sets):
        out[i] = np.bincount((own % np.uint64(groups)).astype(np.int64), minlength=groups)
    return out


def _may_link(bound: np.ndarray, a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """100 overlap >= percent (a + b - overlap), with ``bound`` for the overlap."""
    return (100 + percent) * bound >= percent * (a + b)


#: Points under one box of the tree.
FAN = 16


def tree_pairs(vectors: np.ndarray, sizes: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(i, js): points j behind i in the tree's order that the bound does not exclude. The tree packs points
    by size and coordinates; a box keeps its largest coordinates and smallest size."""
    order = np.lexsort((vectors[:, 1], vectors[:, 0], sizes))
    boxes = [order[k : k + FAN] for k in range(0, len(order), FAN)]
    top = np.array([vectors[b].max(0) for b in boxes])
    low = np.array([sizes[b].min() for b in boxes])
    for k, box in enumerate(boxes):
        bound = np.minimum(top[k], top[k:]).sum(1)
        near = [boxes[k + int(x)] for x in np.flatnonzero(_may_link(bound, low[k], low[k:], percent))]
        if not near:
            continue
        members = np.concatenate(near)
        for at, i in enumerate(box):
            js = members[at + 1 :] if near[0] is box else members
            fits = _may_link(np.minimum(vectors[i], vectors[js]).sum(1), sizes[i], sizes[js], percent)
            yield int(i), js[fits]


def leaf_links(sets: list[np.ndarray], percent: int, forest: Forest) -> Iterator[tuple[int, int]]:
    """A spanning forest of the true links among ``sets``, beyond what ``forest`` already connects."""
    sizes = np.array([len(s) for s in sets], np.int64)
    whole = np.concatenate(sets)
    _, codes = np.unique(whole, return_inverse=True)
    edge = np.concatenate([[0], np.cumsum(sizes)])
    mark = np.zeros(int(codes.max()) + 1 if len(codes) else 1, bool)
    for i, js in tree_pairs(points(sets), sizes, percent):
        root = forest.find(i)
        js = [int(j) for j in js if forest.find(int(j)) != root]
        if not js:
            continue
        own = codes[edge[i] : edge[i + 1]]
        mark[own] = True
        for j in js:
            if forest.find(j) != forest.find(i):
                overlap = int(mark[codes[edge[j] : edge[j + 1]]].sum())
                if _may_link(overlap, sizes[i], sizes[j], percent) and forest.unite(i, j):
                    yield i, j
        mark[own] = False


def _join_leaves(width: int, percent: int):
    """Tasks from a stream sorted by ``task``: edges ``(u, v)`` between the rows of a task. ``comp`` tells
    what earlier tasks have connected."""

    def close(rows):
        sets = [s for *_, s in rows]
        forest = Forest(len(rows))
        first: dict[int, int] = {}
        for i, (_, comp, _) in enumerate(rows):
            forest.unite(first.setdefault(comp, i), i)
        return [(rows[i][0], rows[j][0]) for i, j in leaf_links(sets, percent, forest)]

    def run(batches):
        current, rows = None, []
        for batch in batches:
            tasks = batch.column("task").to_pylist()
            nodes, comps = (batch.column(c).to_pylist() for c in ("node", "comp"))
            out = []
            for k, own in _each_set(batch, "text", width):
                if tasks[k] != current:
                    out += close(rows) if len(rows) > 1 else []
                    current, rows = tasks[k], []
                rows.append((nodes[k], comps[k], own))
            if out:
                yield _edges(out)
        out = close(rows) if len(rows) > 1 else []
        if out:
            yield _edges(out)

    return run


#: Points in a leaf while only the bound is looked at.
POINTS = 1024


def _leaves(members: DataFrame, order: list[str], size: int) -> DataFrame:
    """A table of the rows of clusters with two members at least, with ``rank`` (unique), ``leaf`` and the
    cluster's ``last``."""
    ordered = number_rows(members, ["cluster", *order], "rank")
    starts = ordered.groupBy("cluster").agg(F.min("rank").alias("from"), F.count(F.lit(1)).alias("members"))
    placed = ordered.join(starts, "cluster").where("members > 1")
    at = lambda c: F.floor(c / size).cast("long")
    placed = placed.withColumns({"leaf": at(F.col("rank") - F.col("from")), "last": at(F.col("members") - 1)})
    out = materialise(placed.drop("from", "members"), "leaves")
    release(ordered)
    return out


def _point_links(picked: DataFrame, percent: int) -> DataFrame:
    """``(u, v)``: a spanning forest per task of the pairs of a cluster that the bound lets through."""
    sizes = picked.groupBy("cluster", "leaf").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    other = sizes.select("cluster", F.col("leaf").alias("b"), F.col("low").alias("o_low"))
    pairs = sizes.join(other, "cluster").where(f"b >= leaf and 100 * high >= {percent} * o_low").select("cluster", F.col("leaf").alias("a"), "b")
    sides = pairs.select("cluster", "a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("leaf"))
    tasks = picked.join(sides, ["cluster", "leaf"]).select(F.xxhash64("cluster", "a", "b").alias("task"), "node", "n", "point")

    def run(batches):
        for _, rows in runs(batches, "task"):
            if rows.num_rows < 2:
                continue
            node, size = rows.column("node").to_numpy(), rows.column("n").to_numpy()
            fine = [np.frombuffer(p, np.int32) for p in rows.column("point").to_pylist()]
            groups = np.array([len(p) for p in fine])
            forest, out = Forest(len(node)), []
            for g in np.unique(groups):  # partners have as many groups or twice as many
                at = np.flatnonzero((groups == g) | (groups == 2 * g))
                vectors = np.stack([fine[k] if groups[k] == g else fine[k][:g] + fine[k][g:] for k in at])
                for i, js in tree_pairs(vectors, size[at], percent):
                    for j in js[(groups[at[i]] == g) | (groups[at[js]] == g)]:
                        if forest.unite(int(at[i]), int(at[j])):
                            out.append((int(node[at[i]]), int(node[at[j]])))
            if out:
                yield _edges(out)

    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(run, "u long, v long")


def _edges(out):
    return pa.record_batch([pa.array(c, pa.int64()) for c in zip(*out)], names=["u", "v"])


def _boxes(width: int):
    """Per leaf (a stream sorted by it): the tree's box, that is largest coordinates and smallest size."""

    def run(batches):
        current, top, low = None, None, 0

        def row():
            return pa.record_batch([pa.array([current[0]], pa.int64()), pa.array([current[1]], pa.int64()), pa.array([low], pa.int64()), pa.array([top.tolist()], pa.list_(pa.int32()))], names=["cluster", "leaf", "low", "top"])

        for batch in batches:
            clusters, leaves = batch.column("cluster").to_pylist(), batch.column("leaf").to_pylist()
            for k, own in _each_set(batch, "text", width):
                if (clusters[k], leaves[k]) != current:
                    if current is not None:
                        yield row()
                    current, top, low = (clusters[k], leaves[k]), np.zeros(GROUPS, np.int32), 1 << 40
                top, low = np.maximum(top, points([own])[0]), min(low, len(own))
        if current is not None:
            yield row()

    return run


#: log2 of the bits of a filter of text hashes: 2 MB, however many texts there are.
FILTER_BITS = 24


def _only(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` without most of the texts whose ``hash`` is not among ``wanted``'s ``__hash``, before the texts
    move. Bits are set by hash; what shares a bit stays, so nothing that is wanted goes. With more texts than
    bits it lets more pass, up to all, and only the saving is lost."""
    slot = lambda c: F.col(c).bitwiseAND(F.lit((1 << FILTER_BITS) - 1))
    words = wanted.groupBy(F.shiftright(slot("__hash"), 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__hash & 63 as int))")).alias("bits"))
    set_ = words.toArrow()  # 2^18 rows at most
    bits = np.zeros(1 << (FILTER_BITS - 6), "<i8")
    bits[set_.column("word").to_numpy()] = set_.column("bits").to_numpy()
    held = docs.sparkSession.createDataFrame([(bytearray(bits.tobytes()),)], "bits binary").select("bits").scalar()
    byte = F.conv(F.hex(F.substring(held, (F.shiftright(slot("hash"), 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("long")
    return docs.where(F.getbit(byte, F.col("hash").bitwiseAND(F.lit(7)).cast("int")) == 1)


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, leaf: int = LEAF) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``df``.

    Words are runs of other than ASCII white space, A-Z lower-cased; a set has all distinct shingles of
    ``width`` words of the whole text, or the whole sequence if shorter. Sets link when their overlap is
    at least ``percent`` hundredths of their union; a component is what links reach, named by its
    smallest key. Null and empty texts are empty sets, linked with nothing: they name themselves. Rows
    that repeat a key are rows like any other; a null key never names a component that has another.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text")).withColumn("hash", F.xxhash64("text"))
    signed = materialise(docs.mapInArrow(_signatures(width), "doc_id long, hash long, n_shingles long, s1 long, s2 long, point binary"), "shingles")
    classes = signed.where("n_shingles > 0").groupBy("s1", "s2").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"))
    edges, chains = candidate_edges(docs, signed, width, percent)
    clusters = components(edges)
    release(chains)
    members = classes.join(clusters, classes["s1"] == clusters["node"]).select(F.col("component").alias("cluster"), "n", "s1", "s2", "least")
    ordered = _leaves(members, ["n", "s1", "s2"], POINTS).withColumnRenamed("rank", "node")
    # one row stands for each distinct set
    pick = signed.join(ordered, ["s1", "s2"]).groupBy("node", "cluster", "leaf", "n").agg(F.min(F.struct("doc_id", "hash", "point")).alias("pick"))
    picked = materialise(pick.select("node", "cluster", "leaf", "n", "pick.*"), "points")
    near = components(_point_links(picked, percent))
    # what the bound leaves together, in the order of the tree's first dimension, cut into leaves
    tight = picked.join(near, "node").select(F.col("component").alias("cluster"), "node", "n", F.col("doc_id").alias("__id"), F.col("hash").alias("__hash"))
    tight = _leaves(tight, ["n", "node"], leaf)
    release(picked)
    few = _only(docs, tight)
    found = few.join(tight, few["doc_id"].eqNullSafe(tight["__id"]) & (few["hash"] == tight["__hash"])).select("node", "cluster", "leaf", "last", "text")
    found = materialise(found, "members")
    # first each leaf with its neighbour
    here, last = F.col("leaf"), F.col("last")
    pair = lambda a, b: F.struct(a.alias("a"), b.alias("b"))
    turns = F.when(last == 0, F.array(pair(here, here))).otherwise(
        F.array_distinct(F.array(pair(F.greatest(here - 1, F.lit(0)), F.greatest(here, F.lit(1))), pair(F.least(here, last - 1), F.least(here + 1, last))))
    )
    tasks = found.withColumn("comp", F.col("node")).withColumn("pair", F.explode(turns)).withColumn("task", F.struct("cluster", "pair.a", "pair.b"))
    links = materialise(_joined(tasks, width, percent), "links")
    whole = found.select("cluster", "leaf", "node", "last").where("last > 0")
    if not whole.isEmpty():
        links = links.union(_rest(found, links, width, percent))
    joined = components(links)
    release(found)
    named = ordered.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "component").select("s1", "s2", "component_id")
    out = signed.join(classes.select("s1", "s2", "least"), ["s1", "s2"], "left").join(named, ["s1", "s2"], "left")
    name = F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "least")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", name.alias("component_id"))


def _joined(tasks: DataFrame, width: int, percent: int) -> DataFrame:
    tasks = tasks.withColumn("task", F.xxhash64("task")).select("task", "node", "comp", "text")
    return tasks.repartition("task").sortWithinPartitions("task").mapInArrow(_join_leaves(width, percent), "u long, v long")


def _rest(found: DataFrame, links: DataFrame, width: int, percent: int) -> DataFrame:
    """Links between leaves that the first tasks did not compare, in clusters that are not one component yet.

    Pairs of leaves are pruned by their boxes and by what is connected already.
    """
    so_far = components(links)
    rows = found.where("last > 0").join(so_far, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")
    split = rows.groupBy("cluster").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a != b").select("cluster")
    rows = materialise(rows.join(split, "cluster").repartition("cluster", "leaf").sortWithinPartitions("cluster", "leaf"), "split")
    boxes = materialise(rows.select("cluster", "leaf", "text").mapInArrow(_boxes(width), "cluster long, leaf long, low long, top array<int>"), "boxes")
    comps = rows.groupBy("cluster", "leaf").agg(F.min("comp").alias("least"), F.max("comp").alias("most"))
    boxes = boxes.join(comps, ["cluster", "leaf"])
    other = boxes.select("cluster", *[F.col(c).alias(f"o_{c}") for c in ("leaf", "low", "top", "least", "most")])
    bound = F.aggregate(F.zip_with("top", "o_top", lambda x, y: F.least(x, y).cast("long")), F.lit(0).cast("long"), lambda a, x: a + x)
    pairs = boxes.join(other, "cluster").where("o_leaf > leaf + 1 and not (least = most and o_least = o_most and least = o_least)")
    pairs = pairs.where((100 + percent) * bound >= percent * (F.col("low") + F.col("o_low"))).select("cluster", F.col("leaf").alias("a"), F.col("o_leaf").alias("b"))
    sides = pairs.select("cluster", "a", "b", F.explode(F.array("a", "b")).alias("leaf"))
    tasks = rows.join(sides, ["cluster", "leaf"]).withColumn("task", F.struct("cluster", "a", "b"))
    return _joined(tasks, width, percent)


def keep_one(df: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """The rows of ``df`` without those of a component other than its first.

    Rows count, not keys: of a component the row with the smallest key stays, null keys last, and of rows
    that share that key one. Rows that are linked with nothing stay, whatever their key.
    """
    numbered = materialise(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    groups = near_duplicates(numbered, "__row", text, width, percent).where("n_shingles > 0")
    keys = numbered.select(F.col("__row").alias("doc_id"), F.col(key).cast("long").alias("key"))
    place = F.struct(F.col("key").isNull().alias("last"), "key", F.col("doc_id").alias("row"))
    placed = materialise(groups.join(keys, "doc_id").select("component_id", place.alias("place")), "places")
    first = placed.groupBy("component_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    gone = placed.join(first, "component_id").where("place.row != first.row").select(F.col("place.row").alias("__row"))
    return numbered.join(gone, "__row", "left_anti").drop("__row")


def shingle_join(spark, sf: str) -> DataFrame:
    """Components of every whole text of ``documents``."""
    return near_duplicates(read(spark, sf, "documents").select("doc_id", "text"))
