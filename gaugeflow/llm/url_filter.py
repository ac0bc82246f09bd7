"""URL filters: host rules first, then the ratio of two character models."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import materialise, release, ship_package
from .common import LOWER, UPPER, read, remainder
from .hashing import flat, slices

#: (verdict, host and path prefix): fixed by the contract of the query.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
#: Longest context in bytes (a key has room for five), and rows of a model that go to every task.
ORDER, HELD = 5, 4_000_000
FOLDS = 5


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/ ? #``, A-Z lower-cased; empty without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(after, UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _fits(rule: str, host: Column, path: Column) -> Column:
    name, slash, rest = rule.partition("/")
    return ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls; of equally long ones the first listed."""
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    none = F.lit(None).cast("string")
    rule = reduce(lambda e, r: F.when(_fits(r[1], host, path), F.lit(r[1])).otherwise(e), reversed(ordered), none)
    verdict = reduce(lambda e, r: F.when(_fits(r[1], host, path), F.lit(r[0])).otherwise(e), reversed(ordered), none)
    return rule, verdict


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each order 0..ORDER the number of each byte with as many bytes before it, exact: the order, the
    context and the byte in bit fields of a long. Before the row's start stand zeros."""
    into = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    context, out = np.zeros(len(data), np.int64), []
    for order in range(ORDER + 1):
        if order:
            before = np.zeros(len(data), np.int64)
            before[order:] = data[:-order]
            before[into < order] = 0
            context = context | before << (8 * (order - 1))
        out.append(order << 48 | context << 8 | data)
    return out


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        accepted = np.asarray(batch.column("accepted"), np.int64)
        data, offsets = flat(batch.column("view"))
        for i, j in slices(offsets):
            part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            side = np.repeat(accepted[i:j], np.diff(at)) << 60
            key, n = np.unique(np.concatenate([side | gram for gram in _grams(part, at)]), return_counts=True)
            yield pa.record_batch([pa.array(key), pa.array(n)], names=["key", "n"])


class Table(NamedTuple):
    """Sorted n-grams with their counts, and sorted contexts with counts and kinds of next bytes, by class."""

    grams: np.ndarray
    n: np.ndarray
    contexts: np.ndarray
    seen: np.ndarray
    kinds: np.ndarray


def _found(keys: np.ndarray, wanted: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    if not len(keys):
        return [np.zeros(v.shape[:1] + wanted.shape) for v in values]
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return [np.where(hit, v[:, at], 0.0) for v in values]


def log_likelihood(table: Table, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows x 2 (rejected, accepted), natural logarithms: interpolated models of all orders.

    Each order gives ``n / (n + t)`` of the mass to its counts and the rest to the next shorter one, t being
    the number of different bytes seen after the context (Witten-Bell); below order 0 all bytes are alike.
    """
    p = np.full((2, len(data)), 1 / 256)
    for gram in _grams(data, offsets):
        (g,) = _found(table.grams, gram, table.n)
        n, t = _found(table.contexts, gram >> 8, table.seen, table.kinds)
        with np.errstate(invalid="ignore", divide="ignore"):
            p = np.where(n > 0, (g + t * p) / (n + t), p)
    logs = np.concatenate([np.zeros((2, 1)), np.cumsum(np.log(p), axis=1)], axis=1)
    return (logs[:, offsets[1:]] - logs[:, offsets[:-1]]).T


def difference(table: Table, column: pa.Array) -> np.ndarray:
    """Log-likelihood of accepted minus rejected per byte; 0 for an empty text."""
    data, offsets = flat(column)
    out = np.zeros(len(column))
    for i, j in slices(offsets):
        at = offsets[i : j + 1] - offsets[i]
        ll = log_likelihood(table, data[offsets[i] : offsets[j]], at)
        out[i:j] = (ll[:, 1] - ll[:, 0]) / np.maximum(1, np.diff(at))
    return out


def fit(known: DataFrame) -> DataFrame:
    """A table of all n-grams of the rows ``(view, accepted 0/1)``, however many there are: ``key, kind`` (0
    n-gram, 1 context), ``n0, n1`` (counts by class) and ``t0, t1`` (kinds of bytes after a context)."""
    counted = known.select("view", F.col("accepted").cast("long")).mapInArrow(_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    side, key = F.shiftright("key", 60), F.col("key").bitwiseAND(F.lit((1 << 60) - 1))
    grams = materialise(counted.select(side.alias("side"), key.alias("key"), "n"), "grams")

    def by_class(rows, kind):
        of = lambda f, c: F.coalesce(F.sum(F.when(F.col("side") == c, f)), F.lit(0)).cast("long")
        one = F.lit(1) if kind else F.lit(0)
        cells = [of(F.col("n"), c).alias(f"n{c}") for c in (0, 1)] + [of(one, c).alias(f"t{c}") for c in (0, 1)]
        return rows.groupBy("key").agg(*cells).select("key", F.lit(kind).alias("kind"), "n0", "n1", "t0", "t1")

    contexts = grams.select("side", F.shiftright("key", 8).alias("key"), "n")
    model = materialise(by_class(grams, 0).unionByName(by_class(contexts, 1)), "model")
    release(grams)
    return model


def _table(rows: pa.Table) -> Table:
    cells = {c: rows.column(c).to_numpy() for c in ("key", "kind", "n0", "n1", "t0", "t1")}
    parts = []
    for kind in (0, 1):
        at = np.flatnonzero(cells["kind"] == kind)
        at = at[np.argsort(cells["key"][at], kind="stable")]
        parts += [cells["key"][at], np.stack([cells[c][at] for c in ("n0", "n1")])]
    return Table(*parts, np.stack([cells[c][at] for c in ("t0", "t1")]))


def _lookups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text the distinct n-grams and contexts that its score asks for."""
    for batch in batches:
        data, offsets = flat(batch.column("view"))
        row = batch.column("row").to_numpy()
        for i, j in slices(offsets):
            part, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
            own = np.repeat(row[i:j], np.diff(at))
            grams = _grams(part, at)
            for kind, keys in ((0, grams), (1, [g >> 8 for g in grams])):
                both = np.unique(np.stack([np.tile(own, len(keys)), np.concatenate(keys)]), axis=1)
                yield pa.record_batch([pa.array(both[0]), pa.array(both[1]), pa.array(np.full(both.shape[1], kind, np.int32))], names=["row", "key", "kind"])


def apply(df: DataFrame, view: str, model: DataFrame, output: str, held: int = HELD) -> DataFrame:
    """Add ``output``, the difference that ``model`` gives to the text column ``view``.

    A model of at most ``held`` rows goes to every task. A larger one stays a table: each distinct text asks
    for its n-grams by a join on them, and is scored from what it gets. Both ways give the same numbers.
    """
    if model.count() <= held:
        table, names = df.sparkSession.sparkContext.broadcast(_table(model.toArrow())), [*df.columns, output]

        def run(batches):
            for batch in batches:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(difference(table.value, batch.column(view)))], names=names)

        return df.mapInArrow(run, StructType([*df.schema, StructField(output, DoubleType())]))

    texts = materialise(df.select(F.coalesce(view, F.lit("")).alias("view")).distinct().withColumn("row", F.monotonically_increasing_id()), "views")
    asked = texts.mapInArrow(_lookups, "row long, key long, kind int").join(model, ["key", "kind"])
    got = asked.groupBy("row").agg(F.collect_list(F.struct("key", "kind", "n0", "n1", "t0", "t1")).alias("cells"))

    def score(batches):
        for batch in batches:
            out = []
            for k in range(batch.num_rows):
                cells = batch.column("cells")[k].values
                rows = pa.Table.from_arrays(cells.flatten() if cells is not None else [pa.array([], pa.int64())] * 6, names=["key", "kind", "n0", "n1", "t0", "t1"])
                out.append(difference(_table(rows), batch.column("view").slice(k, 1))[0])
            yield pa.record_batch([batch.column("view"), pa.array(out, pa.float64())], names=["view", "found"])

    scored = texts.join(got, "row", "left").select("view", "cells").mapInArrow(score, "view string, found double")
    scored = materialise(scored.withColumnsRenamed({"view": "__text", "found": output}), "scores")
    return df.join(scored, F.coalesce(view, F.lit("")) == F.col("__text")).drop("__text")


#: Differences are counted in bins of one thousandth, clipped at this size.
CLIP = 10.0


def calibrate(held: DataFrame) -> float:
    """The threshold on ``difference`` with the smallest mean error over both classes of ``held``
    ``(difference, accepted)``; 0 if a class is missing."""
    bin_ = F.round(F.greatest(F.least("difference", F.lit(CLIP)), F.lit(-CLIP)) * 1000).cast("int")
    rows = held.groupBy(bin_.alias("b")).agg(F.sum("accepted").alias("good"), F.sum(1 - F.col("accepted")).alias("bad")).toPandas().sort_values("b")
    good, bad = rows["good"].to_numpy(float), rows["bad"].to_numpy(float)
    if not good.sum() or not bad.sum():
        return 0.0
    lost = np.concatenate([[0], np.cumsum(good)]) / good.sum()  # accepted ones below each cut
    let_in = 1 - np.concatenate([[0], np.cumsum(bad)]) / bad.sum()
    error = lost + let_in
    best = np.flatnonzero(error == error.min())
    cut = int(best[len(best) // 2])
    edges = np.concatenate([[rows["b"].iloc[0] - 1], rows["b"].to_numpy()])
    upper = rows["b"].iloc[cut] if cut < len(rows) else edges[cut] + 1
    return float(edges[cut] + upper) / 2 / 1000


def judge(df: DataFrame, key: str = "page_id", url: str = "url", rules=RULES, held: int = HELD) -> DataFrame:
    """Add ``host, path, rule, difference, verdict``.

    The rule that fits decides. All other URLs go by the difference of two models learnt from the URLs
    that rules accept and reject (those whose key's remainder is not 0), cut where the remaining ruled
    ones are told apart best. The models read the whole URL, query and fragment too, and count every n-gram
    exactly, each distinct URL once; a digit is any digit to them. A null URL has empty host and path and difference 0; one without
    ``://`` has empty host and path and is judged by the models. Very long URLs and repeated rows are rows like
    others, and repeating all rows changes no verdict. Columns of ``df`` with the added names are replaced.
    """
    names = ["host", "path", "rule", "difference", "verdict"]
    ship_package(df.sparkSession)
    ruled = df.drop(*names).withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    view = F.regexp_replace(F.coalesce(F.col(url), F.lit("")), "[0-9]", "0")
    ruled = ruled.withColumns({"rule": rule, "__by_rule": verdict, "__view": view})
    known = ruled.where(F.col("__by_rule").isNotNull()).select(
        F.col("__view").alias("view"), (F.col("__by_rule") == "allow").cast("long").alias("accepted"), remainder(key, FOLDS).alias("fold")
    )
    model = fit(known.where(F.col("fold") != 0).select("view", "accepted").distinct())
    threshold = calibrate(apply(known.where(F.col("fold") == 0), "view", model, "difference", held))
    scored = apply(ruled, "__view", model, "difference", held)
    by_model = F.when(F.col("difference") >= threshold, F.lit("allow")).otherwise(F.lit("block"))
    return scored.withColumn("verdict", F.coalesce("__by_rule", by_model)).drop("__by_rule", "__view")


def url_filters(spark, sf: str) -> DataFrame:
    """Verdicts on every URL of ``pages``."""
    return judge(read(spark, sf, "pages").select("page_id", "url")).select("page_id", "host", "path", "rule", "verdict", "difference")
