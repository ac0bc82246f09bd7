"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from ..operators.ranking import number_rows
from ..session import materialise, release, ship_package
from .common import read, whole_text, word_count

#: Fixed by the contract of the query: weights in turn, words of the mix, and copies of a document.
WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
#: Rows that one task pairs at most, and residuals that one task combines.
GROUP, FAN_IN = 20_000, 64


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share`` of all words; a
    target stops at ``most`` times its source, and what is over is shared again by weight until none is
    above. All steps are aggregates over the table of sources.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    per = number_rows(per.withColumn("__last", F.col("source").isNull()), ["__last", "source"], "__n").drop("__last")
    turn = F.array(*[F.lit(float(w)) for w in weights])
    per = materialise(per.withColumn("weight", F.element_at(turn, (F.pmod(F.col("__n") - 1, F.lit(len(weights))) + 1).cast("int"))).drop("__n"), "sources")
    cap, level = F.col("source_size") * most, None
    total = share * (per.agg(F.sum("source_size")).first()[0] or 0)
    while True:  # each turn stops one source more at least
        full = F.lit(False) if level is None else F.col("weight") * level >= cap
        row = per.agg(F.sum(F.when(full, cap)).alias("spent"), F.sum(F.when(~full, F.col("weight"))).alias("left"), F.sum(full.cast("int")).alias("n")).first()
        if not row["left"]:
            return per.select("source", "source_size", cap.alias("target"))
        new = (total - (row["spent"] or 0.0)) / row["left"]
        if level is not None and new <= level:
            return per.select("source", "source_size", F.least(F.col("weight") * level, cap).alias("target"))
        level = new


def pivot(p: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> int | None:
    """Round the fractions ``p`` in place by pairs; returns the place of the one left over, if any.

    Two rows at a time: words move from one to the other until one row is whole; which way is drawn so
    that every row's expectation stays. The sum of ``p * size`` stays as it was.
    """
    i = None
    draw = rng.random(len(p))
    for j in range(len(p)):
        if p[j] <= 1e-12 or p[j] >= 1 - 1e-12 or size[j] == 0:
            p[j] = float(draw[j] < p[j]) if size[j] == 0 else round(p[j])
            continue
        if i is None:
            i = j
            continue
        up = min((1 - p[i]) * size[i], p[j] * size[j])  # words from j to i
        down = min(p[i] * size[i], (1 - p[j]) * size[j])
        move = up if draw[j] < down / (up + down) else -down
        p[i] += move / size[i]
        p[j] -= move / size[j]
        whole = [k for k in (i, j) if p[k] <= 1e-12 or p[k] >= 1 - 1e-12]
        for k in whole:
            p[k] = round(p[k])
        left = [k for k in (i, j) if k not in whole]
        i = left[0] if left else None
    return i


def _round_group(last: bool):
    def run(key, pdf):
        seed = zlib.crc32(repr([None if k is None or k != k else str(k) for k in key]).encode())
        pdf = pdf.sort_values(["rank", "row"]).reset_index(drop=True)
        p, size = pdf["p"].to_numpy(float).copy(), pdf["size"].to_numpy(float)
        rng = np.random.default_rng(seed)
        left = pivot(p, size, rng)
        pdf["open"] = False
        if left is not None:
            if last:
                p[left] = float(rng.random() < p[left])
            else:
                pdf.loc[left, "open"] = True
        pdf["p"] = p
        return pdf

    return run


_SCHEMA = "row long, source string, size long, p double, whole long, rank long, grp long, open boolean"


def copies(rows: DataFrame, wanted: DataFrame, group: int = GROUP, fan_in: int = FAN_IN) -> DataFrame:
    """``(row, copies)``: how often the mix takes each of ``(row, source, size)``, ``row`` being unique.

    A row's expectation is its source's target over its size. The whole part is sure; the fraction is
    rounded by :func:`pivot` in groups of about ``group`` rows of a source, so a source that holds a third
    of the table is many tasks. Each group leaves one fraction at most; these meet ``fan_in`` at a time,
    level by level, until each source has one, which is drawn. So a source misses its target by less
    than one document. The same input gives the same copies.
    """
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    parts = rows.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / group).cast("long").alias("parts"))
    per = wanted.withColumn("share", share).join(parts.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")
    per = per.select(F.col("source").alias("__s"), "share", "parts")
    open_ = (
        rows.join(per, F.col("source").eqNullSafe(F.col("__s")))
        .withColumn("rank", F.xxhash64("row"))
        .select("row", "source", "size", (F.col("share") - F.floor("share")).alias("p"), F.floor("share").cast("long").alias("whole"), "rank", F.pmod("rank", "parts").alias("grp"), F.lit(True).alias("open"), "parts")
    )
    done, most = [], max(1, parts.agg(F.max("parts")).first()[0] or 1)
    while True:
        level = materialise(open_.drop("parts").groupBy("source", "grp").applyInPandas(_round_group(most == 1), _SCHEMA), "pivot")
        done.append(level.where(~F.col("open")).select("row", (F.col("whole") + F.round("p").cast("long")).alias("copies")))
        if most == 1:
            break
        most = -(-most // fan_in)
        open_ = level.where("open").withColumns({"grp": F.floor(F.col("grp") / fan_in).cast("long"), "parts": F.lit(1)})
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def mix(df: DataFrame, text: str = "text", source: str = "source", weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """Add ``size, source_size, target, copies, taken`` to every row of ``df``.

    Size counts the words of the whole text (null: 0); null is a source of its own. Rows that repeat a
    key are rows of their own. Rows of size 0 are taken by their drawn copies, which add no words.
    Columns of ``df`` with the added names are replaced; keep them under other names where they matter. An
    empty table gives no rows; a very long text is a row like others, and counts at most twice.

    The draw of a row follows from the contents of the table (all columns but maps), so reruns agree whatever
    files, partitions or executors the rows come from. The rows are numbered once, in a table that both the
    sizes and the result come from, so ``df`` may give its rows in other partitions when read again.
    """
    names = ["size", "source_size", "target", "copies", "taken"]
    ship_package(df.sparkSession)
    numbered = materialise(df.drop(*names).withColumn("__row", F.monotonically_increasing_id()), "numbered")
    plain = [F.col(f"`{f.name}`") for f in numbered.schema if f.name != "__row" and not isinstance(f.dataType, (MapType, VariantType))]
    content = F.xxhash64(*plain, F.lit(0)).alias("content")
    sized = materialise(numbered.select("__row", F.col(source).cast("string").alias("source"), word_count(whole_text(text)).alias("size"), content), "sizes")
    # a row's number follows from what all rows say, not from where they lie; equal rows may swap theirs
    ordered = number_rows(sized, ["content", "__row"], "row")
    rows = materialise(ordered.drop("content"), "rows")
    release(ordered)
    release(sized)
    wanted = targets(rows, weights, share, most)
    per = wanted.withColumnRenamed("source", "__s")
    taken = rows.join(copies(rows.drop("__row"), wanted), "row").join(per, F.col("source").eqNullSafe(F.col("__s")))
    taken = taken.select("__row", "size", "source_size", "target", "copies", (F.col("size") * F.col("copies")).alias("taken"))
    return numbered.join(taken, "__row").drop("__row")


def mixing(spark, sf: str) -> DataFrame:
    """What the mix takes of every row of ``documents``."""
    mixed = mix(read(spark, sf, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
