"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A paragraph (a sentence, or 96 code points of a line at most) has a 64-bit digest, and a document is the
set of its digests. A sketch has three tables of cells; a digest lies in one cell of each, and a cell
holds how many digests lie in it, their exclusive or and that of their check hashes. Sketches of two
versions subtract cell by cell, so what they share cancels; a cell left with one digest gives it away,
which is then taken out of its other cells, and so on. What cannot be peeled goes to a larger sketch.

Built-in expressions only. The rows of a pair stay in one partition from the first aggregate to the last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import number_rows
from ..session import materialise, release
from .common import read, whole_text

PARAGRAPH = r"[^\n.!?]{1,96}+[.!?]*+|[.!?]++"
#: Cells per table of the printed fingerprint; a retry has so many times as many.
CELLS, LARGER = 12, 8
#: Times that each of the three tables is looked through before a retry.
TURNS = 2

_LEFT, _TOTAL = -1, -2  # pseudo cells: digests found, and how many digests both sides have


def digests(text: Column) -> Column:
    """The set of paragraph digests of a text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), F.lit(0)), lambda p: F.xxhash64(p)))


def _check(k: Column, seed: int) -> Column:
    return F.xxhash64(k, F.lit(seed))


def _cell(k: Column, table, cells: int, seed: int) -> Column:
    table = F.lit(table) if isinstance(table, int) else table
    return (F.pmod(F.xxhash64(k, F.lit(seed + 1), table), F.lit(cells)) + table * cells).cast("int")


def _sum(rows: DataFrame) -> DataFrame:
    held = rows.groupBy("pair", "cell", "digest").agg(F.sum("c").alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    return held.where("c != 0 or k != 0 or h != 0")


def subtract(pairs: DataFrame, cells: int, seed: int) -> DataFrame:
    """Cells ``(pair, cell, digest, c, k, h)`` of the sketch of ``a`` less that of ``b``, from
    ``(pair, a, b)`` with arrays of digests."""
    both = pairs.select("pair", F.size("a").alias("na"), F.size("b").alias("nb"), F.posexplode_outer(F.concat("a", "b")).alias("pos", "k"))
    sign = F.when(F.col("pos") < F.col("na"), 1).otherwise(-1).cast("long")
    rows = both.select("pair", "k", sign.alias("c"), _check(F.col("k"), seed).alias("h"), (F.col("na") + F.col("nb")).cast("long").alias("n"), "pos")
    zero = F.lit(0).cast("long")
    table = F.array(*[F.lit(t) for t in (0, 1, 2)])
    first = F.array(*[F.lit(t) for t in (0, 1, 2, _TOTAL)])
    rows = rows.where("pos is not null").select("*", F.explode(F.when(F.col("pos") == 0, first).otherwise(table)).alias("t"))
    total = F.col("t") == _TOTAL
    return _sum(rows.select(
        "pair",
        F.when(total, F.lit(_TOTAL)).otherwise(_cell(F.col("k"), F.col("t"), cells, seed)).alias("cell"),
        zero.alias("digest"),
        F.when(total, F.col("n")).otherwise(F.col("c")).alias("c"),
        F.when(total, zero).otherwise(F.col("k")).alias("k"),
        F.when(total, zero).otherwise(F.col("h")).alias("h"),
    ))


def peel(held: DataFrame, cells: int, seed: int, turns: int = TURNS) -> DataFrame:
    """Look through the tables one by one. A table has one cell per digest, so the pure cells of a table
    hold different digests and can all be taken out at once."""
    c, k, h, zero = F.col("c"), F.col("k"), F.col("h"), F.lit(0).cast("long")
    entry = lambda cell, digest, c, k, h: F.struct(cell.cast("int").alias("cell"), digest.alias("digest"), c.alias("c"), k.alias("k"), h.alias("h"))
    for turn in range(3 * turns):
        low = (turn % 3) * cells
        pure = F.col("cell").between(low, low + cells - 1) & (F.abs(c) == 1) & (_check(k, seed) == h)
        same = entry(F.col("cell"), F.col("digest"), c, k, h)
        out = [entry(_cell(k, t, cells, seed), zero, -c, k, h) for t in range(3)]
        given = F.when(pure, F.array(same, *out, entry(F.lit(_LEFT), k, c, zero, zero))).otherwise(F.array(same))
        held = _sum(held.select("pair", F.explode(given).alias("e")).select("pair", "e.*"))
    return held


def differences(pairs: DataFrame, cells: int = CELLS, turns: int = TURNS) -> DataFrame:
    """``(pair, only_a, only_b, total)``: arrays of the digests that one side alone has, and how many both
    sides have together. Pairs whose sketch does not peel are sketched again with more cells and new
    hashes, until none is left. Pairs of two empty sides give no row."""
    left, done, seed = pairs.repartition("pair"), [], 1
    while True:
        peeled = peel(subtract(left, cells, seed), cells, seed, turns)
        found = lambda sign: F.collect_list(F.when((F.col("cell") == _LEFT) & (F.col("c") == sign), F.col("digest")))
        out = peeled.groupBy("pair").agg(
            F.max(F.col("cell") >= 0).alias("stuck"),
            found(1).alias("only_a"),
            found(-1).alias("only_b"),
            F.max(F.when(F.col("cell") == _TOTAL, F.col("c"))).alias("total"),
        )
        out = materialise(out.withColumns({c: F.when(F.col("stuck"), F.array().cast("array<long>")).otherwise(F.col(c)) for c in ("only_a", "only_b")}), "peeled")
        done.append(out.where("not stuck").drop("stuck"))
        stuck = out.where("stuck").select("pair")
        if stuck.isEmpty():
            break
        left = pairs.join(stuck, "pair", "left_semi")
        cells, seed = cells * LARGER, seed + 2
    result = done[0]
    for more in done[1:]:
        result = result.union(more)
    return result


def likeness(only_a: Column, only_b: Column, total: Column) -> Column:
    """Jaccard likeness of two sets from what their sketches differ in; two empty sets are alike."""
    apart = F.coalesce(F.size(only_a) + F.size(only_b), F.lit(0))
    return F.when(total.isNull(), F.lit(1.0)).otherwise((total - apart) / (total + apart))


def sketch_text(cells: Column) -> Column:
    """A sorted array of cells ``(cell, c, k, h)`` as text."""
    digit = lambda x, n: F.lpad(F.right(F.hex(x), F.lit(n)), n, "0")
    packed = F.transform(cells, lambda x: F.concat(digit(x["cell"].cast("long"), 2), digit(x["c"], 4), digit(x["k"], 16), digit(x["h"], 8)))
    return F.base64(F.unhex(F.array_join(packed, "")))


def sketches(sets: DataFrame, cells: int = CELLS) -> DataFrame:
    """``(row, own, edited)`` as texts: the printed sketches of both arrays of digests. Equal sets have
    equal texts."""
    sides = sets.select("row", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("own").alias("a")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("a")))).alias("s"))
    rows = sides.select("row", "s.side", F.explode("s.a").alias("k")).select("row", "side", "k", F.explode(F.array(*[F.lit(t) for t in range(3)])).alias("t"))
    rows = rows.select("row", "side", _cell(F.col("k"), F.col("t"), cells, 1).alias("cell"), "k", _check(F.col("k"), 1).alias("h"))
    held = rows.groupBy("row", "side", "cell").agg(F.count(F.lit(1)).alias("c"), F.bit_xor("k").alias("k"), F.bit_xor("h").alias("h"))
    side = lambda n: sketch_text(F.array_sort(F.collect_list(F.when(F.col("side") == n, F.struct("cell", "c", "k", "h")))))
    return held.groupBy("row").agg(side(0).alias("own"), side(1).alias("edited"))


def _neighbours(docs: DataFrame) -> DataFrame:
    """``(doc_id, next_id, prev_id, need)`` per distinct key: after the last comes the first; ``need`` is a
    quarter of the longest text of the key before."""
    keys = docs.groupBy("doc_id").agg(F.max(F.char_length("text")).alias("n"))
    numbered = materialise(number_rows(keys, "doc_id", "at"), "keys")
    count = numbered.count()
    before = numbered.select((F.pmod("at", F.lit(max(count, 1))) + 1).alias("at"), F.col("doc_id").alias("prev_id"), F.floor(F.col("n") / 4).cast("int").alias("need"))
    after = numbered.select((F.pmod(F.col("at") - 2, F.lit(max(count, 1))) + 1).alias("at"), F.col("doc_id").alias("next_id"))
    return numbered.select("doc_id", "at").join(before, "at").join(after, "at").drop("at")


def compare_versions(df: DataFrame, key: str = "doc_id", text: str = "text", cells: int = CELLS) -> DataFrame:
    """Per row of ``df``: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, only_own, only_edited``.

    The edited text has the last quarter (rounded down) of the code points replaced by the first as many,
    or all, of the next key's text; after the last key comes the first. ``only_own`` and ``only_edited``
    are the paragraph digests in which the two versions differ. Null text counts as empty; an empty set
    has an empty fingerprint. Nulls come first in key order. Where rows share a key, the smallest of
    their (so far as needed) prefixes stands for the key as somebody's next.
    """
    docs = df.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    links = _neighbours(docs).withColumnRenamed("doc_id", "link")
    placed = docs.join(links, F.col("doc_id").eqNullSafe(F.col("link"))).drop("link")
    heads = placed.groupBy(F.col("prev_id").alias("link")).agg(F.min(F.left("text", F.col("need"))).alias("head"))
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    edited = F.concat(F.left(F.col("text"), F.char_length("text") - quarter), F.left(F.col("head"), quarter))
    versions = placed.join(heads, F.col("doc_id").eqNullSafe(F.col("link")))
    sets = versions.select("doc_id", "next_id", "text", edited.alias("edited")).select(
        "doc_id",
        "next_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"),
        digests(F.col("edited")).alias("edited"),
    )
    alone = materialise(sets.withColumn("row", F.monotonically_increasing_id()), "digests")
    nexts = alone.groupBy(F.col("doc_id").alias("link")).agg(F.min("own").alias("next"))
    # joined once, as every round of sketches reads the pairs again
    sets = materialise(alone.join(nexts, F.col("next_id").eqNullSafe(F.col("link"))).drop("link", "next_id"), "versions")
    release(alone)
    own = sets.select((F.col("row") * 2).alias("pair"), F.col("own").alias("a"), F.col("edited").alias("b"))
    follow = sets.select((F.col("row") * 2 + 1).alias("pair"), F.col("own").alias("a"), F.col("next").alias("b"))
    apart = differences(own.union(follow), cells).withColumns({"row": F.shiftright("pair", 1), "near": likeness(F.col("only_a"), F.col("only_b"), F.col("total"))})
    first = F.pmod("pair", F.lit(2)) == 0
    pick = lambda c, when: F.max(F.when(when, F.col(c)))
    near = apart.groupBy("row").agg(pick("near", first).alias("near_edited"), pick("near", ~first).alias("near_next"), pick("only_a", first).alias("only_own"), pick("only_b", first).alias("only_edited"))
    kept = sets.repartition("row")
    printed = sketches(kept.select("row", "own", "edited"), cells).withColumnsRenamed({"own": "fingerprint", "edited": "edited_fingerprint"})
    out = kept.select("row", "doc_id", "n_chars", "edited_sha256").join(printed, "row", "left").join(near, "row", "left")
    none = F.array().cast("array<long>")
    return out.select(
        "doc_id", "n_chars", "edited_sha256",
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("fingerprint", "edited_fingerprint")],
        *[F.coalesce(c, F.lit(1.0)).alias(c) for c in ("near_edited", "near_next")],
        *[F.coalesce(c, none).alias(c) for c in ("only_own", "only_edited")],
    )


def fingerprints(spark, sf: str) -> DataFrame:
    """Fingerprints of every whole text of ``documents`` and its edited text."""
    return compare_versions(read(spark, sf, "documents").select("doc_id", "text")).drop("only_own", "only_edited")
