"""Spelling variants: words one edit apart, found by walking a trie that is an edge table.

States ``(word, position, node, edits)`` are rows, and so are the trie's edges ``(node, letter, child)``. A
round joins the states of one level with the edges. As one edit leaves the first or the second half of a
word untouched, the trie is built twice, for the words and for the reversed words, and a state spends its
edit only in the second half; there a node has few children. The edges carry which lengths and which next
letters follow, so a state that cannot end at a word is not made.

Below ``DEPTH`` letters a node has no more edges but the rests of its words, which are compared directly, so
the number of rounds does not follow the longest word.

Spark sizes a table by its files, also after an explode, and would send one of hundreds of MB through the driver
because its files are small. So all joins here are sort-merge joins, but for states whose rows have been measured.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, release
from .common import LOWER, UPPER, read, whole_text

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Levels of the trie; words in question are seldom longer.
DEPTH = 24
#: Bytes of a state in a broadcast, without its word.
STATE_BYTES = 100


def words(docs: DataFrame, key: str = "doc_id", text: str = "text", changed: int = 97, shortest: int = 5, least: int = 3) -> DataFrame:
    """``(word, n)``: letter runs of the whole texts, A-Z lower-cased, of at least ``shortest`` code points and
    ``least`` occurrences. A run whose crc32 with its key is divisible by ``changed`` loses one letter.

    Null texts have no words; a null key counts as empty text. Counts are summed on each task before the
    shuffle, so a frequent word or source is no hot key.
    """
    runs = F.regexp_extract_all(whole_text(text), F.lit(LETTERS), F.lit(0))
    name = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit(":")).alias("name")
    found = docs.select(name, F.explode(runs).alias("run"))
    found = found.select("name", F.translate("run", UPPER, LOWER).alias("run"))
    found = found.withColumn("h", F.crc32(F.concat("name", "run").cast("binary")))
    cut = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.expr("left(run, cut)"), F.expr("substring(run, cut + 2)"))
    word = F.when(F.col("h") % changed == 0, shorter).otherwise(F.col("run"))
    counted = found.withColumn("cut", cut).groupBy(word.alias("word")).agg(F.count(F.lit(1)).alias("n"))
    return counted.where((F.char_length("word") >= shortest) & (F.col("n") >= least))


def _bit(number: str) -> str:
    return f"shiftleft(1L, cast({number} as int))"


def _left(number: str) -> str:
    """Bit of a number of letters that are left; long rests share one."""
    return _bit(f"least({number}, 62)")


def _next(letter: str) -> str:
    """Bit of the next letter, or of the word's end for the empty text; letters may share one."""
    return _bit(f"if({letter} = '', 62, ascii({letter}) % 62)")


def _node(depth: str) -> str:
    return f"xxhash64(way, left(s, {depth}))"


def _merged(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Join without a broadcast, whatever Spark takes the tables' sizes for."""
    return left.join(right.hint("merge"), on, how)


def _in_memory(states: DataFrame) -> int:
    """Bytes of the rows, not of their files; 0 if there are none."""
    n, letters = states.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("s")), F.lit(0))).first()
    return n * STATE_BYTES + letters


def neighbours(vocabulary: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``(word, near)`` for all pairs of words, both ways, that differ by exactly one inserted, deleted or
    replaced code point. ``vocabulary`` has distinct words in ``word``; null and empty words have no pairs.

    Nodes are hashes of prefixes and every pair is verified in the end, so a collision costs a comparison and
    changes nothing. A node has at most as many edges as there are letters, and joins are on (node, letter)
    or the node; partitions of a node that very many words share are split by adaptive execution, which
    repeats only its few edges. Words of more than ``depth`` letters that agree in all of these are compared
    with each other, if their lengths differ by one at most. Intermediate tables go to shared scratch space.
    """
    word = F.col("word")
    ways = F.explode(F.array(F.struct(F.lit(0).alias("way"), word.alias("s")), F.struct(F.lit(1).alias("way"), F.reverse(word).alias("s"))))
    both = vocabulary.where("word > ''").select(ways.alias("o")).select("o.way", "o.s", F.char_length("o.s").alias("m"))
    # the untouched half: of the word in way 0, the rest of the word in way 1
    half = F.when(F.col("way") == 0, F.floor(F.col("m") / 2)).otherwise(F.ceil(F.col("m") / 2)).cast("int")
    both = both.withColumn("start", F.least(half, F.lit(depth)))

    steps = F.explode(F.sequence(F.greatest(F.col("start") - 1, F.lit(0)), F.least("m", F.lit(depth)) - 1)).alias("k")
    edge = both.select("way", "s", "m", steps).selectExpr(
        f"{_node('k')} AS node", "substring(s, k + 1, 1) AS letter", f"{_node('k + 1')} AS child",
        f"{_left('m - k - 1')} AS lengths", f"{_next('substring(s, k + 2, 1)')} AS letters",
    )
    edges = edge.groupBy("node", "letter", "child").agg(F.bit_or("lengths").alias("lengths"), F.bit_or("letters").alias("letters"))
    edges = materialise(edges, "edges")
    ends = both.selectExpr(_node(f"least(m, {depth})") + " AS node", f"substring(s, {depth + 1}) AS rest", "way", "s AS near")
    ends = materialise(ends, "ends")

    # states without an edit stand on the word's own path, which needs no join
    own = both.select("way", "s", "m", F.explode(F.sequence("start", F.least("m", F.lit(depth)))).alias("k"))
    own = own.selectExpr("way", "s", "m", "k AS position", f"{_node('k')} AS node", "0 AS edits")
    here, then = "substring(s, position + 1, 1)", "substring(s, position + 2, 1)"
    after = "substring(s, position + 3, 1)"

    def fits(left: str, letter: str) -> str:
        return f"(lengths & {_left(left)}) != 0 AND (letters & {_next(letter)}) != 0"

    replaced = f"position < m AND letter != {here} AND {fits('m - position - 1', then)}"
    inserted = f"letter != {here} AND {fits('m - position', here)}"
    deleted = f"position + 1 < m AND letter = {then} AND letter != {here} AND {fits('m - position - 2', after)}"
    spent = _merged(own.where(f"position < {depth}"), edges, "node").where(f"({replaced}) OR ({inserted}) OR ({deleted})")
    moves = f"""explode(filter(array(
        named_struct('position', if({replaced}, position + 1, -1), 'depth', position + 1),
        named_struct('position', if({inserted}, position, -1), 'depth', position + 1),
        named_struct('position', if({deleted}, position + 2, -1), 'depth', position + 1)), x -> x.position >= 0)) AS to"""
    spent = spent.selectExpr("way", "s", "m", "child AS node", moves)
    frontier = spent.selectExpr("way", "s", "m", "to.position AS position", "to.depth AS depth", "node", "1 AS edits")
    last = own.where(f"position = m - 1 AND position < {depth}")  # the last letter deleted: no edge to take
    frontier = frontier.unionByName(last.selectExpr("way", "s", "m", "m AS position", "position AS depth", "node", "1 AS edits"))

    arrived, at_end = [], f"position = m OR depth = {depth}"
    frontier = materialise(frontier, "frontier")
    most = frontier.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    while True:
        arrived.append(frontier)
        states = frontier.where(f"NOT ({at_end})")
        size = _in_memory(states)
        if not size:
            break
        states = states.withColumn("letter", F.expr(here)).hint("broadcast" if size <= most else "merge")
        taken = states.join(edges.select("node", "letter", "child"), ["node", "letter"])
        frontier = materialise(taken.selectExpr("way", "s", "m", "position + 1 AS position", "depth + 1 AS depth", "child AS node", "edits"), "frontier")

    # terminal one-edit states
    found = None
    for table in arrived:
        state = table.where(at_end).selectExpr("node", "substring(s, position + 1) AS rest", "s AS word", "way")
        found = state if found is None else found.unionByName(state)
    pairs = _merged(found, ends, ["node", "rest", "way"]).select("way", "word", "near")
    # both words have the trie's whole depth in common, and an edit in the rest
    deep = ends.where(F.char_length("near") >= depth).withColumn("m", F.char_length("near"))
    left = deep.select("node", "way", F.col("near").alias("word"), F.explode(F.expr("array(m - 1, m, m + 1)")).alias("m"))
    rests = _merged(left, deep, ["node", "way", "m"]).select("way", "word", "near")
    turned = [F.when(F.col("way") == 0, F.col(c)).otherwise(F.reverse(c)).alias(c) for c in ("word", "near")]
    pairs = pairs.unionByName(rests).where("word != near AND levenshtein(word, near, 1) = 1").select(*turned).distinct()
    out = materialise(pairs, "pairs")
    for table in (edges, ends, *arrived):
        release(table)
    return out


def _roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for words with a form, by following forms twice as far in each round. A form occurs at
    least twice as often as its word, so chains are short and have an end."""
    roots = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = _merged(roots, onward, "root", "left").selectExpr("word", "coalesce(next, root) AS root", "next IS NOT NULL AS moved")
        step = materialise(moved, "roots")
        release(roots)
        if step.where("moved").isEmpty():
            return step.select("word", "root")
        roots = step.drop("moved")


def group_variants(vocabulary: DataFrame, factor: int = 2, depth: int = DEPTH) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` for each row of ``vocabulary`` (distinct words and counts).

    ``n_near`` counts the words one edit away. ``form`` is the most frequent of them (ties: the smallest in
    code-point order) if it occurs at least ``factor`` times as often as the word; ``root`` is the end of the
    chain of forms. Words of one letter, very long words, letters of any script and ties are treated alike;
    an empty vocabulary gives no rows.
    """
    vocabulary = materialise(vocabulary.select("word", "n"), "vocabulary")
    near = _merged(neighbours(vocabulary, depth), vocabulary.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near"))).alias("best"))
    best = best.select("word", "n_near", F.col("best.near").alias("near"), (-F.col("best.minus")).alias("near_n"))
    taken = F.col("near_n") >= F.col("n") * factor
    rows = _merged(vocabulary, best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("near")).alias("form"), F.when(taken, F.col("near_n")).alias("form_n"),
    )
    rows = materialise(rows, "forms")
    roots = _roots(rows.where("form IS NOT NULL"))
    return _merged(rows, roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    found = group_variants(words(read(spark, sf, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")
