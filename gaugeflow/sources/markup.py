"""Rows out of HTML pages held in a column. Not a DOM parser: regular, table-like blocks only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: markup patterns ---
TABLE_PATTERN = r"(?is)<table\b[^>]*>(.*?)</table\s*>"
ROW_PATTERN = r"(?is)<tr\b[^>]*>(.*?)</tr\s*>"
CELL_PATTERN = r"(?is)<td\b[^>]*>(.*?)</td\s*>"
TAG_PATTERN = r"(?s)<[^>]*>"
ENTITIES = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ", "&amp;": "&"}


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags removed, basic entities decoded."""
    out = F.regexp_replace(html, TAG_PATTERN, "")
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def repeated_blocks(
    df: DataFrame, html: Column, block_pattern: str, keep: Sequence[str], fields: dict[str, str]
) -> DataFrame:
    """One row per match of ``block_pattern`` (group 1), with ``position`` and one column per field
    pattern (group 1, null when absent)."""
    blocks = df.select(*keep, F.posexplode(F.regexp_extract_all(html, F.lit(block_pattern), F.lit(1))))
    first = lambda p: F.get(F.regexp_extract_all(F.col("col"), F.lit(p), F.lit(1)), F.lit(0))
    return blocks.select(*keep, F.col("pos").alias("position"), *[first(p).alias(n) for n, p in fields.items()])


def table_rows(df: DataFrame, html: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the first ``<table>`` of each page, header row skipped, cells by position as text.

    An empty cell is an empty string and an absent cell is null.
    """
    table = F.regexp_extract(F.col(html), TABLE_PATTERN, 1)
    rows = df.select(*keep, F.posexplode(F.regexp_extract_all(table, F.lit(ROW_PATTERN), F.lit(1))).alias("position", "row"))
    cells = F.regexp_extract_all("row", F.lit(CELL_PATTERN), F.lit(1))
    return (
        rows.filter(F.col("position") > 0)
        .withColumn("cells", cells)
        .select(*keep, "position", *[plain_text(F.get("cells", F.lit(i))).alias(c) for i, c in enumerate(columns)])
    )


#: The rest of a tag after its name; quoted attributes may hold any sign.
_REST = r"""[^'">]*+(?:(?:"[^"]*+"|'[^']*+')[^'">]*+)*+>"""
_TAG = r"(?i)</?[a-z!]" + _REST


def _after_first(parts: Column) -> Column:
    """All but the first; ``parts`` stands in the expression once, so it is computed once."""
    return F.filter(parts, lambda _, i: i > 0)


def _outer_table(html: Column) -> Column:
    """Inside of the first ``<table>``; of tables within it only the text is left.

    The page is cut at its table tags, and a depth counter is folded over the few pieces. Lambdas compute an
    expression as often as it stands in them, so patterns run only where their result is kept.
    """
    bare = F.concat(F.lit(" "), F.regexp_replace(html, r"(?s)<!--.*?-->", ""))  # the first piece is before any table
    pieces = F.split(bare, r"(?i)(?=<table\b)|(?=</table\s*+>)")

    def take(state: Column, piece: Column) -> Column:
        depth = F.greatest(state["depth"] + F.when(F.substring(piece, 2, 1) == "/", -1).otherwise(1), F.lit(0))
        inside = F.regexp_replace(piece, r"(?i)^</?table\b" + _REST, "")
        text = F.when(depth == 1, inside).otherwise(F.concat(F.lit(" "), F.regexp_replace(inside, _TAG, "")))
        done = state["done"] | ((state["depth"] > 0) & (depth == 0))
        kept = F.when(~done & (depth > 0), F.array_append(state["kept"], text)).otherwise(state["kept"])
        return F.struct(depth.alias("depth"), done.alias("done"), kept.alias("kept"))

    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))
    return F.aggregate(_after_first(pieces), start, take, lambda state: F.array_join(state["kept"], ""))


def nested_table_rows(df: DataFrame, html: str, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows of the first ``<table>`` of each page like :func:`table_rows`, for pages as they are written: a
    table inside a cell counts as that cell's text, attributes may hold ``>``, comments are left out, and rows
    and cells need no end tags. Built-in expressions within the row; nothing is shuffled."""
    row, cell = r"(?i)<tr\b" + _REST, r"(?i)<t[dh]\b" + _REST
    upto = lambda text, end: F.get(F.split(text, end, 2), F.lit(0))
    rows = df.select(*keep, F.posexplode(_after_first(F.split(_outer_table(F.col(html)), row))).alias("position", "row"))
    cells = F.transform(_after_first(F.split(upto(F.col("row"), r"(?i)</tr\s*+>"), cell)), lambda c: upto(c, r"(?i)</t[dh]\s*+>"))
    rows = rows.where("position > 0").withColumn("cells", cells)

    def text(i: int) -> Column:
        value = F.regexp_replace(F.get("cells", F.lit(i)), _TAG, "")
        for entity, char in ENTITIES.items():
            value = F.replace(value, F.lit(entity), F.lit(char))
        return F.trim(F.regexp_replace(value, r"\s+", " "))

    return rows.select(*keep, "position", *[text(i).alias(c) for i, c in enumerate(columns)])
