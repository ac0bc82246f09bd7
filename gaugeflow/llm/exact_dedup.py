"""Exact duplicates by radix tries over length-and-content-hash partitions."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, read, whole_text
from .radix import RadixTrie
from .tokens import release

#: Bytes that a trie holds before its subtrees are given up.
HELD = 24 << 20

_FIELDS = [("size", pa.int64()), ("slot", pa.int64()), ("text_sha256", pa.string()), ("body", pa.binary()), ("keep_id", pa.int64()), ("n", pa.int64())]
_SCHEMA = "size long, slot long, text_sha256 string, body binary, keep_id long, n long"


def _rows(found: Iterator, bodies: bool) -> Iterator[pa.RecordBatch]:
    """Batches of bounded bytes from terminals tagged (size, slot, sha)."""
    rows, held = [], 0
    for body, node in found:
        rows.append((*node.tag, body if bodies else None, node.keep, node.count))
        held += len(body) + 100
        if held > 4 << 20:
            yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], names=[f for f, _ in _FIELDS])
            rows, held = [], 0
    if rows:
        yield pa.record_batch([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _FIELDS)], names=[f for f, _ in _FIELDS])


def _merge(bodies: bool, by_slot: bool, limit: int):
    """A pass over batches through one trie. ``by_slot``: rows come sorted by (size, slot), so the trie is
    given up whenever they change; else when it holds ``limit`` bytes. What a trie gives up twice (a text
    that came back after a spill) is united by whoever reads the rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        trie, at = RadixTrie(), None
        for batch in batches:
            columns = [batch.column(f).to_pylist() for f, _ in _FIELDS]
            for size, slot, sha, body, keep, n in zip(*columns):
                if trie.held > limit or (by_slot and at != (size, slot) and trie.held > limit // 8):
                    yield from _rows(trie.spill(), bodies)
                at = (size, slot)
                trie.insert(body, keep, n, (size, slot, sha))
        yield from _rows(trie.spill(), bodies)

    return run


def text_groups(df: DataFrame, key: str = "doc_id", text: str = "text", held: int = HELD) -> DataFrame:
    """One row ``(text_sha256, keep_id, group_size)`` per distinct normalised text.

    A first trie in each task unites the copies that lie there, so a text that fills a third of the
    table reaches the shuffle once per task. What is left meets by (length, content hash), sorted, in a
    second trie that compares full byte strings. ``keep_id`` is the smallest key, null only if all are.
    """
    body = F.regexp_replace(whole_text(text), SPACE, " ").cast("binary")
    source = df.select(body.alias("body"), F.col(key).cast("long").alias("keep_id")).select(
        F.octet_length("body").cast("long").alias("size"),
        F.xxhash64("body").bitwiseAND(F.lit(0xFFFF)).alias("slot"),
        F.sha2("body", 256).alias("text_sha256"),
        "body",
        "keep_id",
        F.lit(1).cast("long").alias("n"),
    )
    local = source.mapInArrow(_merge(True, False, held), _SCHEMA)
    met = local.repartition("size", "slot").sortWithinPartitions("size", "slot")
    owners = met.mapInArrow(_merge(False, True, held), _SCHEMA)
    return owners.groupBy("text_sha256").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))


def exact_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", held: int = HELD) -> DataFrame:
    """Add ``keep_id, group_size, kept, text_sha256`` to every row of ``df``.

    Texts are equal when identical after each run of ASCII white space became one space; null counts
    as empty. The row with the smallest key stays; a null key stays only if its text has no other key.
    Rows that repeat both key and text are all marked kept (``drop_duplicates`` leaves one of them).
    Columns of ``df`` with the added names are replaced; all others stay.
    """
    names = ("keep_id", "group_size", "kept", "text_sha256")
    groups = text_groups(df, key, text, held)
    rows = df.drop(*names).withColumn("text_sha256", F.sha2(F.regexp_replace(whole_text(text), SPACE, " ").cast("binary"), 256))
    return rows.join(groups, "text_sha256").withColumn("kept", F.col(key).cast("long").eqNullSafe(F.col("keep_id")))


def drop_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``df`` per distinct text, with the columns of ``df``."""
    marked = exact_duplicates(df, key, text)
    return marked.where("kept").dropDuplicates(["text_sha256"]).select(*[F.col(f"`{c}`") for c in df.columns])


def exact_dedup(spark, sf: str) -> DataFrame:
    """Owners of every row of ``documents``."""
    docs = read(spark, sf, "documents").select("doc_id", "text")
    return exact_duplicates(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


SQL = r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY ALL)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
"""
