"""One JSON array over many lines, read by many tasks.

Whether a byte is inside a string, and how deep it is nested, depends on all bytes before it. For a block of a
file that is a transition: from either start (inside a string or outside) to an end, a change of depth and,
once the start is known, borders. Transitions compose, so a first scan gives each block's table, one small row
per block tells each block how it starts, and a second scan cuts all blocks into records side by side.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

_KIND = np.zeros(256, np.int8)
_KIND[[ord("{"), ord("[")]] = 1
_KIND[[ord("}"), ord("]")]] = -1
#: Sign at which the text reader cuts a file. It ends objects, so pieces are short, and no escape spans it.
END = "}"


def _masks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parity of the quotes up to each byte, and the nesting step of each byte if it is outside strings."""
    slash = data == ord("\\")
    quote = data == ord('"')
    if slash.any():
        at = np.arange(len(data))
        last = np.maximum.accumulate(np.where(slash, -1, at))  # the last sign that is no backslash
        before = np.concatenate([[0], (at - last)[:-1]])  # backslashes right before each sign
        quote &= before % 2 == 0
    return np.cumsum(quote) & 1, _KIND[data]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """``(file, block, bytes)``; pieces of a block come in their order."""
    for batch in batches:
        files, blocks = batch.column("file").to_pylist(), batch.column("block").to_pylist()
        edges = [i for i in range(batch.num_rows) if not i or (files[i], blocks[i]) != (files[i - 1], blocks[i - 1])]
        for a, b in zip(edges, [*edges[1:], batch.num_rows]):
            yield files[a], blocks[a], "".join(v + END for v in batch.column("value").slice(a, b - a).to_pylist()).encode()


def _tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per block: change of depth for a start outside and inside a string, and whether that is kept."""
    found: dict[tuple[str, int], list[int]] = {}
    for file, block, piece in _pieces(batches):
        inside, step = _masks(np.frombuffer(piece, np.uint8))
        own = found.setdefault((file, block), [0, 0, 0])
        depth = [int(step[inside == 0].sum()), int(step[inside == 1].sum())]
        for start in (0, 1):
            own[start] += depth[start ^ own[2]]
        own[2] ^= int(inside[-1])
    rows = [(*k, *v) for k, v in found.items()]
    names = ["file", "block", "outside", "inside", "turns"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.record_batch([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)


def _records(starts: dict[tuple[str, int], tuple[int, int]]):
    """Blocks to parts of records: ``(file, block, part, begins, ends, text)``. A part that does not begin or
    end here belongs to its neighbours."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, begun, number, out = [], None, False, 0, []
        inside = depth = 0

        def row(text: bytes, ends: bool) -> None:
            nonlocal number, begun
            if text or begun or ends:
                out.append((*key, number, begun, ends, text.decode()))
            number, begun = number + 1, True

        def flush() -> None:
            rest = b"".join(held)
            if rest.strip() or begun:
                row(rest, False)

        def made() -> pa.RecordBatch:
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
            names = ["file", "block", "part", "begins", "ends", "text"]
            return pa.record_batch([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

        for file, block, piece in _pieces(batches):
            if (file, block) != key:
                if key is not None:
                    flush()
                held, key, number, begun = [], (file, block), 0, False
                inside, depth = starts[key]
            data = np.frombuffer(piece, np.uint8)
            quoted, step = _masks(data)
            outside = (quoted ^ inside) == 0
            level = depth + np.cumsum(np.where(outside, step, 0))
            opens = outside & (level == 1) & (data == ord("["))
            comma = outside & (level == 1) & (data == ord(","))
            closes = outside & (level == 0) & (data == ord("]"))
            at, within = 0, depth > 0
            for border in np.flatnonzero(opens | comma | closes):
                held.append(piece[at:border])
                if not opens[border]:
                    row(b"".join(held), True)
                within = begun = not closes[border]
                held, at = [], border + 1
            if within:  # signs outside the array are no record
                held.append(piece[at:])
            inside, depth = inside ^ int(quoted[-1]), int(level[-1])
            if len(out) >= 5000:
                yield made()
                out = []
        if key is not None:
            flush()
        if out:
            yield made()

    return cut


def read_json_array_blocks(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of files that each hold one JSON array, over any number of lines; each block of a file is read by
    a task of its own (as large as ``spark.sql.files.maxPartitionBytes`` allows).

    Files are scanned twice. The driver holds five numbers per block. A record that spans blocks is put
    together from its parts. Malformed records give rows of nulls, as with other JSON readers; an empty array
    gives no rows. Files are UTF-8 and hold no split escape; a byte-order mark is not a record.
    """
    ship_package(spark)
    lines = spark.read.option("lineSep", END).text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    pieces = lines.select(*place, "value")
    tables = pieces.mapInArrow(_tables, "file string, block long, outside long, inside long, turns long")
    starts, before = {}, {}
    for t in sorted(tables.collect()):
        inside, depth = before.get(t["file"], (0, 0))
        starts[t["file"], t["block"]] = inside, depth
        before[t["file"]] = inside ^ t["turns"], depth + (t["inside"] if inside else t["outside"])
    parts = pieces.mapInArrow(_records(starts), "file string, block long, part long, begins boolean, ends boolean, text string")
    whole = parts.where("begins AND ends").select("text")
    # parts of records on block borders: at most two per block
    broken = parts.where("NOT (begins AND ends)")
    order = Window.partitionBy("file").orderBy("block", "part")
    broken = broken.withColumn("record", F.sum(F.col("begins").cast("long")).over(order))
    joined = broken.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("block", "part", "text"))).alias("parts"))
    joined = joined.select(F.array_join(F.transform("parts", lambda p: p["text"]), "").alias("text"))
    text = whole.unionByName(joined).where("trim(BOTH ' \\t\\r\\n' FROM text) != ''")
    return text.select(F.from_json("text", schema).alias("r")).select("r.*")
