"""Token ids on disk: blocks of ids turned into bit or byte planes, each plane compressed by itself.

A store is a folder of Parquet files that Spark commits, so any store Spark can write will do. A row is a
chunk: ``shard, chunk`` (its place), ``first`` (ids of the shard before it), ``n`` ids, ``unit`` ("bit" or
"byte"), ``planes`` (one zstandard frame per plane, lowest first; missing high planes are all zero) and
``index``: ``(doc_id, start, n)`` of the documents that begin in it, starts counted within the shard.
Shards follow each other in document order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_dir, write_table
from .common import read, whole_text
from .tokens import encoder, portions

CHUNK = 1 << 16
_INDEX = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))
_ARROW = pa.schema([("shard", pa.int64()), ("chunk", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("unit", pa.string()), ("planes", pa.list_(pa.binary())), ("index", _INDEX)])
_SCHEMA = "shard long, chunk long, first long, n long, unit string, planes array<binary>, index array<struct<doc_id:long,start:long,n:long>>"


def to_planes(ids: np.ndarray, unit: str = "bit", level: int = 3) -> list[bytes]:
    """Transpose a block of 32-bit ids; one compressed frame per plane up to the highest set one."""
    press = zstandard.ZstdCompressor(level=level)
    width = int(ids.max()).bit_length() if len(ids) else 0
    if unit == "byte":
        rows = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
        return [press.compress(np.ascontiguousarray(rows[:, k]).tobytes()) for k in range(-(-width // 8))]
    return [press.compress(np.packbits((ids >> np.uint32(k)).astype(np.uint8) & 1).tobytes()) for k in range(width)]


def from_planes(planes: list[bytes], n: int, unit: str = "bit") -> np.ndarray:
    open_ = zstandard.ZstdDecompressor()
    ids = np.zeros(n, np.uint32)
    for k, plane in enumerate(planes):
        raw = np.frombuffer(open_.decompress(plane), np.uint8)
        ids |= (raw if unit == "byte" else np.unpackbits(raw, count=n)).astype(np.uint32) << np.uint32(8 * k if unit == "byte" else k)
    return ids


def _write(path: str, end: int, unit: str, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, first, at = TaskContext.get().partitionId(), 0, 0, 0
        held: list[np.ndarray] = []
        waiting, index = 0, []
        stop = np.array([end], np.uint32)

        def cut(n):
            nonlocal held, waiting, chunk, first, index
            ids = np.concatenate(held)
            block, held = ids[:n], [ids[n:]]
            here = [d for d in index if d["start"] < first + n]
            row = [shard, chunk, first, n, unit, to_planes(block, unit), here]
            index = index[len(here) :]
            chunk, first, waiting = chunk + 1, first + n, waiting - n
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j in portions(texts):
                for key, ids in zip(keys[i:j], encoder(path).encode(texts[i:j])):
                    held += [ids, stop]
                    index.append({"doc_id": key, "start": at, "n": len(ids) + 1})
                    at += len(ids) + 1
                    waiting += len(ids) + 1
                    while waiting >= size:
                        yield cut(size)
        if waiting:
            yield cut(waiting)

    return run


def write_tokens(df: DataFrame, path: str, vocabulary: str, end: int, key: str = "doc_id", text: str = "text", unit: str = "bit", size: int = CHUNK) -> None:
    """Encode every whole text (null: empty), put ``end`` after each and write the ids to ``path``.

    Documents go in ascending key order, nulls first, rows that share a key by text. A task turns one
    range of keys into one shard and holds about one chunk of ids at a time.
    """
    rows = df.select(F.col(key).cast("long").alias("doc_id"), whole_text(text).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text").asc()]
    spread = [order[0], F.xxhash64("text").asc()]
    order.insert(1, spread[1])
    chunks = rows.repartitionByRange(*spread).sortWithinPartitions(*order).mapInArrow(_write(vocabulary, end, unit, size), _SCHEMA)
    write_table(chunks, path)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, rows in _chunks(batches):
        open_, out = [], []  # documents begun and not ended: (doc_id, start, n, crc, ids so far)
        for row in rows:
            ids = from_planes(row["planes"], row["n"], row["unit"])
            begin, stop = row["first"], row["first"] + row["n"]
            open_ += [[d["doc_id"], d["start"], d["n"], 0] for d in row["index"]]
            left = []
            for d in open_:
                part = ids[max(d[1], begin) - begin : min(d[1] + d[2], stop) - begin]
                d[3] = zlib.crc32(part.astype("<u4").tobytes(), d[3])
                (out if d[1] + d[2] <= stop else left).append(d)
            open_ = left
            if len(out) >= 10_000:
                yield _documents(shard, out)
                out = []
        if out:
            yield _documents(shard, out)


def _chunks(batches):
    """(shard, its chunk rows one by one) from a stream sorted by shard and chunk."""
    rows = (row for batch in batches for k in range(batch.num_rows) for row in batch.slice(k, 1).to_pylist())
    row = next(rows, None)
    while row is not None:
        shard = row["shard"]

        def own():
            nonlocal row
            while row is not None and row["shard"] == shard:
                yield row
                row = next(rows, None)

        yield shard, own()


def _documents(shard, out):
    names = ["shard", "doc_id", "local", "n_tokens", "ids_crc32"]
    return pa.record_batch([pa.array(c, pa.int64()) for c in ([shard] * len(out), *([d[k] for d in out] for k in range(4)))], names=names)


def read_tokens(spark, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of a store: start counts the ids of all
    documents before it, the checksum is over its ids as little-endian 32-bit numbers."""
    chunks = spark.read.schema(_SCHEMA).parquet(path)
    sizes = chunks.groupBy("shard").agg(F.sum("n").alias("ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    offsets = sizes.select("shard", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("offset"))
    docs = chunks.repartition("shard").sortWithinPartitions("shard", "chunk").mapInArrow(_read, "shard long, doc_id long, local long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, "shard").select("doc_id", (F.col("offset") + F.col("local")).alias("start"), "n_tokens", "ids_crc32")


END = 2


def token_store(spark, sf: str) -> DataFrame:
    """Write the ids of every whole text of ``documents`` and read the documents back."""
    import public_tokenizers

    path = scratch_dir(spark, "tokens")
    write_tokens(read(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"), END)
    return read_tokens(spark, path)
