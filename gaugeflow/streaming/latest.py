"""A table with the latest reading per key, maintained from a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ranking import latest_per


def _versions(spark: SparkSession, path: str):
    """Committed versions as ``{batch_id: folder}``; a version counts once its success marker exists."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    if system.exists(root):
        for status in system.listStatus(root):
            name = status.getPath().getName()
            if name.startswith("version=") and system.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
                found[int(name.split("=")[1])] = status.getPath().toString()
    return system, found


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """Newest committed version of the table."""
    _, found = _versions(spark, path)
    if not found:
        raise FileNotFoundError(f"no committed version below {path}")
    return spark.read.parquet(found[max(found)])


def maintain_latest(
    source: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, keep: int = 3, **trigger
) -> StreamingQuery:
    """Merge each batch into the latest-per-key table at ``path``.

    Order is event order (the ``order`` columns), so a late record never replaces a newer one.
    Batch ``n`` reads the newest version below ``n`` and writes version ``n``: running it again gives
    the same version. The merge is one mergeable aggregate; its cost follows the number of keys plus
    the batch, not the history. The newest ``keep`` versions remain for readers.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        system, found = _versions(spark, path)
        older = [v for v in found if v < batch_id]
        rows = batch
        if older:
            rows = spark.read.schema(batch.schema).parquet(found[max(older)]).unionByName(batch)
        latest_per(rows, keys, order).write.mode("overwrite").parquet(f"{path}/version={batch_id}")
        for version in sorted(older)[: max(0, len(older) - keep + 1)]:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(found[version]), True)

    return (
        source.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def latest_state(source: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A stream of the latest row per key, for output mode ``update``: each batch emits the keys that it met.

    The rows live in Spark's state store, one per key, and are restored from the checkpoint. Tasks reduce
    their own rows before the shuffle, so a hot key costs no more than others. Order is that of the columns
    of ``order``: a late row changes nothing.
    """
    rest = [c for c in source.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("newest")
    return source.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*source.columns)


def _folders(spark: SparkSession, path: str, kind: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    root, out = hadoop.Path(path), {}
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(root) if system.exists(root) else []:
        name = status.getPath().getName()
        if name.startswith(f"{kind}=") and system.exists(hadoop.Path(status.getPath(), "_SUCCESS")):
            out[int(name.split("=")[1])] = status.getPath().toString()
    return system, out


def _current(spark: SparkSession, path: str, keys, order, upto: int | None = None) -> DataFrame | None:
    _, bases = _folders(spark, path, "base")
    _, changed = _folders(spark, path, "changed")
    start = max((b for b in bases if upto is None or b <= upto), default=-1)
    parts = [folder for b, folder in sorted(changed.items()) if b > start and (upto is None or b <= upto)]
    folders = [*([bases[start]] if start >= 0 else []), *parts]
    if not folders:
        return None
    schema = spark.read.parquet(folders[0]).schema
    return latest_per(spark.read.schema(schema).parquet(*folders), keys, order)


def follow_latest(
    source: DataFrame, keys: Sequence[str], order: Sequence[str], path: str, checkpoint: str, fold_every: int = 32, **trigger
) -> StreamingQuery:
    """Keep the latest row per key with Spark's keyed state and write, per batch, only the keys it changed.

    Batch ``n`` writes ``changed=n``, again the same when it is repeated. Every ``fold_every`` batches the
    changes so far are folded into ``base=n`` and the folders it replaces are deleted once the next fold is
    done, so a reader that lists the table in between finds what it needs.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/changed={batch_id}")
        if (batch_id + 1) % fold_every:
            return
        system, bases = _folders(spark, path, "base")
        _current(spark, path, keys, order, batch_id).write.mode("overwrite").parquet(f"{path}/base={batch_id}")
        settled = max((b for b in bases if b < batch_id), default=-1)
        _, changed = _folders(spark, path, "changed")
        gone = [f for b, f in changed.items() if b <= settled] + [f for b, f in bases.items() if b < settled]
        for folder in gone:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(folder), True)

    return (
        latest_state(source, keys, order).writeStream.outputMode("update").foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_followed(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The latest row per key of a table written by :func:`follow_latest`."""
    found = _current(spark, path, keys, order)
    if found is None:
        raise FileNotFoundError(f"no committed batch below {path}")
    return found
