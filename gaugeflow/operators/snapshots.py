"""Tables that change by batches: every commit is a new snapshot, and readers keep the one they opened.

A table is a folder of data folders and of manifests, one per snapshot. Rows lie in buckets by the hash of
their key; a manifest names, for each bucket, the folder that holds it. A batch rewrites the buckets that its
keys fall into and shares the others with the snapshot before. Renaming the finished manifest into place is
the commit: until then nothing of a batch is visible, and of two batches that start from the same snapshot
only one can take the next number.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .changes import apply_changes

BUCKETS = 16


class CommitConflict(RuntimeError):
    """Another batch was committed since this one read its snapshot. Apply the batch again."""


def _files(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(path)
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop.Path


def snapshots(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed snapshots, oldest first."""
    system, at = _files(spark, path)
    folder = at(f"{path}/snapshots")
    names = [s.getPath().getName() for s in system.listStatus(folder)] if system.exists(folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))


def _manifest(spark: SparkSession, path: str, snapshot: int | None) -> dict:
    known = snapshots(spark, path)
    wanted = snapshot if snapshot is not None else (known or [None])[-1]
    if wanted not in known:
        raise FileNotFoundError(f"no snapshot {'' if snapshot is None else snapshot} of {path}")
    return json.loads(spark.read.text(f"{path}/snapshots/{wanted}.json", wholetext=True).first()[0])


def _commit(spark: SparkSession, path: str, manifest: dict) -> int:
    system, at = _files(spark, path)
    draft = at(f"{path}/drafts/{uuid.uuid4().hex}.json")
    out = system.create(draft, False)
    try:
        out.write(bytearray(json.dumps(manifest), "utf-8"))
    finally:
        out.close()
    place = at(f"{path}/snapshots/{manifest['snapshot']}.json")
    system.mkdirs(place.getParent())
    if system.exists(place) or not system.rename(draft, place):
        system.delete(draft, False)
        raise CommitConflict(f"snapshot {manifest['snapshot']} of {path} is taken")
    return manifest["snapshot"]


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(F.col(f"`{key}`")), F.lit(buckets)).cast("int")


def _written(rows: DataFrame, path: str, key: str, buckets: int) -> tuple[str, list[int]]:
    """Write rows by bucket into a new folder; its name and the buckets it has. A failure leaves no folder."""
    name = f"data/{uuid.uuid4().hex}"
    system, at = _files(rows.sparkSession, path)
    spread = rows.withColumn("__bucket", _bucket(key, buckets)).repartition("__bucket")
    try:
        spread.write.partitionBy("__bucket").parquet(f"{path}/{name}")
    except BaseException:
        system.delete(at(f"{path}/{name}"), True)
        raise
    found = [s.getPath().getName() for s in system.listStatus(at(f"{path}/{name}"))]
    return name, sorted(int(n.split("=")[1]) for n in found if n.startswith("__bucket="))


def _read(spark: SparkSession, path: str, schema: str, places: dict[str, str]) -> DataFrame:
    fields = T.StructType.fromJson(json.loads(schema))
    folders = [f"{path}/{name}/__bucket={b}" for b, name in sorted(places.items())]
    return spark.read.schema(fields).parquet(*folders) if folders else spark.createDataFrame([], fields)


def create_table(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> int:
    """First snapshot (number 0) of a table with a unique ``key``. Choose ``buckets`` so that one holds what a
    task can rewrite; a table keeps its number."""
    spark = rows.sparkSession
    if snapshots(spark, path):
        raise CommitConflict(f"{path} is a table already")
    name, found = _written(rows, path, key, buckets)
    manifest = {"snapshot": 0, "key": key, "buckets": buckets, "schema": rows.schema.json(), "places": {str(b): name for b in found}}
    return _commit(spark, path, manifest)


def read_table(spark: SparkSession, path: str, snapshot: int | None = None) -> DataFrame:
    """A snapshot, by default the newest. Later commits do not change what it reads."""
    manifest = _manifest(spark, path, snapshot)
    return _read(spark, path, manifest["schema"], manifest["places"])


def commit_changes(spark: SparkSession, path: str, changes: DataFrame, op: str = "op", seq: str = "seq") -> int:
    """Apply a batch (see :func:`apply_changes`) to the newest snapshot and commit it as the next one.

    Only buckets with changed keys are read and written. A batch that fails, or meets a commit of another
    one, deletes what it wrote and raises. An empty batch commits a snapshot equal to the one before.
    """
    before = _manifest(spark, path, None)
    key, buckets, places = before["key"], before["buckets"], before["places"]
    changed = changes.select(_bucket(key, buckets).alias("b")).distinct()
    touched = {str(r["b"]) for r in changed.collect()}  # at most ``buckets`` numbers
    base = _read(spark, path, before["schema"], {b: name for b, name in places.items() if b in touched})
    after, name = {b: folder for b, folder in places.items() if b not in touched}, None
    if touched:
        name, found = _written(apply_changes(base, changes, key, op, seq), path, key, buckets)
        after |= {str(b): name for b in found}
    try:
        return _commit(spark, path, before | {"snapshot": before["snapshot"] + 1, "places": after})
    except BaseException:
        if name:
            system, at = _files(spark, path)
            system.delete(at(f"{path}/{name}"), True)
        raise


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` snapshots and the folders that no snapshot needs any more, those of
    failed batches included. Returns the numbers that stay. Run it while no batch is being applied."""
    system, at = _files(spark, path)
    known = snapshots(spark, path)
    stay = known[-keep:]
    for number in known[: len(known) - len(stay)]:
        system.delete(at(f"{path}/snapshots/{number}.json"), False)
    used = {name.split("/")[1] for n in stay for name in _manifest(spark, path, n)["places"].values()}
    folder = at(f"{path}/data")
    for status in system.listStatus(folder) if system.exists(folder) else []:
        if status.getPath().getName() not in used:
            system.delete(status.getPath(), True)
    return stay
