"""Session construction and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


#: Spark's switch for giving up shuffle files at the end of an execution.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes after which Spark ends a batch for Python, and what intermediate tables are written with: a batch of
#: Spark's own 10000 rows of long texts takes tens of MB, twice in the executor and several times in Python.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def get_session(app_name: str = "gaugeflow", master: str | None = None, **conf: str) -> SparkSession:
    """Build or fetch a session.

    Only session-level defaults are set here; no operator changes configuration. Shuffle partition
    counts are left to adaptive execution unless the caller passes one.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application, as ``--py-files`` would.

    Without it a worker finds the package only if its own path or working folder has it.
    """
    context = spark.sparkContext
    if getattr(context, "_gaugeflow_shipped", False):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="run-"), "gaugeflow.zip")  # Spark serves it from the driver
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("gaugeflow", os.path.relpath(path, package)))
    context.addPyFile(archive)
    context._gaugeflow_shipped = True


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path for intermediate tables, under the cluster's shared checkpoint folder. It is
    deleted when the driver ends.

    ``spark.checkpoint.dir`` names the shared folder. A machine-local temporary folder is used only
    in local mode with the setting absent; on a cluster a missing setting is an error, because a
    local folder would be invisible to the other executors.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="run-")
    path = f"{base.rstrip('/')}/gaugeflow-{label}-{uuid.uuid4().hex}"
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return path


def write_table(df: DataFrame, path: str) -> None:
    """Write Parquet in batches of bounded bytes and give up the shuffle files that led to it."""
    spark = df.sparkSession
    before = {CLEANUP: spark.conf.get(CLEANUP, "false"), BATCH: spark.conf.get(BATCH)}
    spark.conf.set(CLEANUP, "true")
    spark.conf.set(BATCH, BATCH_BYTES)
    try:
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in shared scratch space and read it back.

    Cuts lineage in a way that survives executor loss; use it before several passes over an
    expensive input that is too large to rely on caching. The shuffle files that led to the table are
    given up as soon as it is written: nothing reads them again.
    """
    path = scratch_dir(df.sparkSession, label)
    write_table(df, path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._gaugeflow_path = path
    return table


def release(table: DataFrame) -> None:
    """Delete a table that :func:`materialise` returned, once nothing reads it any more. Iterative jobs use
    it to keep one round on disk instead of all."""
    spark, path = table.sparkSession, getattr(table, "_gaugeflow_path", None)
    if path is not None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        table._gaugeflow_path = None
