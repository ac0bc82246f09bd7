"""Fixed-width binary files of 4-byte little-endian unsigned integers.

Files are read by Spark's ``binaryFile`` reader and cut into values on Arrow batches. Spark has no writer of
plain bytes, so :class:`UInt32Source` is a sink only (``df.write.format("uint32le")`` after :func:`register`):
one file per task, written below ``_temporary``; only files of successful attempts are published, so a lost
executor leaves no partial or duplicate data behind.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from ..session import ship_package

WIDTH = 4
#: Bytes of a file that become one batch of values.
BATCH_BYTES = 1 << 21


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[len("file:") :]
    return fs.FileSystem.from_uri(path)


@dataclass
class WrittenFile(WriterCommitMessage):
    name: str


class UInt32Source(DataSource):
    @classmethod
    def name(cls) -> str:
        return "uint32le"

    def schema(self) -> str:
        return "value long"

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        return UInt32Writer(self.options, overwrite)


class UInt32Writer(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.overwrite = overwrite
        self.job = uuid.uuid4().hex

    def write(self, iterator) -> WrittenFile:
        import numpy as np
        from pyspark import TaskContext

        task = TaskContext.get()
        system, root = _filesystem(self.path)
        stage = f"{root}/_temporary/{self.job}"
        system.create_dir(stage, recursive=True)
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{self.job}.bin"
        with system.open_output_stream(f"{stage}/{name}") as sink:
            for batch in iterator:
                column = batch.column(0)
                if column.null_count:
                    raise ValueError("null cannot be stored as a 4-byte integer")
                values = column.to_numpy(zero_copy_only=False).astype("int64")
                if len(values) and (values.min() < 0 or values.max() > 0xFFFFFFFF):
                    raise OverflowError("value outside the unsigned 32-bit range")
                sink.write(np.ascontiguousarray(values, dtype="<u4").tobytes())
        return WrittenFile(name)

    def commit(self, messages) -> None:
        from pyarrow import fs

        system, root = _filesystem(self.path)
        before = [f.path for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)) if f.type == fs.FileType.File]
        for message in messages:
            if message is not None:
                system.move(f"{root}/_temporary/{self.job}/{message.name}", f"{root}/{message.name}")
        if self.overwrite:  # once the new files stand
            for path in before:
                system.delete_file(path)
        self._clean(system, root)
        system.open_output_stream(f"{root}/_SUCCESS").close()

    def abort(self, messages) -> None:
        self._clean(*_filesystem(self.path))

    def _clean(self, system, root) -> None:
        from pyarrow import fs

        stage = f"{root}/_temporary/{self.job}"
        if system.get_file_info(stage).type == fs.FileType.Directory:
            system.delete_dir(stage)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(UInt32Source)


def _values(batch_bytes: int):
    step = max(WIDTH, batch_bytes // WIDTH * WIDTH)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np

        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                data = content.as_buffer()
                if data.size % WIDTH:
                    raise ValueError(f"{path}: {data.size} bytes is not a whole number of {WIDTH}-byte records")
                for start in range(0, data.size, step):
                    values = np.frombuffer(data, "<u4", min(step, data.size - start) // WIDTH, start).astype("int64")
                    yield pa.record_batch([pa.array(values)], names=["value"])

    return cut


def read_uint32(spark: SparkSession, path: str, split_bytes: int = BATCH_BYTES) -> DataFrame:
    """Column ``value`` from a file, or from all files of a folder and the folders in it; a file with a short
    last record is rejected. A file is read by one task and held in memory, so it may have 2 GB at most (the
    limit of Spark's reader); ``split_bytes`` of it become one batch."""
    ship_package(spark)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInArrow(_values(split_bytes), "value long")


def write_uint32(df: DataFrame, column: str, path: str, mode: str = "overwrite") -> None:
    register(df.sparkSession)
    value = df.select(df[column].cast("long").alias("value"))
    value.write.format("uint32le").mode(mode).save(path)
