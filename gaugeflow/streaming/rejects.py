"""Routing of malformed records to a reject table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.records import is_malformed, parse_json


def route_malformed(
    source: DataFrame, column: str, schema: str, output: str, good_path: str, reject_path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Parsed records go to ``good_path``, unparsable ones to ``reject_path``.

    Every batch writes its own ``batch_id`` folder in overwrite mode, so a batch that is run again
    after a failure replaces its earlier output instead of adding to it.
    """

    def write_both(batch: DataFrame, batch_id: int) -> None:
        judged = batch.withColumn("__bad", F.coalesce(is_malformed(F.col(column), schema), F.lit(False))).persist()
        try:
            parsed = judged.filter(~F.col("__bad")).withColumn(output, parse_json(F.col(column), schema))
            rejected = judged.filter("__bad")
            parsed.drop("__bad").write.mode("overwrite").parquet(f"{good_path}/batch_id={batch_id}")
            rejected.drop("__bad").write.mode("overwrite").parquet(f"{reject_path}/batch_id={batch_id}")
        finally:
            judged.unpersist()

    return (
        source.writeStream.foreachBatch(write_both)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
