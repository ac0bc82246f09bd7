"""Continuous, stateless scoring."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def score_stream(
    source: DataFrame, transform: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Apply a batch operator to a stream and append the result to Parquet.

    The file sink's log makes the output exactly-once. The default trigger processes what has landed
    and stops; pass e.g. ``processingTime="1 minute"`` for a standing query.
    """
    return (
        transform(source)
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
