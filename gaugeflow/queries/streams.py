"""Streaming operators: driver tables are read as file streams to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sources.readings import stream_table
from ..streaming.latest import follow_latest, maintain_latest, read_followed, read_latest
from ..streaming.rejects import route_malformed
from ..streaming.scoring import score_stream
from .ranking import LATEST_SQL
from .registry import query, table
from .scores import RECORD_SQL, scored_events


def event_stream(spark, sf):
    return stream_table(spark, sf, table(spark, sf, "events").schema, "events.parquet")


@query("t1_stream_scoring", RECORD_SQL)
def t1(spark, sf):
    out = scratch_dir(spark, "t1")
    score_stream(event_stream(spark, sf), scored_events, f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table")


@query(
    "t2_malformed_routing",
    """SELECT event_id, CASE WHEN event_id % 10 < 3 THEN 'rejected' ELSE 'parsed' END AS route,
       CASE WHEN event_id % 10 >= 3 THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def t2(spark, sf):
    out = scratch_dir(spark, "t2")
    cut = F.expr("substring(props, 1, length(props) - 1)")
    kind, props = F.col("event_id") % 10, F.col("props")
    listed, wrong = F.concat(F.lit("["), props, F.lit("]")), F.lit('{"k": "abc"}')
    twice = F.concat(F.lit('{"k": 0, '), F.substring_index(props, "{", -1))  # the last value of a key counts
    broken = F.when(kind == 0, cut).when(kind == 1, listed).when(kind == 2, wrong).when(kind == 3, twice).otherwise(props)
    source = event_stream(spark, sf).select("event_id", broken.alias("props"))
    route_malformed(source, "props", "k long", "parsed", f"{out}/good", f"{out}/bad", f"{out}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{out}/good").select("event_id", F.lit("parsed").alias("route"), F.col("parsed.k").alias("k"))
    bad = spark.read.parquet(f"{out}/bad").select("event_id", F.lit("rejected").alias("route"), F.lit(None).cast("long").alias("k"))
    return good.unionByName(bad)


def _landed(spark, sf, out, parts, files):
    """Events as files that land one after another; file ``i`` has those with ``event_id % files = i``, so that
    most users have late rows in later files."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    for i in parts:
        events.where(F.col("event_id") % files == i).coalesce(1).write.parquet(f"{out}/in/part={i}")
    return stream_table(spark, f"{out}/in/part=*", events.schema, files_per_trigger=1)


def _followed(spark, sf, files=2):
    """Two runs of the stream, the second from the checkpoint of the first; the table's folder."""
    out, half = scratch_dir(spark, "t3"), files // 2
    for parts in (range(half), range(half, files)):
        source = _landed(spark, sf, out, parts, files)
        follow_latest(source, ["user_id"], ["ts", "event_id"], f"{out}/table", f"{out}/checkpoint", fold_every=3).awaitTermination()
    return f"{out}/table"


@query("t3_latest_per_location", LATEST_SQL)
def t3(spark, sf):
    return read_followed(spark, _followed(spark, sf), ["user_id"], ["ts", "event_id"]).drop("ts")


@query("t3_changed_keys", "SELECT CAST(event_id % 4 AS INTEGER) AS batch, count(DISTINCT user_id) AS changed FROM events GROUP BY 1")
def t3_changed(spark, sf):
    """What a batch writes: the keys it met, not the table."""
    path = _followed(spark, sf, files=4)
    rows = spark.read.option("basePath", path).parquet(f"{path}/changed=*")
    return rows.groupBy(F.col("changed").cast("int").alias("batch")).agg(F.count(F.lit(1)).alias("n")).withColumnRenamed("n", "changed")


@query("t3_latest_versions", LATEST_SQL)
def t3_versions(spark, sf):
    """The form that keeps whole versions of the table for readers."""
    out = scratch_dir(spark, "t3")
    source = event_stream(spark, sf).select("user_id", "ts", "event_id", "event_type", "value")
    maintain_latest(source, ["user_id"], ["ts", "event_id"], f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return read_latest(spark, f"{out}/table").drop("ts")
