"""Query registry and the frames that several queries share."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package


class Query(NamedTuple):
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; without ``sql`` only its row count is checked by the driver."""

    def add(run):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


CHANNELS = ["click", "view", "signup", "purchase", "error"]


#: Users that a key has room for.
USERS = 1 << 40


def _wide(events: DataFrame, period, factor: int) -> DataFrame:
    """Events as a wide sensor table: one row per user and period, one channel per event type.

    Conditional averages in a single aggregate. The last digit of a sum of doubles depends on the order of the
    terms, and bins and decimals of rows that lie on an edge depend on that digit. So a group's rows are added up
    in the order of the table, however tasks cut it: one shuffle and a sort; groups stream by and are never held.
    The key has the user (0 to ``USERS``) and the period; periods from 0 to ``factor`` stand in its last digits.
    """
    channels = [F.avg(F.when(F.col("event_type") == c, F.col("value"))).alias(c) for c in CHANNELS]
    place = {"file": "_metadata.file_path", "row": "_metadata.row_index"}
    rows = events.select("user_id", period.cast("long").alias("period"), "ts", "event_type", "value", *[F.col(c).alias(n) for n, c in place.items()])
    ordered = rows.repartition("user_id", "period").sortWithinPartitions("user_id", "period", *place)
    grouped = ordered.groupBy("user_id", "period").agg(F.min("ts").alias("first_ts"), *channels)
    key = F.col("user_id") * factor + F.pmod("period", F.lit(factor)) + F.floor(F.col("period") / factor) * (factor * USERS)
    return grouped.withColumn("reading_id", key)


def weekly(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks from Monday on, counted from that of 2024-01-01. About a tenth of each channel is null."""
    days = F.datediff(F.date_trunc("week", "ts"), F.lit("2024-01-01").cast("date"))
    return _wide(table(spark, sf, "events"), F.floor(days / 7), 10)


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """Days counted from 2024-01-01 as 1. More than half of each channel is null."""
    return _wide(table(spark, sf, "events"), F.datediff(F.date_trunc("day", "ts"), F.lit("2023-12-31").cast("date")), 100)


def _wide_sql(name: str, period: str, factor: int) -> str:
    channels = ", ".join(f"avg(value) FILTER (WHERE event_type = '{c}') AS {c}" for c in CHANNELS)
    key = f"user_id * {factor} + (period % {factor} + {factor}) % {factor} + CAST(floor(period / {factor}) AS BIGINT) * {factor * USERS}"
    return (
        f"{name} AS (SELECT user_id, period, {key} AS reading_id, min(ts) AS first_ts, {channels} "
        f"FROM (SELECT *, CAST({period} AS BIGINT) AS period FROM events) GROUP BY user_id, period)"
    )


WEEKLY = _wide_sql("weekly", "floor((CAST(date_trunc('week', ts) AS DATE) - DATE '2024-01-01') / 7)", 10)
DAILY = _wide_sql("daily", "CAST(date_trunc('day', ts) AS DATE) - DATE '2023-12-31'", 100)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def rounded_sql(columns, digits: int = 6) -> str:
    return ", ".join(f"round({c}, {digits}) AS {c}" for c in columns)
