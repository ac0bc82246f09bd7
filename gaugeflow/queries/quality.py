"""Data-quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions import clock
from ..operators import quality
from .registry import CHANNELS, DAILY, WEEKLY, daily, query, rounded, table, weekly


@query("m1_locale_decimal", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber <> 3 THEN l_extendedprice END AS price FROM lineitem")
def m1(spark, sf):
    comma = F.translate(F.col("l_extendedprice").cast("decimal(20,2)").cast("string"), ".", ",")
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.when(F.col("l_linenumber") == 3, "n/a").otherwise(comma).alias("price")
    )
    return quality.repair_decimals(lines, ["price"])


@query("m2_sentinel_to_null", "SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events")
def m2(spark, sf):
    return quality.null_out_sentinel(with_sentinel(spark, sf), ["value"], presets.SENTINEL).select("event_id", "value")


def with_sentinel(spark, sf):
    """Events in which every tenth value carries the missing marker."""
    marked = F.when(F.col("event_id") % 10 == 0, presets.SENTINEL).otherwise(F.col("value"))
    return table(spark, sf, "events").withColumn("value", marked)


@query(
    "m3_missing_counts",
    f"WITH {WEEKLY} {' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM weekly''' for c in ['reading_id', *CHANNELS])}",
)
def m3(spark, sf):
    return quality.missing_counts(weekly(spark, sf).select("reading_id", *CHANNELS))


def _fractions_sql(source):
    return " UNION ALL ".join(
        f"SELECT '{source}' AS source, '{c}' AS column_name, round(1 - count({c}) / count(*), 6) AS null_fraction, "
        f"1 - count({c}) / count(*) <= 0.40 AS kept FROM {source}"
        for c in CHANNELS
    )


@query("m4_null_fraction_drop", f"WITH {DAILY}, {WEEKLY} {_fractions_sql('daily')} UNION ALL {_fractions_sql('weekly')}")
def m4(spark, sf):
    out = None
    for name, frame in (("daily", daily(spark, sf)), ("weekly", weekly(spark, sf))):
        frame = frame.select("reading_id", *CHANNELS)
        left, kept, _ = quality.drop_sparse_columns(frame, CHANNELS, presets.SPARSE_THRESHOLD)
        still = [c for c in CHANNELS if c in left.columns]
        part = quality.null_fractions(frame, CHANNELS).select(
            F.lit(name).alias("source"), "column_name", F.round("null_fraction", 6).alias("null_fraction"),
            F.col("column_name").isin(*still, *kept).alias("kept"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "m4_drop_sparse_columns",
    f"WITH {WEEKLY} SELECT reading_id, {', '.join(f'round({c}, 8) AS {c}' for c in CHANNELS)} FROM weekly",
)
def m4_drop(spark, sf):
    sparse = F.when(F.col("reading_id") % 2 == 0, F.col("click"))
    wide = weekly(spark, sf).select("reading_id", *CHANNELS, sparse.alias("half"))
    left, kept, _ = quality.drop_sparse_columns(wide, [*CHANNELS, "half"], presets.SPARSE_THRESHOLD)
    return rounded(left, *kept, digits=8)


@query(
    "m5_mean_imputation",
    f"WITH {WEEKLY} SELECT reading_id, {', '.join(f'round(coalesce({c}, (SELECT avg({c}) FROM weekly)), 8) AS {c}' for c in CHANNELS)} FROM weekly",
)
def m5(spark, sf):
    wide = weekly(spark, sf).select("reading_id", *CHANNELS)
    return rounded(quality.impute_mean(wide, CHANNELS), *CHANNELS, digits=8)


@query("m6_defaults", f"WITH {WEEKLY} SELECT reading_id, round(coalesce(click, 0.0), 8) AS click, round(coalesce(view, 20.0), 8) AS view, 50.0::DOUBLE AS humidity FROM weekly")
def m6(spark, sf):
    wide = weekly(spark, sf).select("reading_id", "click", "view")
    return rounded(quality.fill_defaults(wide, {"click": 0.0, "view": 20.0, "humidity": 50.0}), "click", "view", digits=8)


@query("m7_parse_or_default", "SELECT doc_id, coalesce(try_cast(trim(split_part(text, ' ', 1)) AS INTEGER), 0) AS first_number, coalesce(try_cast(replace(source, 'src', '') AS INTEGER), 0) AS source_number FROM documents")
def m7(spark, sf):
    first = clock.hour_from_parts(F.col("text"), " ", default=0)
    number = clock.hour_from_parts(F.replace("source", F.lit("src"), F.lit("")), default=0)
    return table(spark, sf, "documents").select("doc_id", first.alias("first_number"), number.alias("source_number"))


@query("m8_hour_of_day", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS from_prefix, CAST(hour(ts) AS INTEGER) AS from_parts, CAST(hour(ts) AS INTEGER) AS from_iso FROM events")
def m8(spark, sf):
    dotted = F.date_format("ts", "HH.mm.ss")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "events").select(
        "event_id",
        clock.hour_from_prefix(dotted).alias("from_prefix"),
        clock.hour_from_parts(dotted).alias("from_parts"),
        clock.hour_from_iso(iso).alias("from_iso"),
    )


@query(
    "m9_rush_hour_flag",
    """SELECT event_id, CAST(hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 AS INTEGER) AS batch,
       CAST(hour(ts) BETWEEN 8 AND 10 OR hour(ts) BETWEEN 17 AND 19 AS INTEGER) AS service,
       CAST(hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 AS INTEGER) AS panel FROM events""",
)
def m9(spark, sf):
    hour = F.hour("ts")
    return table(spark, sf, "events").select(
        "event_id",
        clock.rush_flag(hour, presets.RUSH_PIPELINE).alias("batch"),
        clock.rush_flag(hour, presets.RUSH_SERVICE).alias("service"),
        clock.rush_flag(hour, presets.RUSH_PANEL).alias("panel"),
    )


@query("m10_parse_timestamp", "SELECT event_id, CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS seconds FROM events")
def m10(spark, sf):
    stamp = clock.parse_timestamp(F.date_format("ts", "dd/MM/yyyy"), F.date_format("ts", "HH.mm.ss"))
    seconds = F.unix_timestamp(stamp) - F.unix_timestamp(F.lit("1970-01-01 00:00:00").cast("timestamp"))
    return table(spark, sf, "events").select("event_id", seconds.alias("seconds"))


@query("m11_median_binarisation", "SELECT o_orderkey, CAST(o_totalprice > (SELECT median(o_totalprice) FROM orders) AS INTEGER) AS high FROM orders")
def m11(spark, sf):
    flagged, _ = quality.binarise_by_median(table(spark, sf, "orders"), "o_totalprice", "high")
    return flagged.select("o_orderkey", "high")
