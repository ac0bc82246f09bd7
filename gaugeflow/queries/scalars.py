"""Column expressions over driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions import arrays, labels, numbers, text
from ..operators import schema, scoring
from ..sources import records
from .registry import query, table


def _matches_sql(pattern: str, alias: str, group: int = 0) -> str:
    return (
        f"SELECT doc_id, CAST(i - 1 AS INTEGER) AS position, {alias} FROM (SELECT doc_id, unnest(m) AS {alias}, "
        f"generate_subscripts(m, 1) AS i FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}', {group}) AS m FROM documents))"
    )


def _matches(spark, sf, pattern, alias, group=0):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", F.posexplode(text.find_all(F.col("text"), pattern, group)).alias("position", alias))


@query("x1_find_emails", _matches_sql(presets.EMAIL_PATTERN, "email"))
def x1(spark, sf):
    return _matches(spark, sf, presets.EMAIL_PATTERN, "email")


@query("x2_find_phone_numbers", _matches_sql("[0-9]{10}", "phone"))
def x2(spark, sf):
    return _matches(spark, sf, presets.PHONE_PATTERN, "phone")


@query("x3_find_group", _matches_sql("@([a-zA-Z0-9.-]+)", "domain", 1))
def x3(spark, sf):
    return _matches(spark, sf, "@([a-zA-Z0-9.-]+)", "domain", 1)


@query("x4_replace_all", "SELECT doc_id, md5(regexp_replace(text, '@[a-zA-Z0-9-]+.com', '@university.edu', 'g')) AS digest FROM documents")
def x4(spark, sf):
    replaced = text.replace_all(F.col("text"), "@[a-zA-Z0-9-]+.com", "@university.edu")
    return table(spark, sf, "documents").select("doc_id", F.md5(replaced).alias("digest"))


@query(
    "x5_text_pieces",
    """SELECT doc_id, substr(source, 1, 3) AS prefix, split_part(source, 'c', 2) AS piece, trim('  ' || lang || ' ') AS lang,
       try_cast(substr(source, 4, 2) AS INTEGER) AS number, md5(split_part(text, chr(10), 2)) AS second_line FROM documents""",
)
def x5(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        F.substring("source", 1, 3).alias("prefix"),
        text.split_text(F.col("source"), "c", 2).alias("piece"),
        F.trim(F.concat(F.lit("  "), "lang", F.lit(" "))).alias("lang"),
        F.substring("source", 4, 2).try_cast("int").alias("number"),
        F.md5(text.split_text(F.col("text"), "\n", 2)).alias("second_line"),
    )


@query("x6_utf8", "SELECT doc_id, CAST(strlen(text) AS INTEGER) AS bytes, md5(text) AS digest, true AS same FROM documents")
def x6(spark, sf):
    raw = text.to_utf8(F.col("text"))
    return table(spark, sf, "documents").select(
        "doc_id", F.octet_length(raw).alias("bytes"), F.md5(raw).alias("digest"), (text.from_utf8(raw) == F.col("text")).alias("same")
    )


def _vectors(spark, sf):
    return table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))


POSITIONS = "SELECT vec_id, CAST(i - 1 AS INTEGER) AS position, {0} FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)"


@query("x8_elementwise", POSITIONS.format("round(x + 5, 6) AS plus, round(x * 2, 6) AS twice"))
def x8(spark, sf):
    both = F.arrays_zip(arrays.add_scalar(F.col("v"), 5.0).alias("plus"), arrays.multiply_scalar(F.col("v"), 2.0).alias("twice"))
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(both).alias("position", "z"))
    return rows.select("vec_id", "position", F.round("z.plus", 6).alias("plus"), F.round("z.twice", 6).alias("twice"))


@query(
    "x9_array_literals",
    "SELECT l_orderkey, l_linenumber, round(l_quantity * 1 + l_discount * 10 + l_tax * 100, 6) AS weighted, CAST(3 AS INTEGER) AS width FROM lineitem",
)
def x9(spark, sf):
    weights = arrays.array_of([1.0, 10.0, 100.0])
    values = F.array("l_quantity", "l_discount", "l_tax")
    product = F.zip_with(values, weights, lambda a, b: a * b)
    weighted = F.round(arrays.array_sum(product), 6).alias("weighted")
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", weighted, F.size(weights).alias("width"))


@query(
    "x10_reshape",
    "SELECT vec_id, CAST((i - 1) // 8 AS INTEGER) AS row_no, CAST((i - 1) % 8 AS INTEGER) AS col_no, round(x, 6) AS x FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)",
)
def x10(spark, sf):
    rows = _vectors(spark, sf).select("vec_id", F.posexplode(arrays.reshape(F.col("v"), 8, 8)).alias("row_no", "cells"))
    cells = rows.select("vec_id", "row_no", F.posexplode("cells").alias("col_no", "x"))
    return cells.withColumn("x", F.round("x", 6))


@query(
    "x11_array_reductions",
    """SELECT vec_id, round(list_sum(v), 6) AS total, round(list_avg(v), 6) AS mean_value, round(list_max(v), 6) AS max_value,
       round(list_min(v), 6) AS min_value FROM (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings)""",
)
def x11(spark, sf):
    v = F.col("v")
    return _vectors(spark, sf).select(
        "vec_id",
        F.round(arrays.array_sum(v), 6).alias("total"),
        F.round(arrays.array_mean(v), 6).alias("mean_value"),
        F.round(F.array_max(v), 6).alias("max_value"),
        F.round(F.array_min(v), 6).alias("min_value"),
    )


@query("x12_clamp", "SELECT l_orderkey, l_linenumber, least(l_quantity / 25, 1) AS top, greatest(0, l_discount - 0.05) AS bottom, greatest(10, least(l_quantity, 40)) AS both FROM lineitem")
def x12(spark, sf):
    quantity = F.col("l_quantity")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.clamp(quantity / 25, high=1).alias("top"),
        numbers.clamp(F.col("l_discount") - 0.05, low=0).alias("bottom"),
        numbers.clamp(quantity, 10, 40).alias("both"),
    )


HUMIDITY_SQL = "(6.112 * exp(17.67 * {t} / ({t} + 243.5)) * {rh} * 2.1674) / (273.15 + {t})"


@query("x13_exponential_formula", f"SELECT l_orderkey, l_linenumber, round({HUMIDITY_SQL.format(t='l_quantity', rh='(l_discount * 1000)')}, 6) AS humidity FROM lineitem")
def x13(spark, sf):
    value = scoring.absolute_humidity(F.col("l_quantity"), F.col("l_discount") * 1000)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(value, 6).alias("humidity"))


@query("x14_round_half_even", "SELECT l_orderkey, l_linenumber, CAST(printf('%.2f', sqrt(l_extendedprice)) AS DOUBLE) AS root, CAST(printf('%.2f', l_quantity * l_discount * 0.5) AS DOUBLE) AS near_ties, round_even(l_quantity / 2, 0) AS half, CAST(printf('%.2f', l_extendedprice * pow(10, 8 + l_linenumber % 4) / 8.5) AS DOUBLE) AS large FROM lineitem")
def x14(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.round_half_even(F.sqrt("l_extendedprice"), 2).alias("root"),
        numbers.round_half_even(F.col("l_quantity") * F.col("l_discount") * 0.5, 2).alias("near_ties"),
        numbers.round_half_even(F.col("l_quantity") / 2, 0).alias("half"),
        numbers.round_half_even(F.col("l_extendedprice") * F.pow(F.lit(10.0), 8 + F.col("l_linenumber") % 4) / 8.5, 2).alias("large"),
    )


@query("x15_browser_rounding", "SELECT event_id, CAST(floor(value - 50.5 + 0.5) AS BIGINT) AS whole, printf('%.2f', value) AS fixed, printf('%.3f', sqrt(value) * 123456789012) AS large FROM events")
def x15(spark, sf):
    value = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", numbers.round_half_up_integer(value - 50.5).alias("whole"), numbers.fixed_text(value, 2).alias("fixed"),
        numbers.fixed_text(F.sqrt(value) * 123456789012, 3, "even").alias("large"),
    )


@query(
    "x16_bucket_label",
    """SELECT event_id, CASE WHEN value < 20 THEN 'low' WHEN value < 60 THEN 'mid' ELSE 'high' END AS left_closed,
       CASE WHEN value <= 20 THEN 'low' WHEN value <= 60 THEN 'mid' ELSE 'high' END AS right_closed FROM events""",
)
def x16(spark, sf):
    names = ["low", "mid", "high"]
    return table(spark, sf, "events").select(
        "event_id",
        labels.bucket_label(F.col("value"), [20, 60], names).alias("left_closed"),
        labels.bucket_label(F.col("value"), [20, 60], names, closed="right").alias("right_closed"),
    )


@query(
    "x17_lookup_with_default",
    """SELECT c_custkey, coalesce(CASE c_nationkey % 6 WHEN 0 THEN 'Clean' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' WHEN 3 THEN 'Severe' END, 'none') AS state,
       coalesce(n_name, 'unknown') AS nation
       FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey""",
)
def x17(spark, sf):
    nations = table(spark, sf, "nation").filter("n_nationkey <> 7")
    named = schema.lookup_join(table(spark, sf, "customer"), "c_nationkey", nations, "n_nationkey", "n_name", "nation", "unknown")
    return named.select("c_custkey", labels.lookup(F.col("c_nationkey") % 6, presets.CLUSTER_NAMES, "none").alias("state"), "nation")


@query(
    "x18_json_parse_build",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_object('event_id', event_id, 'type', event_type)::VARCHAR AS built FROM events",
)
def x18(spark, sf):
    parsed = records.parse_json(F.col("props"), "k long")
    built = F.to_json(F.struct("event_id", F.col("event_type").alias("type")))
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"), built.alias("built"))


@query(
    "x19_text_formatting",
    """SELECT l_orderkey, l_linenumber, printf('%.1f%%', l_discount * 100) AS share, printf('%.4f', l_tax) AS tax,
       rpad(l_returnflag, 4, ' ') AS flag, lpad(CAST(l_partkey AS VARCHAR), 12, ' ') AS part FROM lineitem""",
)
def x19(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        numbers.percent_text(F.col("l_discount")).alias("share"),
        numbers.fixed_text(F.col("l_tax"), 4).alias("tax"),
        numbers.padded(F.col("l_returnflag"), 4).alias("flag"),
        numbers.padded(F.col("l_partkey"), 12, right_align=True).alias("part"),
    )
