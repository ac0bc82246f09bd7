"""Scans and sinks: data derived from the driver tables is written to scratch space and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bytes as byte_columns
from ..operators import schema
from ..session import scratch_dir
from ..sources import delimited, fixed_width, markup, readings, records, text
from ..sources.json_array import read_json_array_blocks
from ..streaming.scoring import score_stream
from .registry import query, table

PLAIN_EVENTS = "SELECT event_id, user_id, event_type, value FROM events"
EVENT_COLUMNS = ["event_id", "user_id", "event_type", "value"]


def _typed_events(df):
    return df.select(
        F.col("event_id").try_cast("long").alias("event_id"),
        F.col("user_id").try_cast("long").alias("user_id"),
        "event_type",
        F.col("value").try_cast("double").alias("value"),
    )


@query("s1_read_delimited", PLAIN_EVENTS)
def s1(spark, sf):
    path = scratch_dir(spark, "s1")
    delimited.write_csv(table(spark, sf, "events").select(*EVENT_COLUMNS), path, sep=";")
    return _typed_events(delimited.read_delimited(spark, path, ";", columns=EVENT_COLUMNS))


@query("s2_decimal_comma_scan", PLAIN_EVENTS)
def s2(spark, sf):
    path = scratch_dir(spark, "s2")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", F.translate(F.col("value").cast("string"), ".", ",").alias("value"))
    delimited.write_csv(events, path, sep=";")
    return _typed_events(delimited.read_decimal_comma(spark, path, ["value"], expected=EVENT_COLUMNS))


CUSTOMERS_WITH_GAPS = "SELECT c_custkey, c_name, CASE WHEN c_custkey % 10 <> 0 THEN c_acctbal END AS c_acctbal FROM customer"


def _customers_with_gaps(spark, sf):
    balance = F.when(F.col("c_custkey") % 10 != 0, F.col("c_acctbal")).alias("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", "c_name", balance)


@query("s3_typed_csv_scan", CUSTOMERS_WITH_GAPS)
def s3(spark, sf):
    path = scratch_dir(spark, "s3")
    delimited.write_csv(_customers_with_gaps(spark, sf), path)
    return delimited.read_csv(spark, path, "c_custkey long, c_name string, c_acctbal double")


@query("s4_scan_without_unnamed_columns", "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name FROM customer")
def s4(spark, sf):
    path = scratch_dir(spark, "s4")
    nothing = F.lit(None).cast("string")
    padded = table(spark, sf, "customer").select("c_custkey", "c_name", nothing.alias("_c2"), nothing.alias("_c3"))
    delimited.write_csv(padded, path, sep=";")
    return delimited.read_named_columns(spark, path, ";", expected=["c_custkey"])


@query("s5_json_array_lines", "SELECT event_id, user_id, event_type, value FROM events")
def s5(spark, sf):
    path = scratch_dir(spark, "s5")
    block = F.floor(F.col("event_id") / 100)
    arrays = (
        table(spark, sf, "events")
        .groupBy(block.alias("block"))
        .agg(F.to_json(F.collect_list(F.struct(*EVENT_COLUMNS))).alias("line"))
    )
    text.write_text(arrays.select("line"), path)
    return records.read_json_lines(spark, path, "event_id long, user_id long, event_type string, value double")


#: Orders in an array: a task writes a file, so files stay of one size and their number grows.
ARRAY_ROWS = 500_000


@query("s5_json_array_file", "SELECT o_orderkey, o_totalprice, o_orderpriority, o_orderpriority || ' }, {[\"' || o_orderkey AS odd FROM orders")
def s5_file(spark, sf):
    """All orders as arrays over many lines, a file for each ``ARRAY_ROWS`` of them or fewer, read in blocks."""
    path = scratch_dir(spark, "s5")
    odd = F.concat("o_orderpriority", F.lit(' }, {["'), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", odd.alias("odd"))
    files = -(-orders.count() // ARRAY_ROWS)
    array = F.pmod(F.xxhash64("o_orderkey"), F.lit(max(files, 1)))
    dealt = orders.withColumn("array", array)
    ends = dealt.groupBy("array").agg(F.min("o_orderkey").alias("first"), F.max("o_orderkey").alias("last"))
    key, record = F.col("o_orderkey"), F.to_json(F.struct(*orders.columns), {"pretty": "true"})
    line = F.concat(F.when(key == F.col("first"), "[").otherwise(""), record, F.when(key == F.col("last"), "]").otherwise(","))
    lines = dealt.join(F.broadcast(ends), "array").repartition(max(files, 1), "array").sortWithinPartitions("array", "o_orderkey")
    lines.select("array", line.alias("line")).write.partitionBy("array").text(path)
    return read_json_array_blocks(spark, path, "o_orderkey long, o_totalprice double, o_orderpriority string, odd string")


@query("s5_json_column", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def s5_column(spark, sf):
    parsed = records.parse_json(F.col("props"), "k long")
    return table(spark, sf, "events").select("event_id", parsed["k"].alias("k"))


@query(
    "s6_xml_records",
    "SELECT c_custkey, c_name, CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer",
)
def s6(spark, sf):
    path = scratch_dir(spark, "s6")
    segment = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).otherwise("").alias("c_mktsegment")
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", segment)
    customers.write.format("xml").option("rowTag", "customer").option("rootTag", "customers").save(path)
    return records.read_xml(spark, path, "customer", "c_custkey long, c_name string, c_mktsegment string")


@query(
    "s7_html_blocks",
    """SELECT page_id, CAST(i - 1 AS INTEGER) AS position,
              regexp_extract(b, 'href="([^"]*)"', 1) AS href, regexp_extract(b, '>([^<]*)</a>', 1) AS label
       FROM (SELECT page_id, unnest(m) AS b, generate_subscripts(m, 1) AS i
             FROM (SELECT page_id, regexp_extract_all(html, '<li>(<a href="[^"]*">[^<]*</a>)</li>', 1) AS m FROM pages))""",
)
def s7(spark, sf):
    pages = table(spark, sf, "pages")
    return markup.repeated_blocks(
        pages, F.col("html"), r'<li>(<a href="[^"]*">[^<]*</a>)</li>', ["page_id"],
        {"href": r'href="([^"]*)"', "label": r">([^<]*)</a>"},
    )


@query(
    "s7_html_tables",
    """SELECT c_custkey, 1 AS position, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer
       UNION ALL SELECT c_custkey, 2, c_mktsegment, '' FROM customer""",
)
def s7_tables(spark, sf):
    page = F.concat(
        F.lit("<html><body><table class='x'><tr><th>Name</th><th>Nation</th></tr><tr><td>"), F.col("c_name"),
        F.lit("</td><td>"), F.col("c_nationkey").cast("string"), F.lit("</td></tr>\n<tr><td><b>"), F.col("c_mktsegment"),
        F.lit("</b></td><td></td></tr></table><table><tr><td>other</td></tr></table></body></html>"),
    )
    pages = table(spark, sf, "customer").select("c_custkey", page.alias("html"))
    return markup.table_rows(pages, "html", ["name", "nation"], ["c_custkey"])


@query(
    "s7_nested_tables",
    """SELECT c_custkey, 1 AS position, c_name || ' ' || c_nationkey || ' inner' AS name, c_mktsegment || ' > x' AS segment FROM customer
       UNION ALL SELECT c_custkey, 2, 'open ' || c_custkey, '' FROM customer""",
)
def s7_nested(spark, sf):
    """A table in a cell, a sign in an attribute, rows and cells that are never closed. Keys and names take few
    bytes and their pages much work, so rows are dealt out before pages are made of them."""
    text = lambda c: F.col(c).cast("string")
    page = F.concat(
        F.lit("<body><!-- <table><tr><td>no</td></tr></table> --><TABLE title='a > b'><tr><th>Name<th>Segment<tr class=\"x>y\"><td>"), text("c_name"),
        F.lit("<table><tr><td>"), text("c_nationkey"), F.lit("</td><td> inner</td></tr></table></td>\n<td data-x='</td>'>"), text("c_mktsegment"),
        F.lit(" &gt; x</td></tr><tr><td>open "), text("c_custkey"), F.lit("<td></table><table><tr><td>h</td></tr><tr><td>other</td></tr></table>"),
    )
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment").repartition("c_custkey")
    return markup.nested_table_rows(customers.select("c_custkey", page.alias("html")), "html", ["name", "segment"], ["c_custkey"])


@query("s8_text_extension_scan", CUSTOMERS_WITH_GAPS)
def s8(spark, sf):
    path = scratch_dir(spark, "s8")
    _customers_with_gaps(spark, sf).write.option("header", True).option("extension", "txt").csv(path)
    return delimited.read_csv(spark, f"{path}/*.txt", "c_custkey long, c_name string, c_acctbal double")


BLOCKS_SQL = "SELECT doc_id // 100 AS block, string_agg(text, chr(10) ORDER BY doc_id) || chr(10) AS t FROM documents GROUP BY 1"


def document_files(spark, sf, label):
    """One text file for each hundred keys of documents, texts in key order; returns the folder."""
    path = scratch_dir(spark, label)
    docs = table(spark, sf, "documents").groupBy(F.floor(F.col("doc_id") / 100).alias("block"))
    texts = F.transform(F.array_sort(F.collect_list(F.struct("doc_id", "text"))), lambda d: d["text"])
    docs.agg(F.array_join(texts, "\n").alias("text")).write.partitionBy("block").text(path)
    return path


@query("s9_whole_text", f"SELECT CAST(length(t) AS INTEGER) AS chars, CAST(len(string_split(t, chr(10))) AS INTEGER) AS lines, md5(t) AS digest FROM ({BLOCKS_SQL})")
def s9(spark, sf):
    body = F.col("text")
    files = text.read_whole_text(spark, document_files(spark, sf, "s9"))
    return files.select(F.length(body).alias("chars"), F.size(F.split(body, "\n", -1)).alias("lines"), F.md5(body).alias("digest"))


@query("s10_fixed_width_scan", "SELECT event_id AS value, count(*) AS n FROM events GROUP BY event_id")
def s10(spark, sf):
    path = scratch_dir(spark, "s10")
    fixed_width.write_uint32(table(spark, sf, "events"), "event_id", path)
    return fixed_width.read_uint32(spark, path).groupBy("value").agg(F.count(F.lit(1)).alias("n"))


@query("s11_bytes_to_text", f"SELECT block, md5(t) AS digest FROM ({BLOCKS_SQL})")
def s11(spark, sf):
    files = text.read_bytes_as_text(spark, document_files(spark, sf, "s11"))
    return files.select(F.regexp_extract("path", r"block=(\d+)", 1).cast("long").alias("block"), F.md5("text").alias("digest"))


@query("s18_file_listing", f"SELECT count(*) AS files, CAST(sum(strlen(t)) AS BIGINT) AS bytes FROM ({BLOCKS_SQL})")
def s18(spark, sf):
    found = text.list_files(spark, document_files(spark, sf, "s18"), "part-*")
    return found.agg(F.count("name").alias("files"), F.sum("length").alias("bytes"))


@query(
    "s12_parquet_scan",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_discount >= 0.05 AND l_returnflag = 'R'",
)
def s12(spark, sf):
    lines = records.read_parquet(spark, f"{sf}/lineitem.parquet")
    wanted = (F.col("l_discount") >= 0.05) & (F.col("l_returnflag") == "R")
    return lines.filter(wanted).select("l_orderkey", "l_linenumber", "l_quantity")


@query("s13_table_scan", "SELECT * FROM customer")
def s13(spark, sf):
    table(spark, sf, "customer").createOrReplaceTempView("gaugeflow_customer")
    return records.read_table(spark, "gaugeflow_customer")


@query(
    "s14_documents_scan",
    "SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment END AS segment FROM customer",
)
def s14(spark, sf):
    path = scratch_dir(spark, "s14")
    segment = F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")).alias("segment")
    records.write_json(table(spark, sf, "customer").select("c_custkey", "c_name", segment), path)
    fields = {"c_custkey": "long", "c_name": "string", "segment": "string"}
    docs = records.read_documents(spark, path)
    return docs.select(*[F.try_variant_get("doc", f"$.{n}", t).alias(n) for n, t in fields.items()])


READINGS_SQL = """SELECT user_id AS location, event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS time,
    CASE WHEN event_type = 'click' THEN value END AS pm10, CASE WHEN event_type = 'view' THEN value END AS pm2_5,
    CASE WHEN event_type = 'error' THEN value * 20 END AS carbon_monoxide FROM events"""


def landed_readings(spark, sf):
    """Write events as nested reading files and return the folder."""
    path = scratch_dir(spark, "landed")
    kind, value = F.col("event_type"), F.col("value")
    current = F.struct(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("time"),
        F.when(kind == "click", value).alias("pm10"),
        F.when(kind == "view", value).alias("pm2_5"),
        F.when(kind == "error", value * 20).alias("carbon_monoxide"),
        F.when(kind == "signup", value).alias("nitrogen_dioxide"),
        F.when(kind == "purchase", value).alias("european_aqi"),
    )
    records.write_json(table(spark, sf, "events").select(F.col("user_id").alias("location"), "event_id", current.alias("current")), path)
    return path


@query("s15_stream_readings", READINGS_SQL)
def s15(spark, sf):
    source = readings.stream_readings(spark, landed_readings(spark, sf), "location long, event_id long")
    out = scratch_dir(spark, "s15")
    columns = ["location", "event_id", "time", "pm10", "pm2_5", "carbon_monoxide"]
    score_stream(source, lambda df: df.select(*columns), f"{out}/table", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/table")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


@query("k1_parquet_sink", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def k1(spark, sf):
    path = scratch_dir(spark, "k1")
    records.write_parquet(table(spark, sf, "orders"), path)
    return records.read_parquet(spark, path).select(*ORDER_COLUMNS)


@query("k2_csv_sink", f"SELECT {', '.join(ORDER_COLUMNS)} FROM orders")
def k2(spark, sf):
    path = scratch_dir(spark, "k2")
    orders = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    delimited.write_csv(orders, path)
    return delimited.read_csv(spark, path, orders.schema)


@query("k3_fixed_width_sink", "SELECT l_linenumber AS value, count(*) AS n FROM lineitem GROUP BY l_linenumber")
def k3(spark, sf):
    path = scratch_dir(spark, "k3")
    fixed_width.write_uint32(table(spark, sf, "lineitem"), "l_linenumber", path)
    return fixed_width.read_uint32(spark, path).groupBy(F.col("value").cast("int").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query("k4_text_sink", "SELECT md5(replace(replace(text, chr(10), ' '), chr(13), ' ')) AS digest, count(*) AS n FROM documents GROUP BY ALL")
def k4(spark, sf):
    path = scratch_dir(spark, "k4")
    text.write_text(table(spark, sf, "documents").select(F.translate("text", "\n\r", "  ").alias("text")), path)
    return spark.read.text(path).groupBy(F.md5("value").alias("digest")).agg(F.count(F.lit(1)).alias("n"))


@query("k8_preview", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def k8(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority")
    return schema.preview(orders, [F.col("o_totalprice").desc(), "o_orderkey"], 20)


@query(
    "x7_bytes_and_integers",
    """SELECT event_id, upper(printf('%02x%02x%02x%02x', event_id & 255, (event_id >> 8) & 255,
       (event_id >> 16) & 255, (event_id >> 24) & 255)) AS packed, event_id AS unpacked FROM events""",
)
def x7(spark, sf):
    packed = byte_columns.uint32_to_bytes(F.col("event_id"))
    rows = table(spark, sf, "events").select("event_id", packed.alias("raw"))
    return rows.select("event_id", F.hex("raw").alias("packed"), byte_columns.bytes_to_uint32(F.col("raw")).alias("unpacked"))
