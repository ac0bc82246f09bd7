"""Projection, schema, filter and change operators."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock, numbers
from ..operators import changes, filters, quality, schema, snapshots
from ..operators.schema import select_columns
from ..session import scratch_dir
from .registry import CHANNELS, DAILY, WEEKLY, daily, query, rounded, rounded_sql, table, weekly

LINE_KEY = ["l_orderkey", "l_linenumber"]


@query("p1_rename", "SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_quantity AS quantity FROM lineitem")
def p1(spark, sf):
    names = {"l_orderkey": "order_key", "l_linenumber": "line_no", "l_quantity": "quantity", "absent": "nowhere"}
    return schema.rename_columns(table(spark, sf, "lineitem"), names).select("order_key", "line_no", "quantity")


@query("p2_drop_unnamed", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def p2(spark, sf):
    padded = table(spark, sf, "supplier").withColumns({"_c4": F.lit(None).cast("string"), " ": F.lit(1)})
    return schema.drop_unnamed(padded)


@query("p3_drop_all_null_columns", f"WITH {WEEKLY} SELECT reading_id, {rounded_sql(CHANNELS, 8)} FROM weekly")
def p3(spark, sf):
    wide = weekly(spark, sf).select("reading_id", *CHANNELS).withColumn("nothing", F.lit(None).cast("double"))
    return rounded(schema.drop_all_null_columns(wide), *CHANNELS, digits=8)


@query("p4_drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def p4(spark, sf):
    return schema.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "absent"])


@query("p5_select", "SELECT o_orderkey, o_totalprice FROM orders")
def p5(spark, sf):
    return select_columns(table(spark, sf, "orders"), ["o_orderkey", "o_totalprice"])


def _info_sql(source, columns):
    return " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null FROM {source}"
        for i, (c, t) in enumerate(columns)
    )


@query(
    "p6_feature_columns",
    _info_sql("lineitem", [("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"), ("l_quantity", "double"), ("l_discount", "double"), ("l_tax", "double")]),
)
def p6(spark, sf):
    lines = table(spark, sf, "lineitem")
    return schema.dataset_info(lines.select(*schema.feature_columns(lines, {"l_extendedprice", "l_orderkey"})))


@query(
    "p7_numeric_columns",
    _info_sql("part", [("p_partkey", "bigint"), ("p_size", "int"), ("p_retailprice", "double")]),
)
def p7(spark, sf):
    parts = table(spark, sf, "part")
    return schema.dataset_info(parts.select(*schema.columns_of_type(parts, (T.NumericType,))))


@query(
    "p8_computed_column",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS revenue, l_tax * 2 AS l_tax FROM lineitem",
)
def p8(spark, sf):
    revenue = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 4)
    out = schema.with_columns(table(spark, sf, "lineitem"), {"revenue": revenue, "l_tax": F.col("l_tax") * 2})
    return out.select(*LINE_KEY, "revenue", "l_tax")


def _imputed_sql(source):
    parts = ", ".join(f"round(coalesce({c}, (SELECT avg({c}) FROM {source})), 8) AS {c}" for c in CHANNELS)
    return f"SELECT reading_id, {parts} FROM {source}"


@query("p9_overwrite_in_place", f"WITH {DAILY} {_imputed_sql('daily')}")
def p9(spark, sf):
    wide = daily(spark, sf).select("reading_id", *CHANNELS)
    return rounded(quality.impute_mean(wide, CHANNELS), *CHANNELS, digits=8)


@query(
    "p10_dataset_info",
    _info_sql("orders", [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"), ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string")]),
)
def p10(spark, sf):
    return schema.dataset_info(table(spark, sf, "orders"))


@query("p11_first_rows", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def p11(spark, sf):
    return schema.preview(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey"], 5)


@query(
    "p12_unit_conversion",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice / 1000.0, 6) AS in_thousands, round(l_quantity * 1.3, 6) AS proxy FROM lineitem",
)
def p12(spark, sf):
    return table(spark, sf, "lineitem").select(
        *LINE_KEY,
        F.round(F.col("l_extendedprice") / 1000.0, 6).alias("in_thousands"),
        F.round(numbers.scaled(F.col("l_quantity"), 1.3), 6).alias("proxy"),
    )


@query("f1_require_target", f"WITH {WEEKLY} SELECT reading_id, round(click, 8) AS click FROM weekly WHERE click IS NOT NULL")
def f1(spark, sf):
    return rounded(filters.require_target(weekly(spark, sf), "click").select("reading_id", "click"), "click", digits=8)


@query(
    "f1_target_counts",
    f"WITH {WEEKLY} SELECT count(*) AS rows_in, count(click) AS rows_kept, count(*) - count(click) AS rows_dropped FROM weekly",
)
def f1_counts(spark, sf):
    return filters.target_counts(weekly(spark, sf), "click")


BLANKS_SQL = f"""WITH {DAILY} SELECT reading_id, {rounded_sql(CHANNELS[:2], 8)} FROM daily WHERE click IS NOT NULL OR view IS NOT NULL"""


@query("f2_drop_blank_rows", BLANKS_SQL)
def f2(spark, sf):
    pair = CHANNELS[:2]
    return rounded(filters.drop_blank_rows(daily(spark, sf).select("reading_id", *pair), pair), *pair, digits=8)


@query("f3_drop_incomplete_rows", f"WITH {WEEKLY} SELECT reading_id, {rounded_sql(CHANNELS, 8)} FROM weekly WHERE {' AND '.join(c + ' IS NOT NULL' for c in CHANNELS)}")
def f3(spark, sf):
    return rounded(filters.drop_incomplete_rows(weekly(spark, sf).select("reading_id", *CHANNELS), CHANNELS), *CHANNELS, digits=8)


@query("f4_comparison", "SELECT event_id, value FROM events WHERE value > 30")
def f4(spark, sf):
    return filters.above(table(spark, sf, "events"), "value", 30).select("event_id", "value")


@query("f5_key_equality", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'")
def f5(spark, sf):
    return filters.equal_to(table(spark, sf, "customer"), "c_mktsegment", "BUILDING").select("c_custkey", "c_name", "c_acctbal")


@query("f6_membership", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE hour(ts) IN (7, 8, 9, 17, 18, 19)")
def f6(spark, sf):
    timed = table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"))
    return filters.member_of(timed, "hour", [7, 8, 9, 17, 18, 19])


@query("f7_hour_ranges", "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour FROM events WHERE hour(ts) BETWEEN 8 AND 10 OR hour(ts) BETWEEN 17 AND 19")
def f7(spark, sf):
    timed = table(spark, sf, "events").select("event_id", F.hour("ts").alias("hour"))
    return timed.filter(clock.in_hour_ranges(F.col("hour"), [(8, 10), (17, 19)]))


@query(
    "f9_columns_with_missing",
    f"WITH {WEEKLY} SELECT * FROM ({' UNION ALL '.join(f'''SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM weekly''' for c in ['reading_id', *CHANNELS])}) WHERE missing > 0",
)
def f9(spark, sf):
    return quality.missing_report(weekly(spark, sf).select("reading_id", *CHANNELS))


CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"


@query(
    "u1_insert",
    f"SELECT {CUSTOMER} FROM customer UNION ALL SELECT s_suppkey + 1000000000, s_name, s_nationkey, s_acctbal, NULL FROM supplier",
)
def u1(spark, sf):
    new = table(spark, sf, "supplier").select(
        (F.col("s_suppkey") + 1000000000).alias("c_custkey"), F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"),
    )
    return changes.insert_rows(table(spark, sf, "customer"), new)


@query(
    "u2_generated_keys",
    f"""SELECT c_custkey, c_name FROM customer UNION ALL
        SELECT (SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey), s_name FROM supplier""",
)
def u2(spark, sf):
    new = table(spark, sf, "supplier").select("s_suppkey", F.col("s_name").alias("c_name"))
    base = table(spark, sf, "customer").select("c_custkey", "c_name")
    return changes.insert_with_keys(base, new, "c_custkey", "s_suppkey").select("c_custkey", "c_name")


@query("u3_update_all", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN c_acctbal + 100 ELSE c_acctbal END AS c_acctbal FROM customer")
def u3(spark, sf):
    is_building = F.col("c_mktsegment") == "BUILDING"
    out = changes.update_all(table(spark, sf, "customer"), is_building, {"c_acctbal": F.col("c_acctbal") + 100})
    return out.select("c_custkey", "c_acctbal")


@query(
    "u4_update_first",
    """SELECT c_custkey, CASE WHEN c_custkey = (SELECT arg_min(c_custkey, c_custkey) FROM customer WHERE c_mktsegment = 'BUILDING')
       THEN 0.0 ELSE c_acctbal END AS c_acctbal FROM customer""",
)
def u4(spark, sf):
    is_building = F.col("c_mktsegment") == "BUILDING"
    out = changes.update_first(table(spark, sf, "customer"), is_building, {"c_acctbal": 0.0}, "c_custkey", ["c_custkey"])
    return out.select("c_custkey", "c_acctbal")


@query("u5_delete_all", f"SELECT {CUSTOMER} FROM customer WHERE NOT coalesce(c_mktsegment = 'BUILDING', false)")
def u5(spark, sf):
    return changes.delete_all(table(spark, sf, "customer"), F.col("c_mktsegment") == "BUILDING")


@query(
    "u6_delete_first",
    f"""SELECT {CUSTOMER} FROM customer WHERE c_custkey <> (
          SELECT c_custkey FROM customer WHERE c_mktsegment = 'MACHINERY' ORDER BY c_acctbal, c_custkey LIMIT 1)""",
)
def u6(spark, sf):
    return changes.delete_first(table(spark, sf, "customer"), F.col("c_mktsegment") == "MACHINERY", "c_custkey", ["c_acctbal"])


# Changes derived from orders: the order key is the sequence, its status picks the operation.
CHANGES_SQL = """
WITH ch AS (SELECT o_custkey AS k, o_orderkey AS seq,
                   CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'delete' ELSE 'insert' END AS op,
                   CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS bal, o_orderpriority AS seg FROM orders),
 reset AS (SELECT k, max(seq) AS at, arg_max(op, seq) AS op FROM ch WHERE op <> 'update' GROUP BY k),
 live AS (SELECT c.c_custkey AS k, c.c_acctbal AS bal, c.c_mktsegment AS seg, -1 AS since FROM customer c
          WHERE c.c_custkey NOT IN (SELECT k FROM reset)
          UNION ALL SELECT ch.k, ch.bal, ch.seg, ch.seq FROM ch JOIN reset r ON ch.k = r.k AND ch.seq = r.at WHERE r.op = 'insert'),
 upd AS (SELECT l.k, arg_max(ch.bal, ch.seq) FILTER (WHERE ch.bal IS NOT NULL) AS bal,
                arg_max(ch.seg, ch.seq) FILTER (WHERE ch.seg IS NOT NULL) AS seg
         FROM live l JOIN ch ON ch.k = l.k AND ch.op = 'update' AND ch.seq > l.since GROUP BY l.k)
SELECT l.k AS c_custkey, coalesce(u.bal, l.bal) AS c_acctbal, coalesce(u.seg, l.seg) AS c_mktsegment
FROM live l LEFT JOIN upd u ON u.k = l.k"""


def _order_changes(spark, sf):
    status = F.col("o_orderstatus")
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("seq"),
        F.when(status == "F", "update").when(status == "O", "delete").otherwise("insert").alias("op"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice")).alias("c_acctbal"),
        F.col("o_orderpriority").alias("c_mktsegment"),
    )


@query("u7_apply_changes", CHANGES_SQL)
def u7(spark, sf):
    base = table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    return changes.apply_changes(base, _order_changes(spark, sf), "c_custkey")


def _batch_sql(n, base, changes):
    """Table ``s<n>``: the rows of ``base`` after the changes of the orders that ``changes`` names."""
    return f"""
 ch{n} AS (SELECT o_custkey AS k, o_orderkey AS seq,
                  CASE o_orderstatus WHEN 'F' THEN 'update' WHEN 'O' THEN 'delete' ELSE 'insert' END AS op,
                  CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS bal, o_orderpriority AS seg FROM orders WHERE {changes}),
 reset{n} AS (SELECT k, max(seq) AS at, arg_max(op, seq) AS op FROM ch{n} WHERE op <> 'update' GROUP BY k),
 live{n} AS (SELECT k, bal, seg, -1 AS since FROM {base} WHERE k NOT IN (SELECT k FROM reset{n})
             UNION ALL SELECT c.k, c.bal, c.seg, c.seq FROM ch{n} c JOIN reset{n} r ON c.k = r.k AND c.seq = r.at WHERE r.op = 'insert'),
 upd{n} AS (SELECT l.k, arg_max(c.bal, c.seq) FILTER (WHERE c.bal IS NOT NULL) AS bal, arg_max(c.seg, c.seq) FILTER (WHERE c.seg IS NOT NULL) AS seg
            FROM live{n} l JOIN ch{n} c ON c.k = l.k AND c.op = 'update' AND c.seq > l.since GROUP BY l.k),
 s{n} AS (SELECT l.k, coalesce(u.bal, l.bal) AS bal, coalesce(u.seg, l.seg) AS seg FROM live{n} l LEFT JOIN upd{n} u ON u.k = l.k)"""


@query(
    "u7_commit_changes",
    f"""WITH s0 AS (SELECT c_custkey AS k, c_acctbal AS bal, c_mktsegment AS seg FROM customer),
        {_batch_sql(1, 's0', 'o_custkey % 7 < 5')}, {_batch_sql(2, 's1', 'o_custkey % 7 >= 5 OR o_orderkey % 5 = 0')}
        SELECT CAST(0 AS INTEGER) AS snapshot, k AS c_custkey, bal AS c_acctbal, seg AS c_mktsegment FROM s0
        UNION ALL SELECT 1, k, bal, seg FROM s1 UNION ALL SELECT 2, k, bal, seg FROM s2""",
)
def u7_commits(spark, sf):
    """Two batches committed to a table; each snapshot still reads as it was."""
    path, customer, key = scratch_dir(spark, "u7"), F.col("c_custkey"), F.col("seq")
    batch = _order_changes(spark, sf)
    snapshots.create_table(table(spark, sf, "customer").select("c_custkey", "c_acctbal", "c_mktsegment"), path, "c_custkey")
    for rows in (batch.where(customer % 7 < 5), batch.where((customer % 7 >= 5) | (key % 5 == 0))):
        snapshots.commit_changes(spark, path, rows)
    read = [snapshots.read_table(spark, path, n).withColumn("snapshot", F.lit(n)) for n in range(3)]
    return read[0].unionByName(read[1]).unionByName(read[2])
