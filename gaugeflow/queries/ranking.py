"""Ordering, ranking, first and latest rows."""

from __future__ import annotations

from ..operators import ranking, tokens
from .registry import query, rounded, table


@query(
    "w1_rank_groups",
    "SELECT event_type, round(avg(value), 6) AS mean_value, CAST(row_number() OVER (ORDER BY avg(value), event_type) - 1 AS INTEGER) AS rank FROM events GROUP BY event_type",
)
def w1(spark, sf):
    return rounded(ranking.rank_groups(table(spark, sf, "events"), "event_type", "value"), "mean_value")


@query(
    "w2_argsort_descending",
    """SELECT vec_id, CAST(row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) - 1 AS INTEGER) AS place, CAST(i - 1 AS INTEGER) AS position
       FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)""",
)
def w2(spark, sf):
    return ranking.argsort_descending(table(spark, sf, "embeddings"), "embedding", ["vec_id"]).drop("value")


@query("w3_sort_ascending", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey")
def w3(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy("o_totalprice", "o_orderkey")


@query(
    "w4_top_tokens",
    "SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS token FROM documents) WHERE token <> '' GROUP BY token ORDER BY n DESC, token LIMIT 25",
)
def w4(spark, sf):
    return tokens.top_tokens(table(spark, sf, "documents"), "text", 25)


@query(
    "w5_first_match",
    "SELECT c_mktsegment, c_custkey, c_acctbal FROM customer QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal, c_custkey) = 1",
)
def w5(spark, sf):
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return ranking.first_per(customers, ["c_mktsegment"], ["c_acctbal", "c_custkey"])


LATEST_SQL = "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"


@query("w6_latest_per_location", LATEST_SQL)
def w6(spark, sf):
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return ranking.latest_per(events, ["user_id"], ["ts", "event_id"]).drop("ts")
