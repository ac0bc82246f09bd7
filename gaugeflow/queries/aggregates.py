"""Aggregations and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions import clock
from ..operators import quality, stats, tokens
from ..operators.quantile import exact_median
from .quality import with_sentinel
from .registry import CHANNELS, WEEKLY, query, rounded, table, weekly


@query("a1_row_count", "SELECT count(*) AS n FROM lineitem")
def a1(spark, sf):
    return stats.row_count(table(spark, sf, "lineitem"))


@query("a2_summary", "SELECT round(avg(value), 6) AS mean_value, max(value) AS max_value, min(value) AS min_value FROM events")
def a2(spark, sf):
    return rounded(stats.summary(table(spark, sf, "events"), "value"), "mean_value")


@query(
    "a3_array_column_summary",
    """SELECT CAST(i - 1 AS INTEGER) AS position, round(sum(x), 6) AS total, round(avg(x), 6) AS mean_value, round(max(x), 6) AS max_value, round(min(x), 6) AS min_value
       FROM (SELECT unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY i""",
)
def a3(spark, sf):
    summed = stats.array_column_summary(table(spark, sf, "embeddings"), "embedding")
    return rounded(summed, "total", "mean_value", "max_value", "min_value")


@query("a4_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def a4(spark, sf):
    return stats.value_counts(table(spark, sf, "events"), "event_type")


A5 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a5_group_means", f"SELECT l_returnflag, l_linestatus, count(*) AS n, {', '.join(f'round(avg({c}), 4) AS mean_{c}' for c in A5)} FROM lineitem GROUP BY l_returnflag, l_linestatus")
def a5(spark, sf):
    means = stats.group_means(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], A5)
    return rounded(means, *[f"mean_{c}" for c in A5], digits=4)


@query("a6_exact_median", "SELECT median(o_totalprice) AS median_value, count(o_totalprice) AS n FROM orders")
def a6(spark, sf):
    orders = table(spark, sf, "orders")
    return orders.agg(F.lit(exact_median(orders, "o_totalprice")).alias("median_value"), F.count("o_totalprice").alias("n"))


A7 = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a7_correlation_matrix", " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM lineitem" for a in A7 for b in A7))
def a7(spark, sf):
    return rounded(stats.correlation_matrix(table(spark, sf, "lineitem"), A7), "correlation")


@query(
    "a7_correlation_pairwise_complete",
    f"WITH {WEEKLY} " + " UNION ALL ".join(f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM weekly" for a in CHANNELS for b in CHANNELS),
)
def a7_pairwise(spark, sf):
    return rounded(stats.correlation_matrix(weekly(spark, sf), CHANNELS), "correlation")


BOX = "box AS (SELECT min(value) AS lo, max(value) AS hi FROM events)"


@query(
    "a8_histogram",
    f"""WITH {BOX} SELECT CAST(bin AS INTEGER) AS bin, round(lo + bin * (hi - lo) / 30, 6) AS low_edge, round(lo + (bin + 1) * (hi - lo) / 30, 6) AS high_edge, n
        FROM (SELECT least(floor(30.0 * (value - lo) / (hi - lo)), 29) AS bin, count(*) AS n FROM events, box GROUP BY 1), box""",
)
def a8(spark, sf):
    return rounded(stats.histogram(table(spark, sf, "events"), "value", 30), "low_edge", "high_edge")


@query(
    "a8_density",
    """WITH s AS (SELECT min(value) AS lo, max(value) AS hi, stddev_samp(value) * pow(count(*), -0.2) AS h, count(*) AS n FROM events),
       v AS (SELECT value AS v, count(*) AS w FROM events GROUP BY value)
       SELECT CAST(i AS INTEGER) AS position, round(lo + i * (hi - lo) / 199, 6) AS x,
              round(sum(w * exp(-0.5 * pow((lo + i * (hi - lo) / 199 - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())), 8) AS density
       FROM range(200) t(i), s, v GROUP BY i, lo, hi""",
)
def a8_density(spark, sf):
    curve = stats.density(table(spark, sf, "events"), "value", 200)
    return rounded(rounded(curve, "x"), "density", digits=8)


@query(
    "a9_scatter_bins",
    """WITH b AS (SELECT min(l_quantity) AS xl, max(l_quantity) AS xh, min(l_extendedprice) AS yl, max(l_extendedprice) AS yh FROM lineitem)
       SELECT CAST(least(floor(20.0 * (l_quantity - xl) / (xh - xl)), 19) AS INTEGER) AS bin_x,
              CAST(least(floor(20.0 * (l_extendedprice - yl) / (yh - yl)), 19) AS INTEGER) AS bin_y, count(*) AS n
       FROM lineitem, b GROUP BY 1, 2""",
)
def a9(spark, sf):
    return stats.scatter_bins(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20)


@query("a10_confusion_matrix", "SELECT quality AS label, toxic AS prediction, count(*) AS n FROM labels GROUP BY quality, toxic")
def a10(spark, sf):
    return stats.confusion(table(spark, sf, "labels"), "quality", "toxic")


REPORT_SQL = """
WITH cls AS (SELECT DISTINCT c FROM (SELECT quality AS c FROM labels UNION ALL SELECT toxic FROM labels)),
 per AS (SELECT c, count(*) FILTER (WHERE quality = c AND toxic = c) AS tp, count(*) FILTER (WHERE quality = c) AS actual,
                count(*) FILTER (WHERE toxic = c) AS named FROM cls, labels GROUP BY c),
 pr AS (SELECT c, actual, CASE WHEN named = 0 THEN 0 ELSE tp / named END AS p, CASE WHEN actual = 0 THEN 0 ELSE tp / actual END AS r FROM per),
 sc AS (SELECT *, CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END AS f FROM pr)
SELECT CAST(c AS VARCHAR) AS class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(actual AS BIGINT) AS support FROM sc
UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(actual) AS BIGINT) FROM sc
UNION ALL SELECT 'weighted avg', round(sum(p * actual) / sum(actual), 6), round(sum(r * actual) / sum(actual), 6), round(sum(f * actual) / sum(actual), 6), CAST(sum(actual) AS BIGINT) FROM sc"""


@query("a11_class_report", REPORT_SQL)
def a11(spark, sf):
    return rounded(stats.class_report(table(spark, sf, "labels"), "quality", "toxic"), "precision", "recall", "f1")


@query("a12_accuracy", "SELECT round(avg(CAST(quality = toxic AS DOUBLE)), 6) AS accuracy FROM labels")
def a12(spark, sf):
    return rounded(stats.accuracy(table(spark, sf, "labels"), "quality", "toxic"), "accuracy")


PREDICTION = "l_quantity * 1500 + 100"


def predicted_prices(spark, sf):
    return table(spark, sf, "lineitem").select("l_extendedprice", F.expr(PREDICTION).alias("prediction"))


METRICS_SQL = f"""SELECT count(*) AS n, round(avg(e * e), 2) AS mse, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(abs(e)), 4) AS mae,
    round(1 - avg(e * e) / var_pop(y), 6) AS r2 FROM (SELECT l_extendedprice AS y, l_extendedprice - ({PREDICTION}) AS e FROM lineitem)"""


@query("a13_regression_metrics", METRICS_SQL)
def a13(spark, sf):
    found = stats.regression_metrics(predicted_prices(spark, sf), "l_extendedprice", "prediction")
    return rounded(rounded(rounded(found, "rmse", "mae", digits=4), "mse", digits=2), "r2")


@query("a14_mse_and_r2", f"SELECT mse, r2 FROM ({METRICS_SQL})")
def a14(spark, sf):
    return a13(spark, sf).select("mse", "r2")


@query("a16_token_frequency", "SELECT token, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS token FROM documents) WHERE token <> '' GROUP BY token")
def a16(spark, sf):
    return tokens.token_frequency(table(spark, sf, "documents"), "text")


@query(
    "a17_token_association",
    """WITH t AS (SELECT lang AS category, unnest(regexp_split_to_array(lower(text), '[^\\p{L}]+')) AS token FROM documents),
       c AS (SELECT token, category, count(*) AS n FROM t WHERE token <> '' GROUP BY token, category),
       l AS (SELECT token, category, n, n * CAST(sum(n) OVER () AS DOUBLE) / (CAST(sum(n) OVER (PARTITION BY token) AS DOUBLE) * sum(n) OVER (PARTITION BY category)) AS lift FROM c)
       SELECT token, category, n, round(lift, 6) AS lift, round(log2(lift), 6) AS pmi FROM l""",
)
def a17(spark, sf):
    return rounded(tokens.token_association(table(spark, sf, "documents"), "text", "lang"), "lift", "pmi")


BY_HOUR_SQL = """WITH marked AS (SELECT hour(ts) AS hour, CASE WHEN event_id % 10 <> 0 THEN value END AS v FROM events),
 filled AS (SELECT hour, coalesce(v, (SELECT avg(v) FROM marked)) AS v, v IS NULL AS gap FROM marked)
SELECT CAST(hour AS INTEGER) AS hour, CAST(hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19 AS INTEGER) AS is_rush,
       count(*) AS n, CAST(count_if(gap) AS BIGINT) AS imputed, round(avg(v), 6) AS mean_value, round(max(v), 9) AS max_value FROM filled GROUP BY hour"""


@query("a18_mean_by_hour", BY_HOUR_SQL)
def by_hour(spark, sf):
    """Do rush hours differ? Sentinel to null, mean imputation, hour, rush flag, mean by hour."""
    marked = quality.null_out_sentinel(with_sentinel(spark, sf), ["value"], presets.SENTINEL)
    marked = marked.select(F.hour("ts").alias("hour"), "value", F.col("value").isNull().alias("gap"))
    filled = quality.impute_mean(marked, ["value"])
    flagged = filled.withColumn("is_rush", clock.rush_flag(F.col("hour"), presets.RUSH_PIPELINE))
    summed = flagged.groupBy("hour", "is_rush").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("gap").alias("imputed"),
        F.avg("value").alias("mean_value"),
        F.max("value").alias("max_value"),
    )
    return rounded(rounded(summed, "mean_value"), "max_value", digits=9)


@query(
    "a18_mean_by_rush_flag",
    f"WITH {WEEKLY} SELECT CAST(hour(first_ts) BETWEEN 8 AND 10 OR hour(first_ts) BETWEEN 17 AND 19 AS INTEGER) AS is_rush, count(*) AS n, {', '.join(f'round(avg({c}), 6) AS mean_{c}' for c in CHANNELS)} FROM weekly GROUP BY 1",
)
def by_flag(spark, sf):
    flag = clock.rush_flag(F.hour("first_ts"), presets.RUSH_SERVICE).alias("is_rush")
    return rounded(stats.group_means(weekly(spark, sf), [flag], CHANNELS), *[f"mean_{c}" for c in CHANNELS])
