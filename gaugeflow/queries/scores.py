"""Scoring of readings."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..functions.numbers import display_value, round_half_even
from ..operators import quality, scoring
from .registry import WEEKLY, query, table, weekly
from .scalars import HUMIDITY_SQL

# Channels of the wide table stand in for pollutants.
POLLUTANTS = {"pm25": "click", "pm10": "view", "no2": "signup", "o3": "purchase", "co": "error"}

SCORE_PARTS = "0.4 * least(coalesce(click, 0) / 75, 1) + 0.2 * least(coalesce(view, 0) / 150, 1) + 0.2 * least(coalesce(signup, 0) / 200, 1) + 0.1 * least(coalesce(purchase, 0) / 240, 1) + 0.1 * least(coalesce(error, 0) * 50 / 4000, 1)"
SCORED = f"{WEEKLY}, scored AS (SELECT *, ({SCORE_PARTS}) * 100 AS score FROM weekly)"
LABEL_SQL = "CASE WHEN score < 20 THEN 'Good' WHEN score < 40 THEN 'Moderate' WHEN score < 60 THEN 'Unhealthy' WHEN score < 80 THEN 'Very Unhealthy' ELSE 'Hazardous' END"


def _filled(spark, sf):
    defaults = {c: 0.0 for c in POLLUTANTS.values()}
    return quality.fill_defaults(weekly(spark, sf), defaults).withColumn("error", F.col("error") * 50)


def _score():
    return scoring.health_score({p: F.col(c) for p, c in POLLUTANTS.items()})


@query("h1_health_score", f"WITH {SCORED} SELECT reading_id, round(score, 6) AS score, CAST(printf('%.1f', score) AS DOUBLE) AS shown FROM scored")
def h1(spark, sf):
    return _filled(spark, sf).select("reading_id", F.round(_score(), 6).alias("score"), round_half_even(_score(), 1).alias("shown"))


@query("h2_health_label", f"WITH {SCORED} SELECT reading_id, {LABEL_SQL} AS label FROM scored")
def h2(spark, sf):
    return _filled(spark, sf).select("reading_id", scoring.health_label(_score()).alias("label"))


COEFFICIENTS = {"nmhc": 0.01, "nox": 0.02, "no2": -0.03, "temperature": 0.1, "humidity": -0.2, "absolute_humidity": 0.3}


@query(
    "h4_benzene_estimate",
    f"""SELECT l_orderkey, l_linenumber, round(greatest(0, 0.25 + 0.01 * l_extendedprice / 1000 * 0.5 + 0.02 * l_quantity * 1.3 - 0.03 * l_quantity
        + 0.1 * l_discount * 300 - 0.2 * l_tax * 1000 + 0.3 * {HUMIDITY_SQL.format(t='(l_discount * 300)', rh='(l_tax * 1000)')}), 8) AS benzene FROM lineitem""",
)
def h4(spark, sf):
    features = scoring.benzene_features(F.col("l_extendedprice") / 1000, F.col("l_quantity"), F.col("l_discount") * 300, F.col("l_tax") * 1000)
    estimate = scoring.linear_estimate(features, COEFFICIENTS, 0.25)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(estimate, 8).alias("benzene"))


@query("h5_absolute_humidity", f"SELECT l_orderkey, l_linenumber, round({HUMIDITY_SQL.format(t='(l_discount * 300)', rh='(l_tax * 1000)')}, 6) AS humidity FROM lineitem")
def h5(spark, sf):
    value = scoring.absolute_humidity(F.col("l_discount") * 300, F.col("l_tax") * 1000)
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.round(value, 6).alias("humidity"))


RANK = "CAST(event_id % 4 AS INTEGER)"
OVERRIDE_SQL = f"CASE WHEN value >= 150 THEN 3 WHEN value >= 100 THEN 2 WHEN value >= 60 AND {RANK} < 1 THEN 1 ELSE {RANK} END"


@query("h7_rank_override", f"SELECT event_id, {RANK} AS rank, {OVERRIDE_SQL} AS final_rank FROM events")
def h7(spark, sf):
    ranked = table(spark, sf, "events").withColumn("rank", (F.col("event_id") % 4).cast("int"))
    return ranked.select("event_id", "rank", scoring.override_rank(F.col("rank"), F.col("value")).alias("final_rank"))


RUSH_SQL = "(hour(ts) BETWEEN 8 AND 10 OR hour(ts) BETWEEN 17 AND 19)"


@query("h8_rush_state", f"SELECT event_id, {RUSH_SQL} AS is_rush, CASE WHEN {RUSH_SQL} THEN 'Rush Hour' ELSE 'Off-Peak' END AS label FROM events")
def h8(spark, sf):
    state = scoring.rush_state(F.hour("ts")).alias("state")
    return table(spark, sf, "events").select("event_id", state).select("event_id", "state.*")


@query(
    "h9_aqi_category",
    "SELECT event_id, CASE WHEN value <= 20 THEN 'Good' WHEN value <= 40 THEN 'Fair' WHEN value <= 60 THEN 'Moderate' WHEN value <= 80 THEN 'Poor' WHEN value <= 100 THEN 'Very Poor' ELSE 'Extremely Poor' END AS category FROM events",
)
def h9(spark, sf):
    return table(spark, sf, "events").select("event_id", scoring.aqi_category(F.col("value")).alias("category"))


@query(
    "h10_percent_of_threshold",
    """SELECT event_id, event_type, CASE WHEN p IS NULL THEN 'N/A' ELSE printf('%.1f', CASE WHEN (p * 4) % 2 = 1 THEN p + 0.01 ELSE p END) END AS percent FROM
       (SELECT event_id, event_type, CASE WHEN v IS NOT NULL THEN least(100, v / thr * 100) END AS p FROM (SELECT event_id, event_type, CASE WHEN event_id % 10 <> 0 THEN value END AS v,
        CAST(CASE event_type WHEN 'click' THEN 75 WHEN 'view' THEN 150 WHEN 'signup' THEN 200 WHEN 'purchase' THEN 240 ELSE 4000 END AS DOUBLE) AS thr FROM events))""",
)
def h10(spark, sf):
    limits = [(c, presets.POLLUTANT_THRESHOLDS[p]) for p, c in POLLUTANTS.items()]
    dimension = spark.createDataFrame(limits, "pollutant string, threshold double")
    value = F.when(F.col("event_id") % 10 != 0, F.col("value"))
    joined = table(spark, sf, "events").join(dimension, F.col("event_type") == F.col("pollutant"))
    return joined.select("event_id", "event_type", scoring.percent_of_threshold(value, F.col("threshold")).alias("percent"))


@query("h11_display_value", "SELECT event_id, CASE WHEN value < 10 THEN printf('%.2f', value) ELSE CAST(CAST(floor(value + 0.5) AS BIGINT) AS VARCHAR) END AS shown FROM events")
def h11(spark, sf):
    return table(spark, sf, "events").select("event_id", display_value(F.col("value")).alias("shown"))


@query(
    "h12_rule_co_and_benzene",
    """SELECT event_id, CASE WHEN value * 20 > 1000 THEN 'High CO Level' ELSE 'Normal CO' END AS label, value * 20 > 1000 AS high,
       printf('%.2f', CASE WHEN (value * 20 * 0.003 * 8) % 2 = 1 THEN value * 20 * 0.003 + 0.001 ELSE value * 20 * 0.003 END) AS benzene FROM events""",
)
def h12(spark, sf):
    co = F.col("value") * 20
    benzene = scoring.rule_benzene(co).alias("benzene")
    rows = table(spark, sf, "events").select("event_id", scoring.rule_co(co).alias("state"), benzene)
    return rows.select("event_id", "state.*", "benzene")


@query("h13_rule_cluster", "SELECT event_id, CASE WHEN value > 80 THEN 2 WHEN value > 40 THEN 1 ELSE 0 END AS cluster FROM events")
def h13(spark, sf):
    return table(spark, sf, "events").select("event_id", scoring.rule_cluster(F.col("value")).alias("cluster"))


RULE_SCORE = "least(100, CAST(floor(value * 0.8 + 0.5) AS BIGINT))"


@query(
    "h14_rule_health",
    f"SELECT event_id, CAST({RULE_SCORE} AS BIGINT) AS score, CASE WHEN {RULE_SCORE} > 80 THEN 'Hazardous' WHEN {RULE_SCORE} > 50 THEN 'Unhealthy' WHEN {RULE_SCORE} > 20 THEN 'Moderate' ELSE 'Good' END AS label FROM events",
)
def h14(spark, sf):
    score = scoring.rule_health_score(F.col("value"))
    return table(spark, sf, "events").select("event_id", score.alias("score"), scoring.rule_health_label(score).alias("label"))


@query(
    "h15_severity",
    f"SELECT event_id, CASE WHEN {RULE_SCORE} < 20 THEN 'good' WHEN {RULE_SCORE} < 40 THEN 'moderate' WHEN {RULE_SCORE} < 60 THEN 'unhealthy' WHEN {RULE_SCORE} < 80 THEN 'very-unhealthy' ELSE 'hazardous' END AS severity FROM events",
)
def h15(spark, sf):
    score = scoring.rule_health_score(F.col("value"))
    return table(spark, sf, "events").select("event_id", scoring.severity_class(score).alias("severity"))


RECORD_SQL = f"""SELECT event_id, value > 50 AS high, CASE WHEN value > 50 THEN 'HIGH CO Risk' ELSE 'LOW CO Risk' END AS co_label,
  CAST(printf('%.2f', sqrt(value)) AS DOUBLE) AS benzene, {OVERRIDE_SQL} AS cluster_id,
  CASE {OVERRIDE_SQL} WHEN 0 THEN 'Clean' WHEN 1 THEN 'Moderate' WHEN 2 THEN 'High' ELSE 'Severe' END AS cluster_label,
  {RUSH_SQL} AS is_rush, round(score, 6) AS score, {LABEL_SQL} AS risk_label
  FROM (SELECT *, (0.4 * least(value / 75, 1) + 0.1 * least(CAST(20.0 AS DOUBLE) * value / 4000, 1)) * 100 AS score FROM events)"""


def scored_events(events):
    """Full scored record per event; works on a table and on a stream."""
    readings = events.select(
        "event_id", F.col("value").alias("pm2_5"), F.col("value").alias("aqi"), F.hour("ts").alias("hour"),
        (F.lit(20.0) * F.col("value")).alias("co_ugm3"),
    )
    filled = quality.fill_defaults(readings, presets.READING_DEFAULTS)
    values = F.col("pm2_5")
    record = scoring.score_record(
        filled, (values > 50).cast("int"), F.sqrt(values), (F.col("event_id") % 4).cast("int"), F.lit("fixed")
    )
    pollutants = {"pm25": F.col("pm2_5"), "pm10": F.col("pm10"), "no2": F.col("no2_ugm3"), "o3": F.col("o3"), "co": F.col("co_ugm3")}
    return record.select(
        "event_id", F.col("co_class.high"), F.col("co_class.label").alias("co_label"), "benzene",
        F.col("cluster.id").alias("cluster_id"), F.col("cluster.label").alias("cluster_label"),
        F.col("rush_hour.is_rush"), F.round(scoring.health_score(pollutants), 6).alias("score"),
        F.col("health_risk.label").alias("risk_label"),
    )


@query("h16_scored_record", RECORD_SQL)
def h16(spark, sf):
    return scored_events(table(spark, sf, "events"))


PANEL_SQL = f"""SELECT event_id, hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19 AS is_rush,
  CASE WHEN value * 20 > 1000 THEN 'High CO Level' ELSE 'Normal CO' END AS co_label,
  CASE WHEN value > 80 THEN '🏭 Cluster 2 — Heavy Pollution' WHEN value > 40 THEN '🚗 Cluster 1 — Traffic' ELSE '🌿 Cluster 0 — Clean Air' END AS cluster,
  CAST({RULE_SCORE} AS BIGINT) AS health_score FROM events"""


@query("h16_panel_rules", PANEL_SQL)
def h16_panel(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "value", (F.col("value") * 20).alias("co"))
    panel = scoring.panel_rules(events, "value", "co", "ts")
    return panel.select("event_id", "rush.is_rush", F.col("co_class.label").alias("co_label"), "cluster", "health_score")


PANEL_RUSH = "(hour(ts) BETWEEN 7 AND 9 OR hour(ts) BETWEEN 17 AND 19)"


@query(
    "h16_panel_full",
    f"""SELECT event_id, {PANEL_RUSH} AS is_rush, CASE WHEN {PANEL_RUSH} THEN 'Active Rush Hour' ELSE 'No Rush Hour' END AS rush_label,
        CASE WHEN co > 1000 THEN 'High CO Level' ELSE 'Normal CO' END AS co_label, co > 1000 AS high,
        printf('%.2f', CASE WHEN (co * 0.003e0 * 8) % 2 = 1 THEN co * 0.003e0 + 0.001e0 ELSE co * 0.003e0 END) AS benzene,
        CASE WHEN aqi > 80 THEN '🏭 Cluster 2 — Heavy Pollution' WHEN aqi > 40 THEN '🚗 Cluster 1 — Traffic' ELSE '🌿 Cluster 0 — Clean Air' END AS cluster,
        CASE WHEN aqi <= 20 THEN 'Good' WHEN aqi <= 40 THEN 'Fair' WHEN aqi <= 60 THEN 'Moderate' WHEN aqi <= 80 THEN 'Poor' WHEN aqi <= 100 THEN 'Very Poor' ELSE 'Extremely Poor' END AS category,
        score AS health_score, CASE WHEN score > 80 THEN 'Hazardous' WHEN score > 50 THEN 'Unhealthy' WHEN score > 20 THEN 'Moderate' ELSE 'Good' END AS health_label,
        CASE WHEN score < 20 THEN 'good' WHEN score < 40 THEN 'moderate' WHEN score < 60 THEN 'unhealthy' WHEN score < 80 THEN 'very-unhealthy' ELSE 'hazardous' END AS severity
        FROM (SELECT *, least(100, CAST(floor(aqi * 0.8e0 + 0.5e0) AS BIGINT)) AS score FROM
          (SELECT event_id, ts, CAST(event_id % 151 AS DOUBLE) AS aqi, value * 20 + event_id % 13 AS co FROM events))""",
)
def h16_panel_full(spark, sf):
    """Every field of the panel; air quality and CO vary apart."""
    readings = table(spark, sf, "events").select(
        "event_id", "ts", (F.col("event_id") % 151).cast("double").alias("aqi"), (F.col("value") * 20 + F.col("event_id") % 13).alias("co"))
    panel = scoring.panel_rules(readings, "aqi", "co", "ts")
    return panel.select(
        "event_id", "rush.is_rush", F.col("rush.label").alias("rush_label"), F.col("co_class.label").alias("co_label"), "co_class.high",
        "benzene", "cluster", "category", "health_score", "health_label", "severity",
    )
