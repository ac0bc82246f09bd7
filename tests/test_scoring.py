"""Scoring boundaries and overrides."""

import pytest
from pyspark.sql import functions as F

from gaugeflow import presets
from gaugeflow.operators import quality, scoring

FIELDS = {"pm25": "pm2_5", "pm10": "pm10", "no2": "no2_ugm3", "o3": "o3", "co": "co_ugm3"}


def scored(spark, **given):
    df = spark.createDataFrame([(1,)], "id int").withColumns({k: F.lit(float(v)) for k, v in given.items()})
    df = quality.fill_defaults(df, presets.READING_DEFAULTS)
    score = scoring.health_score({p: F.col(c) for p, c in FIELDS.items()})
    row = df.select(score.alias("s"), scoring.health_label(score).alias("l")).first()
    return round(row["s"], 6), row["l"]


def test_health_score(spark):
    assert scored(spark) == (0.0, "Good")
    assert scored(spark, pm2_5=75, pm10=150, no2_ugm3=200, o3=240, co_ugm3=4000) == (100.0, "Hazardous")
    assert scored(spark, pm2_5=750) == (40.0, "Unhealthy")
    assert scored(spark, pm2_5=37.5) == (20.0, "Moderate")
    assert scored(spark, pm2_5=-75) == (-40.0, "Good")


def values(spark, given, schema, make):
    df = spark.createDataFrame([(i, *g) for i, g in enumerate(given)], f"i int, {schema}")
    return [r["x"] for r in df.select("i", make.alias("x")).orderBy("i").collect()]


def test_override_both_ways(spark):
    cases = [(0, 60.0), (0, 100.0), (0, 150.0), (3, 120.0), (1, 60.0), (2, 59.0), (3, 150.0)]
    got = values(spark, cases, "rank int, aqi double", scoring.override_rank(F.col("rank"), F.col("aqi")))
    assert got == [1, 2, 3, 2, 1, 2, 3]


def test_aqi_categories(spark):
    cases = [(v,) for v in (20.0, 20.1, 40.0, 60.0, 80.0, 100.0, 100.1)]
    got = values(spark, cases, "v double", scoring.aqi_category(F.col("v")))
    assert got == ["Good", "Fair", "Fair", "Moderate", "Poor", "Very Poor", "Extremely Poor"]


def test_rule_health_and_cluster(spark):
    aqi = [(v,) for v in (25.0, 26.0, 63.0, 101.0, 200.0)]
    score = scoring.rule_health_score(F.col("v"))
    assert values(spark, aqi, "v double", score) == [20, 21, 50, 81, 100]
    assert values(spark, aqi, "v double", scoring.rule_health_label(score)) == ["Good", "Moderate", "Moderate", "Hazardous", "Hazardous"]
    assert values(spark, aqi, "v double", scoring.severity_class(score)) == ["moderate", "moderate", "unhealthy", "hazardous", "hazardous"]
    assert values(spark, [(40.0,), (41.0,), (80.0,), (81.0,)], "v double", scoring.rule_cluster(F.col("v"))) == [0, 1, 1, 2]


def test_percent_of_threshold(spark):
    cases = [(1000.0, 4000.0), (90.0, 75.0), (None, 75.0)]
    got = values(spark, cases, "v double, t double", scoring.percent_of_threshold(F.col("v"), F.col("t")))
    assert got == ["25.0", "100.0", "N/A"]


def test_humidity_pole(spark):
    cases = [(20.0, 50.0), (-243.5, 50.0)]
    got = values(spark, cases, "t double, h double", scoring.absolute_humidity(F.col("t"), F.col("h")))
    assert got[0] == pytest.approx(8.64, abs=0.02) and got[1] is None


def test_states(spark):
    got = values(spark, [(0,), (3,), (7,)], "r int", scoring.cluster_state(F.col("r")))
    assert [tuple(g) for g in got] == [(0, "Clean", "🌿"), (3, "Severe", "🔴"), (7, "Cluster 7", "🔘")]
    rush = values(spark, [(8,), (11,), (None,)], "h int", scoring.rush_state(F.col("h")))
    assert [tuple(g) for g in rush] == [(True, "Rush Hour"), (False, "Off-Peak"), (False, "Off-Peak")]
    assert values(spark, [(1000.0,), (1001.0,), (None,)], "c double", scoring.rule_benzene(F.col("c"))) == ["3.00", "3.00", "0.00"]


def test_full_record_shape(spark):
    df = quality.fill_defaults(spark.createDataFrame([(1,)], "id int"), presets.READING_DEFAULTS)
    out = scoring.score_record(df, F.lit(1), F.lit(2.675), F.lit(0))
    row = out.select("co_class", "benzene", "cluster", "rush_hour", "health_risk", "timestamp").first()
    assert tuple(row["co_class"]) == ("HIGH CO Risk", True) and row["benzene"] == 2.67
    assert tuple(row["cluster"]) == (0, "Clean", "🌿") and row["rush_hour"]["label"] == "Off-Peak"
    assert tuple(row["health_risk"]) == (0.0, "Good") and row["timestamp"]
