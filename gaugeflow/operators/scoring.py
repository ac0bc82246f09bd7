"""Scoring of sensor readings. Pure expressions, so they work on tables and on streams alike."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import presets
from ..functions import clock, labels, numbers


def health_score(
    readings: Mapping[str, Column],
    thresholds: Mapping[str, float] = presets.POLLUTANT_THRESHOLDS,
    weights: Mapping[str, float] = presets.HEALTH_WEIGHTS,
) -> Column:
    """Weighted share of the pollutant thresholds, 0..100, unrounded.

    A value counts at most as its threshold; there is no lower limit. A null reading makes the score
    null: give defaults first where that is not wanted.
    """
    total = None
    for name, weight in weights.items():
        part = F.lit(weight) * numbers.clamp(readings[name] / F.lit(thresholds[name]), high=1.0)
        total = part if total is None else total + part
    return total * F.lit(100.0)


def health_label(score: Column) -> Column:
    """Label of the unrounded score."""
    return labels.bucket_label(score, presets.HEALTH_EDGES, presets.HEALTH_LABELS)


def absolute_humidity(temperature: Column, humidity: Column) -> Column:
    """Grams of water per cubic metre; null at the pole of the formula (-243.5 degrees)."""
    pressure = F.lit(6.112) * F.exp(F.try_divide(F.lit(17.67) * temperature, temperature + F.lit(243.5)))
    return F.try_divide(pressure * humidity * F.lit(2.1674), F.lit(273.15) + temperature)


def benzene_features(co: Column, no2: Column, temperature: Column, humidity: Column) -> dict[str, Column]:
    """Inputs of the benzene model from a reading. Two are proxies: half of CO stands in for the
    hydrocarbon sensor, and NOx is taken as 1.3 times NO2."""
    return {
        "nmhc": numbers.scaled(co, presets.NMHC_PER_CO),
        "nox": numbers.scaled(no2, presets.NOX_PER_NO2),
        "no2": no2,
        "temperature": temperature,
        "humidity": humidity,
        "absolute_humidity": absolute_humidity(temperature, humidity),
    }


def linear_estimate(
    features: Mapping[str, Column],
    coefficients: Mapping[str, float],
    intercept: float,
    means: Mapping[str, float] | None = None,
    scales: Mapping[str, float] | None = None,
) -> Column:
    """Fixed linear model on (optionally standardised) features, not below zero, unrounded."""
    out = F.lit(float(intercept))
    for name, weight in coefficients.items():
        value = features[name]
        if means is not None:
            value = value - F.lit(float(means[name]))
        if scales is not None:
            value = value / F.lit(float(scales[name])) if scales[name] else F.lit(0.0)  # a constant feature
        out = out + F.lit(float(weight)) * value
    return numbers.clamp(out, low=0.0)


def override_rank(rank: Column, aqi: Column) -> Column:
    """Air-quality override of a cluster rank. The first rule that applies wins, so a rank can also
    go down (rank 3 with an index of 100..149 becomes 2)."""
    return (
        F.when(aqi >= 150, F.lit(3))
        .when(aqi >= 100, F.lit(2))
        .when((aqi >= 60) & (rank < 1), F.lit(1))
        .otherwise(rank)
        .cast("int")
    )


def cluster_state(rank: Column) -> Column:
    """``struct(id, label, emoji)`` for a rank, with fallbacks for unknown ranks."""
    fallback = F.concat(F.lit("Cluster "), rank.cast("string"))
    name = labels.lookup(rank, presets.CLUSTER_NAMES, fallback)
    emoji = labels.lookup(name, presets.CLUSTER_EMOJIS, presets.CLUSTER_EMOJI_DEFAULT)
    return F.struct(rank.alias("id"), name.alias("label"), emoji.alias("emoji"))


def rush_state(hour: Column, ranges=presets.RUSH_SERVICE, names=presets.RUSH_LABELS) -> Column:
    """``struct(is_rush, label)``."""
    hit = clock.in_hour_ranges(hour, ranges)
    return F.struct(hit.alias("is_rush"), labels.yes_no(hit, names).alias("label"))


def co_state(prediction: Column) -> Column:
    """``struct(label, high)`` from a 0/1 class prediction."""
    high = prediction == 1
    return F.struct(labels.yes_no(high, presets.CO_MODEL_LABELS).alias("label"), high.alias("high"))


def aqi_category(aqi: Column) -> Column:
    return labels.bucket_label(aqi, presets.AQI_EDGES, presets.AQI_LABELS, closed="right")


def percent_of_threshold(value: Column, threshold: Column) -> Column:
    """Share of the threshold as text with one decimal, at most 100.0; ``N/A`` when missing."""
    share = numbers.clamp(value / threshold * F.lit(100.0), high=100.0)
    return F.coalesce(numbers.fixed_text(share, 1), F.lit("N/A"))


def rule_co(co: Column) -> Column:
    """``struct(label, high)`` by the fixed limit; a missing value counts as 0."""
    high = F.coalesce(co, F.lit(0.0)) > presets.CO_RULE_LIMIT
    return F.struct(labels.yes_no(high, presets.CO_RULE_LABELS).alias("label"), high.alias("high"))


def rule_benzene(co: Column) -> Column:
    return numbers.fixed_text(F.coalesce(co, F.lit(0.0)) * F.lit(presets.BENZENE_RULE_FACTOR), 2)


def rule_cluster(aqi: Column) -> Column:
    return labels.bucket_label(aqi, presets.RULE_CLUSTER_EDGES, [0, 1, 2], closed="right")


def rule_cluster_label(aqi: Column) -> Column:
    return labels.bucket_label(aqi, presets.RULE_CLUSTER_EDGES, presets.RULE_CLUSTER_LABELS, closed="right")


def rule_health_score(aqi: Column) -> Column:
    score = numbers.round_half_up_integer(aqi * F.lit(0.8))
    return F.when(aqi.isNotNull(), F.least(score, F.lit(100)))


def rule_health_label(score: Column) -> Column:
    return labels.bucket_label(score, presets.RULE_HEALTH_EDGES, presets.RULE_HEALTH_LABELS, closed="right")


def severity_class(score: Column) -> Column:
    return labels.bucket_label(score, presets.HEALTH_EDGES, presets.SEVERITY_LABELS)


def panel_rules(df: DataFrame, aqi: str, co: str, time: str) -> DataFrame:
    """All fixed panel rules on readings: rush hour, CO class, benzene, cluster, health, severity."""
    score = rule_health_score(F.col(aqi))
    return df.withColumns(
        {
            "rush": rush_state(F.hour(F.col(time)), presets.RUSH_PANEL, presets.RUSH_PANEL_LABELS),
            "co_class": rule_co(F.col(co)),
            "benzene": rule_benzene(F.col(co)),
            "cluster": rule_cluster_label(F.col(aqi)),
            "category": aqi_category(F.col(aqi)),
            "health_score": score,
            "health_label": rule_health_label(score),
            "severity": severity_class(score),
        }
    )


def score_record(df: DataFrame, co_class: Column, benzene: Column, rank: Column, timestamp: Column | None = None) -> DataFrame:
    """Full scored record per reading: the response of the scoring service as nested columns.

    Reading fields (see ``presets.READING_DEFAULTS``) must be filled. The three model outputs come in
    as columns, because they belong to whatever models were applied before.
    """
    c = F.col
    readings = {"pm25": c("pm2_5"), "pm10": c("pm10"), "no2": c("no2_ugm3"), "o3": c("o3"), "co": c("co_ugm3")}
    score = health_score(readings)
    risk = F.struct(numbers.round_half_even(score, 1).alias("score"), health_label(score).alias("label"))
    stamp = F.current_timestamp() if timestamp is None else timestamp
    return df.withColumns(
        {
            "co_class": co_state(co_class),
            "benzene": numbers.round_half_even(benzene, 2),
            "cluster": cluster_state(override_rank(rank, c("aqi"))),
            "rush_hour": rush_state(c("hour")),
            "health_risk": risk,
            "timestamp": stamp.cast("string"),
        }
    )
