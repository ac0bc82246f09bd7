"""Comparing fitted models: long metric tables, winners, radar values, report lines."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import lookup
from ..functions.numbers import fixed_text, padded

# --- fixed values: metric direction ---
HIGHER_IS_BETTER = {"rmse": False, "mae": False, "r2": True}

METRICS_SCHEMA = (
    "run_timestamp string, mode string, "
    "dataset struct<total_rows: long, train_rows: long, test_rows: long, features: array<string>, "
    "target: string, cv_folds: int>, "
    "models struct<LinearRegression: struct<rmse: double, mae: double, r2: double, train_time_sec: double>, "
    "RandomForestRegressor: struct<rmse: double, mae: double, r2: double, train_time_sec: double>>, "
    "winner string, total_pipeline_time_sec double"
)
# --- fixed values: report names ---
MODEL_TITLES = {"LinearRegression": "Linear Regression", "RandomForestRegressor": "Random Forest"}
MODEL_BADGES = {"LinearRegression": "LR", "RandomForestRegressor": "RF"}


def metrics_long(spark: SparkSession, metrics: Mapping[str, Mapping[str, float]]) -> DataFrame:
    """``(model, ordinal, metric, value, higher_better)`` from a few metric numbers per model."""
    rows = [
        (model, i, name, float(values[name]), better)
        for i, (model, values) in enumerate(metrics.items())
        for name, better in HIGHER_IS_BETTER.items()
    ]
    return spark.createDataFrame(
        rows, "model string, ordinal int, metric string, value double, higher_better boolean"
    )


def winners(metrics: DataFrame) -> DataFrame:
    """``(metric, winner)`` from a long metric table; a tie goes to the model listed first."""
    cost = F.when(F.col("higher_better"), -F.col("value")).otherwise(F.col("value"))
    best = F.min_by("model", F.struct(cost, F.col("ordinal")))
    return metrics.groupBy("metric").agg(best.alias("winner"))


def radar(metrics: DataFrame) -> DataFrame:
    """``(model, axis, value)``: r2 as it is, errors as one minus their share of the largest."""
    worst = F.max("value").over(Window.partitionBy("metric"))
    value = F.when(F.col("higher_better"), F.col("value")).otherwise(1.0 - F.col("value") / worst)
    return metrics.select("model", F.col("metric").alias("axis"), value.alias("value"))


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """The metrics record, one row; fails at once if there is none."""
    df = spark.read.schema(METRICS_SCHEMA).option("multiLine", True).json(path)
    if df.filter(F.col("models").isNotNull()).isEmpty():
        raise ValueError(f"no metrics record at {path}")
    return df


def unpack_metrics(record: DataFrame) -> DataFrame:
    """Nested metrics record to the long metric table."""
    cells = [
        F.struct(
            F.lit(model).alias("model"), F.lit(i).alias("ordinal"), F.lit(name).alias("metric"),
            F.col(f"models.{model}.{name}").alias("value"), F.lit(better).alias("higher_better"),
        )
        for i, model in enumerate(MODEL_TITLES)
        for name, better in HIGHER_IS_BETTER.items()
    ]
    return record.select(F.inline(F.array(*cells)))


def report_rows(record: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """Report as ``(section, position, key, value)`` rows from a metrics record and a file listing."""
    d, text = F.col("dataset"), lambda c: F.coalesce(c.cast("string"), F.lit("N/A"))
    # --- fixed values: row labels, here and below ---
    entries = [
        ("run", "Run at", text(F.col("run_timestamp"))),
        ("run", "Mode", F.upper(F.coalesce(F.col("mode"), F.lit("local")))),
        ("dataset", "Total rows", text(d["total_rows"])),
        ("dataset", "Training rows", text(d["train_rows"])),
        ("dataset", "Test rows", text(d["test_rows"])),
        ("dataset", "Target variable", text(d["target"])),
        ("dataset", "Cross-val folds", text(d["cv_folds"])),
        ("dataset", "Feature count", text(F.size(d["features"]))),
        ("dataset", "Features", F.array_join(d["features"], ", ")),
    ]
    four = lambda m, n: fixed_text(F.col(f"models.{m}.{n}"), 4, "even")
    left, right = MODEL_TITLES
    for name, better in HIGHER_IS_BETTER.items():
        a, b = F.col(f"models.{left}.{name}"), F.col(f"models.{right}.{name}")
        badge = F.when(b > a if better else b < a, MODEL_BADGES[right]).otherwise(MODEL_BADGES[left])
        entries.append(("performance", name.upper(), F.concat_ws("|", four(left, name), four(right, name), badge)))
    entries += [
        ("performance", "Train (s)", F.concat_ws("|", *[text(F.col(f"models.{m}.train_time_sec")) for m in MODEL_TITLES])),
        ("outcome", "Winner", text(F.col("winner"))),
        ("outcome", "Total pipeline time", text(F.col("total_pipeline_time_sec"))),
    ]
    cells = [
        F.struct(F.lit(s).alias("section"), F.lit(i).alias("position"), F.lit(k).alias("key"), v.alias("value"))
        for i, (s, k, v) in enumerate(entries)
    ]
    rows = record.select(F.inline(F.array(*cells)))
    if files is None:
        return rows
    stamp = F.date_format("modified", "yyyy-MM-dd HH:mm")
    listed = files.select(
        F.lit("files").alias("section"), F.lit(len(entries)).alias("position"), F.col("name").alias("key"),
        F.concat_ws("|", F.col("length").cast("string"), stamp).alias("value"),
    )
    return rows.unionByName(listed)


def report_text(rows: DataFrame) -> DataFrame:
    """Rendered report: one line per row plus a heading per section, as ``(ordinal..., line)`` in order."""
    # --- fixed values: headings ---
    headings = {"run": "RUN REPORT", "dataset": "DATASET SUMMARY", "performance": "MODEL PERFORMANCE COMPARISON",
                "outcome": "WINNER", "files": "LOG FILES"}
    order = {name: i for i, name in enumerate(headings)}
    parts = F.split("value", r"\|")
    wide = F.concat(
        F.lit("  "), padded(F.col("key"), 10), F.lit(" "), padded(F.get(parts, F.lit(0)), 20, True), F.lit(" "),
        padded(F.get(parts, F.lit(1)), 16, True), F.coalesce(F.concat(F.lit("  "), F.get(parts, F.lit(2)), F.lit(" ✓")), F.lit("")),
    )
    plain = F.concat(F.lit("  "), padded(F.col("key"), 22), F.lit(": "), F.col("value"))
    lines = rows.select(
        lookup(F.col("section"), order).alias("block"), F.col("position").alias("place"), F.col("key"),
        F.when(F.col("section") == "performance", wide).otherwise(plain).alias("line"),
    )
    title = lookup(F.col("section"), headings)
    heads = rows.select("section").distinct().select(
        lookup(F.col("section"), order).alias("block"), F.lit(-1).alias("place"), F.lit("").alias("key"),
        F.concat(F.lit("  "), title).alias("line"),
    )
    return lines.unionByName(heads).orderBy("block", "place", "key").select("line")
