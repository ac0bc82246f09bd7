"""End-to-end jobs on driver data."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import presets
from ..learning import comparison, pipelines
from ..operators import quality, scoring
from ..plans import clean, explore, predict, report, train
from ..session import scratch_dir
from ..sources.delimited import read_decimal_comma, read_delimited, write_csv
from ..sources.records import write_json, write_parquet
from .models import GROUP_FEATURES, MEASURED, _grouped_events, _hash_sql, measured_models
from .registry import CHANNELS, REGISTRY, WEEKLY, query, rounded, table, weekly

RAW_NAMES = {"click": "C(1)", "view": "C.2(V)", "signup": "S3", "purchase": "P4", "error": "E5"}
RENAMES = {v: k for k, v in RAW_NAMES.items()}


def raw_readings(spark, sf):
    """The wide weekly table as ``;``-separated text with decimal commas, -200 for missing values, a
    mostly missing channel and unnamed trailing columns. Returns the folder."""
    path = scratch_dir(spark, "raw")
    text = lambda c: F.translate(F.coalesce(c.cast("string"), F.lit("-200")), ".", ",")
    sparse = F.when(F.col("reading_id") % 2 == 0, F.col("click"))
    nothing = F.lit(None).cast("string")
    rows = weekly(spark, sf).select(
        F.col("reading_id").cast("string").alias("Id"),
        F.date_format("first_ts", "dd/MM/yyyy").alias("Date"),
        F.date_format("first_ts", "HH.mm.ss").alias("Time"),
        *[text(F.col(c)).alias(RAW_NAMES[c]) for c in CHANNELS],
        text(sparse).alias("half"), nothing.alias("_c9"), nothing.alias("_c10"),
    )
    write_csv(rows, path, sep=";")
    return path


RAW_SQL = f"{WEEKLY}, raw AS (SELECT reading_id, first_ts, {', '.join(CHANNELS)}, CASE WHEN reading_id % 2 = 0 THEN click END AS half FROM weekly)"


def _filled_sql(source, columns):
    return ", ".join(f"round(coalesce({c}, (SELECT avg({c}) FROM {source})), 8) AS {c}" for c in columns)


def _hours(low, high):
    return f"CAST(hour(first_ts) BETWEEN {low} AND {high} OR hour(first_ts) BETWEEN 17 AND 19 AS INTEGER)"


@query(
    "j1_clean",
    f"""WITH {RAW_SQL}, kept AS (SELECT * FROM raw WHERE click IS NOT NULL)
        SELECT CAST(reading_id AS VARCHAR) AS id, strftime(first_ts, '%d/%m/%Y') AS day, {_filled_sql('kept', CHANNELS)},
               CAST(hour(first_ts) AS INTEGER) AS hour, {_hours(7, 9)} AS is_rush FROM kept""",
)
def j1(spark, sf):
    raw = read_delimited(spark, raw_readings(spark, sf), ";", expected=["Id", "Time"])
    cleaned, _ = clean.clean_readings(raw, [*CHANNELS, "half"], RENAMES, target="click")
    path = scratch_dir(spark, "j1")
    write_parquet(cleaned, path)
    back = spark.read.parquet(path).withColumnsRenamed({"Id": "id", "Date": "day", "Hour": "hour", "IsRushHour": "is_rush"})
    return rounded(back.drop("Time"), *CHANNELS, digits=8)


@query(
    "j2_clean_for_exploration",
    f"""WITH {RAW_SQL} SELECT CAST(reading_id AS VARCHAR) AS id, {_filled_sql('raw', [*CHANNELS, 'half'])}, {_hours(8, 10)} AS is_rush_hour FROM raw""",
)
def j2(spark, sf):
    numeric = [*CHANNELS, "half"]
    raw = read_decimal_comma(spark, raw_readings(spark, sf), [*RAW_NAMES.values(), "half"]).withColumnsRenamed(RENAMES)
    cleaned, _ = clean.clean_for_exploration(raw, numeric)
    path = scratch_dir(spark, "j2")
    write_csv(cleaned, path)
    back = spark.read.option("header", True).schema(cleaned.schema).csv(path)
    return rounded(back.select(F.col("Id").alias("id"), *numeric, "is_rush_hour"), *numeric, digits=8)


def _features(spark, sf):
    hour = F.hour("first_ts")
    return weekly(spark, sf).select("reading_id", *CHANNELS, hour.alias("hour")).filter("error IS NOT NULL")


@query(
    "j3_train_and_compare",
    f"""WITH {WEEKLY}, r AS (SELECT *, {_hash_sql('reading_id', 100)} < 80 AS train FROM weekly WHERE error IS NOT NULL)
        SELECT count(*) AS total_rows, count(*) FILTER (WHERE train) AS train_rows, count(*) FILTER (WHERE NOT train) AS test_rows,
          'click, view, signup, purchase, hour' AS features, 'error' AS target, 3 AS cv_folds, 2 AS models, true AS errors_in_order, true AS winner_has_least_rmse,
          true AS models_load FROM r""",
)
def j3(spark, sf):
    out = scratch_dir(spark, "j3")
    train.train_and_compare(
        _features(spark, sf), "reading_id", "error", model_path=f"{out}/models", metrics_path=f"{out}/metrics", parallelism=8
    )
    record = comparison.read_metrics(spark, f"{out}/metrics")
    loaded = [pipelines.load_model(f"{out}/models/{name}") for name in comparison.MODEL_TITLES]
    left, right = (F.col(f"models.{m}") for m in comparison.MODEL_TITLES)
    first, second = comparison.MODEL_TITLES.values()
    sound = lambda m: (m.getField("mae") <= m.getField("rmse")) & (m.getField("r2") <= 1)
    return record.select(
        "dataset.total_rows", "dataset.train_rows", "dataset.test_rows", F.array_join("dataset.features", ", ").alias("features"), "dataset.target",
        "dataset.cv_folds", F.lit(len(loaded)).alias("models"), (sound(left) & sound(right)).alias("errors_in_order"),
        (F.col("winner") == F.when(right.getField("rmse") < left.getField("rmse"), second).otherwise(first)).alias("winner_has_least_rmse"),
        F.lit(all(m.stages for m in loaded)).alias("models_load"),
    )


#: The benzene target: weights of its six inputs, and the intercept.
LINE, BASE = (0.5, -0.25, 0.1, 0.05, -0.02, 0.01), 3.0
GROUP = "user_id % 4"
READING_SQL = f"""r AS (SELECT event_id, user_id % 4 AS g, 1e3 * ({GROUP} + 1) + event_id % 3 AS co_ugm3, 5e1 * ({GROUP} + 1) + event_id % 5 AS no2_ugm3,
  8e0 * ({GROUP} + 1) + event_id % 7 * 1e-1 AS temperature, 2e1 * ({GROUP} + 1) + event_id % 11 * 1e-1 AS humidity,
  value AS pm2_5, CAST(event_id % 199 AS DOUBLE) AS pm10, CAST(event_id % 293 AS DOUBLE) AS o3, CAST(event_id % 181 AS DOUBLE) AS aqi, hour(ts) AS hour,
  {', '.join(f'CAST(event_id % {m} AS DOUBLE) AS r{i}' for i, m in enumerate((7, 11, 13, 17, 19, 23)))} FROM events)"""
WATER_SQL = "(6.112e0 * exp(17.67e0 * temperature / (temperature + 243.5e0)) * humidity * 2.1674e0 / (273.15e0 + temperature))"
BENZENE_SQL = "(3e0 + 0.5e0 * (co_ugm3 * 0.5e0) - 0.25e0 * (no2_ugm3 * 1.3e0) + 0.1e0 * no2_ugm3 + 0.05e0 * temperature - 0.02e0 * humidity + 0.01e0 * " + WATER_SQL + ")"
PLACES = {"co_mg": "co_ugm3 / 1e3", "co_ugm3": "co_ugm3", "bz": BENZENE_SQL, "nox": "no2_ugm3 * 1.3e0", "no2_ugm3": "no2_ugm3", "temperature": "temperature", "humidity": "humidity"}


def service_readings(spark, sf):
    """Readings in four groups that every model input tells apart by a wide gap; all fields vary."""
    event, level = F.col("event_id"), F.col("user_id") % 4 + 1
    odd = {f"r{i}": (event % m).cast("double") for i, m in enumerate((7, 11, 13, 17, 19, 23))}
    return table(spark, sf, "events").select(
        "event_id", (level - 1).alias("g"), (level * 1000.0 + event % 3).alias("co_ugm3"), (level * 50.0 + event % 5).alias("no2_ugm3"),
        (level * 8.0 + event % 7 * 0.1).alias("temperature"), (level * 20.0 + event % 11 * 0.1).alias("humidity"),
        F.col("value").alias("pm2_5"), *[(event % m).cast("double").alias(c) for c, m in (("pm10", 199), ("o3", 293), ("aqi", 181))],
        F.hour("ts").alias("hour"), *[c.alias(n) for n, c in odd.items()],
    )


def service_models(spark, sf, path=None, metadata=None):
    """Models whose right answers are definite: a linear target, a class and clusters with wide gaps."""
    readings = service_readings(spark, sf)
    co, no2 = F.col("co_ugm3"), F.col("no2_ugm3")
    inputs = scoring.benzene_features(co, no2, F.col("temperature"), F.col("humidity"))
    line = sum((F.col(f"r{i}") * w for i, w in enumerate(LINE)), F.lit(BASE))
    rows = readings.withColumns({
        "line": line, "bz": scoring.linear_estimate(inputs, dict(zip(inputs, LINE)), BASE), "co_mg": co / 1000.0, "nox": no2 * 1.3,
        "high_co": F.when(F.col("g") == 3, 10.0).otherwise(0.0),
    })
    return train.train_service_models(
        rows, "event_id", regression=([f"r{i}" for i in range(6)], "line"),
        classification=(["co_ugm3", "no2_ugm3", "temperature", "humidity"], "high_co"),
        clusters=(list(PLACES), "co_ugm3"), model_path=path, metadata_path=metadata,
    )


@query(
    "j4_train_service_models",
    f"""WITH {READING_SQL}, t AS (SELECT *, 3e0 + {' + '.join(f'{w}e0 * r{i}' for i, w in enumerate(LINE))} AS line FROM r WHERE {_hash_sql('event_id', 100)} < 80),
        p AS (SELECT g, {', '.join(f'{e} AS {n}' for n, e in PLACES.items())} FROM r),
        v AS (SELECT {', '.join(f'var_samp({n}) AS {n}' for n in PLACES)} FROM p),
        w AS (SELECT g, count(*) AS n, {', '.join(f'var_pop({n}) * count(*) AS {n}' for n in PLACES)} FROM p GROUP BY g)
        SELECT 0.0::DOUBLE AS mse, 1.0::DOUBLE AS r2, {', '.join(f'round({w} * stddev_samp(r{i}), 5) AS coef_r{i}' for i, w in enumerate(LINE))},
          round(avg(line), 5) AS intercept, (SELECT median(CASE WHEN g = 3 THEN 10.0::DOUBLE ELSE 0 END) FROM r) AS median, 1.0::DOUBLE AS accuracy,
          (SELECT round(sum({' + '.join(f'w.{n} / v.{n}' for n in PLACES)}), 4) FROM w, v) AS inertia, 4 AS clusters, 'Clean, Moderate, High, Severe' AS names FROM t""",
)
def j4(spark, sf):
    out = scratch_dir(spark, "j4")
    service_models(spark, sf, f"{out}/models", f"{out}/metadata")
    record = spark.read.schema(train.MODELS_SCHEMA).json(f"{out}/metadata")
    names = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.element_at("clustering.cluster_labels", i.cast("string")))
    return record.select(
        F.round("regression.mse", 6).alias("mse"), F.round("regression.r2", 6).alias("r2"),
        *[F.round(F.element_at("regression.coef", f"r{i}"), 5).alias(f"coef_r{i}") for i in range(6)], F.round("regression.intercept", 5).alias("intercept"),
        "classification.median", "classification.accuracy", F.round("clustering.inertia", 4).alias("inertia"),
        F.size("clustering.internal_label_map").alias("clusters"), F.array_join(names, ", ").alias("names"),
    )


FINAL_RANK = "CAST(CASE WHEN aqi >= 150 THEN 3 WHEN aqi >= 100 THEN 2 WHEN aqi >= 60 AND g < 1 THEN 1 ELSE g END AS INTEGER)"
FULL_SCORE = "((4e-1 * least(pm2_5 / 75e0, 1e0) + 2e-1 * least(pm10 / 15e1, 1e0) + 2e-1 * least(no2_ugm3 / 2e2, 1e0) + 1e-1 * least(o3 / 24e1, 1e0) + 1e-1 * least(co_ugm3 / 4e3, 1e0)) * 1e2)"


def _full_record_sql(benzene):
    """All fields of the scored record over ``r``."""
    rush = "(hour BETWEEN 8 AND 10 OR hour BETWEEN 17 AND 19)"
    named = lambda names: f"CASE {FINAL_RANK} WHEN 0 THEN '{names[0]}' WHEN 1 THEN '{names[1]}' WHEN 2 THEN '{names[2]}' ELSE '{names[3]}' END"
    risk = f"CASE WHEN {FULL_SCORE} < 20 THEN 'Good' WHEN {FULL_SCORE} < 40 THEN 'Moderate' WHEN {FULL_SCORE} < 60 THEN 'Unhealthy' WHEN {FULL_SCORE} < 80 THEN 'Very Unhealthy' ELSE 'Hazardous' END"
    return f"""SELECT event_id, g = 3 AS high, CASE WHEN g = 3 THEN 'HIGH CO Risk' ELSE 'LOW CO Risk' END AS co_label,
        CAST(printf('%.2f', greatest(0e0, {benzene})) AS DOUBLE) AS benzene, {FINAL_RANK} AS cluster_id, {named(('Clean', 'Moderate', 'High', 'Severe'))} AS cluster_label,
        {named(('🌿', '🔵', '🟠', '🔴'))} AS emoji, {rush} AS is_rush, CASE WHEN {rush} THEN 'Rush Hour' ELSE 'Off-Peak' END AS rush_label,
        CAST(printf('%.1f', {FULL_SCORE}) AS DOUBLE) AS score, {risk} AS risk_label, 'fixed' AS stamp FROM r"""


def _full_record(scored):
    """The record's fields side by side."""
    c = F.col
    return scored.select(
        "event_id", "co_class.high", c("co_class.label").alias("co_label"), "benzene", c("cluster.id").alias("cluster_id"), c("cluster.label").alias("cluster_label"),
        "cluster.emoji", "rush_hour.is_rush", c("rush_hour.label").alias("rush_label"), "health_risk.score", c("health_risk.label").alias("risk_label"),
        c("timestamp").alias("stamp"),
    )


@query("j4_full_record_scoring", f"WITH {READING_SQL} {_full_record_sql(BENZENE_SQL)}")
def j4_score(spark, sf):
    models, record = service_models(spark, sf)
    inputs = {name: record[name]["features"] for name in models}
    readings = service_readings(spark, sf).select("event_id", *[c for c in presets.READING_DEFAULTS])
    return _full_record(predict.score_readings(readings, models, record["clustering"]["internal_label_map"], inputs, F.lit("fixed")))


def _ruled_record(readings):
    """The record with model outputs that are expressions, on a table or a stream."""
    filled = quality.fill_defaults(readings, presets.READING_DEFAULTS)
    return _full_record(scoring.score_record(filled, (F.col("g") == 3).cast("int"), F.sqrt("co_ugm3"), F.col("g").cast("int"), F.lit("fixed")))


@query("h16_full_record", f"WITH {READING_SQL} {_full_record_sql('sqrt(co_ugm3)')}")
def h16_full(spark, sf):
    return _ruled_record(service_readings(spark, sf))


@query(
    "j5_batch_score",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS a, regr_intercept(l_extendedprice, l_quantity) AS b FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_extendedprice, round(a * l_quantity + b, 3) AS prediction FROM lineitem, m""",
)
def j5(spark, sf):
    out = scratch_dir(spark, "j5")
    lines = table(spark, sf, "lineitem")
    model = pipelines.pipeline(["l_quantity"], pipelines.least_squares("l_extendedprice")).fit(lines)
    pipelines.save_model(model, f"{out}/model")
    scored = predict.predict_table(lines, f"{out}/model", ["l_orderkey", "l_linenumber", "l_extendedprice"], f"{out}/scores")
    back = spark.read.option("header", True).schema(scored.schema).csv(f"{out}/scores")
    return rounded(back, "prediction", digits=3)


def metrics_record(spark, sf):
    """A saved metrics record built from the closed-form predictors; returns its folder."""
    wide = measured_models(spark, sf).groupBy().agg(
        *[
            F.struct(
                *[F.max(F.when((F.col("model") == m) & (F.col("metric") == k), F.col("value"))).alias(k) for k in comparison.HIGHER_IS_BETTER],
                F.lit(1.5).alias("train_time_sec"),
            ).alias(m)
            for m in comparison.MODEL_TITLES
        ]
    )
    left, right = (F.col(f"{m}.rmse") for m in comparison.MODEL_TITLES)
    n = table(spark, sf, "lineitem").agg(F.count(F.lit(1))).scalar()
    record = wide.select(
        F.lit("2024-01-01T00:00:00").alias("run_timestamp"), F.lit("local").alias("mode"),
        F.struct(
            n.alias("total_rows"), n.alias("train_rows"), F.lit(0).cast("long").alias("test_rows"),
            F.array(F.lit("l_quantity")).alias("features"), F.lit("l_extendedprice").alias("target"), F.lit(3).alias("cv_folds"),
        ).alias("dataset"),
        F.struct(*comparison.MODEL_TITLES).alias("models"),
        F.when(right < left, "Random Forest").otherwise("Linear Regression").alias("winner"),
        F.lit(3.5).alias("total_pipeline_time_sec"),
    )
    path = scratch_dir(spark, "metrics")
    write_json(record, path)
    return path


@query(
    "k6_s17_metrics_record",
    f"WITH {MEASURED} SELECT (SELECT count(*) FROM lineitem) AS total_rows, round(lr_rmse, 4) AS lr_rmse, round(rf_mae, 4) AS rf_mae, CASE WHEN rf_rmse < lr_rmse THEN 'Random Forest' ELSE 'Linear Regression' END AS winner FROM m",
)
def k6(spark, sf):
    record = comparison.read_metrics(spark, metrics_record(spark, sf))
    return record.select(
        "dataset.total_rows", F.round("models.LinearRegression.rmse", 4).alias("lr_rmse"),
        F.round("models.RandomForestRegressor.mae", 4).alias("rf_mae"), "winner",
    )



@query(
    "j6_k7_report",
    f"""WITH {MEASURED}, n AS (SELECT count(*) AS n FROM lineitem)
    SELECT * FROM (VALUES ('run', 0, 'Run at', '2024-01-01T00:00:00'), ('run', 1, 'Mode', 'LOCAL'), ('dataset', 4, 'Test rows', '0'),
      ('dataset', 5, 'Target variable', 'l_extendedprice'), ('dataset', 6, 'Cross-val folds', '3'), ('dataset', 7, 'Feature count', '1'),
      ('dataset', 8, 'Features', 'l_quantity'), ('performance', 12, 'Train (s)', '1.5|1.5'), ('outcome', 14, 'Total pipeline time', '3.5')) t(section, position, key, value)
    UNION ALL SELECT 'dataset', 2, 'Total rows', CAST(n AS VARCHAR) FROM n UNION ALL SELECT 'dataset', 3, 'Training rows', CAST(n AS VARCHAR) FROM n
    UNION ALL SELECT 'performance', 9, 'RMSE', printf('%.4f|%.4f|', lr_rmse, rf_rmse) || CASE WHEN rf_rmse < lr_rmse THEN 'RF' ELSE 'LR' END FROM m
    UNION ALL SELECT 'performance', 10, 'MAE', printf('%.4f|%.4f|', lr_mae, rf_mae) || CASE WHEN rf_mae < lr_mae THEN 'RF' ELSE 'LR' END FROM m
    UNION ALL SELECT 'performance', 11, 'R2', printf('%.4f|%.4f|', lr_r2, rf_r2) || CASE WHEN rf_r2 > lr_r2 THEN 'RF' ELSE 'LR' END FROM m
    UNION ALL SELECT 'outcome', 13, 'Winner', CASE WHEN rf_rmse < lr_rmse THEN 'Random Forest' ELSE 'Linear Regression' END FROM m""",
)
def j6(spark, sf):
    rows, _ = report.build_report(spark, metrics_record(spark, sf), output=scratch_dir(spark, "report"))
    return rows


@query(
    "j6_report_text",
    f"""WITH written AS ({REGISTRY['j6_k7_report'].sql})
        SELECT CASE WHEN section <> 'performance' THEN printf('  %-22s: %s', key, value)
          ELSE printf('  %-10s %20s %16s', key, split_part(value, '|', 1), split_part(value, '|', 2)) || CASE WHEN split_part(value, '|', 3) = '' THEN '' ELSE '  ' || split_part(value, '|', 3) || ' ✓' END END AS line FROM written
        UNION ALL SELECT '  ' || t FROM (VALUES ('RUN REPORT'), ('DATASET SUMMARY'), ('MODEL PERFORMANCE COMPARISON'), ('WINNER')) h(t)""",
)
def j6_text(spark, sf):
    """The rendered report as it was written, line by line."""
    out = scratch_dir(spark, "report")
    report.build_report(spark, metrics_record(spark, sf), output=out)
    return spark.read.text(out).select(F.col("value").alias("line"))


@query(
    "j7_explore",
    f"""WITH {WEEKLY} SELECT 'missing' AS section, column_name AS key, CAST(missing AS DOUBLE) AS value FROM (
          {' UNION ALL '.join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS missing FROM weekly" for c in ['reading_id', *CHANNELS])})
        UNION ALL SELECT 'summary', 'mean', round(avg(click), 6) FROM weekly UNION ALL SELECT 'summary', 'max', round(max(click), 6) FROM weekly
        UNION ALL SELECT 'summary', 'min', round(min(click), 6) FROM weekly
        UNION ALL SELECT 'above', 'rows', CAST(count(*) AS DOUBLE) FROM weekly WHERE click > 30
        UNION ALL SELECT 'histogram', 'rows', CAST(count(click) AS DOUBLE) FROM weekly
        UNION ALL SELECT 'scatter', 'rows', CAST(count(*) AS DOUBLE) FROM weekly WHERE click IS NOT NULL AND view IS NOT NULL
        UNION ALL SELECT 'correlation', 'click-view', round(corr(click, view), 6) FROM weekly""",
)
def j7(spark, sf):
    wide = weekly(spark, sf).select("reading_id", *CHANNELS)
    found = explore.explore(wide, CHANNELS, "click", ("click", "view"), "reading_id", 30)

    def line(frame, section, key, value):
        return frame.select(F.lit(section).alias("section"), key.alias("key"), F.round(value.cast("double"), 6).alias("value"))

    pair = found["correlation"].filter("column_a = 'click' AND column_b = 'view'")
    parts = [
        line(found["missing"], "missing", F.col("column_name"), F.col("missing")),
        *[line(found["summary"], "summary", F.lit(k), F.col(f"{k}_value")) for k in ("mean", "max", "min")],
        line(found["above"].agg(F.count(F.lit(1)).alias("n")), "above", F.lit("rows"), F.col("n")),
        line(found["histogram"].agg(F.sum("n").alias("n")), "histogram", F.lit("rows"), F.col("n")),
        line(found["scatter"].agg(F.sum("n").alias("n")), "scatter", F.lit("rows"), F.col("n")),
        line(pair, "correlation", F.lit("click-view"), F.col("correlation")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


GRADED = "pow(10, user_id % 4)"


def _bin(value, low, high):
    return f"CAST(least(floor(30.0 * ({value} - {low}) / ({high} - {low})), 29) AS INTEGER)"


@query(
    "j7_explore_bins",
    f"""WITH {WEEKLY}, h AS (SELECT min(click) AS lo, max(click) AS hi FROM weekly),
        b AS (SELECT click, view FROM weekly WHERE click IS NOT NULL AND view IS NOT NULL),
        e AS (SELECT min(click) AS xl, max(click) AS xh, min(view) AS yl, max(view) AS yh FROM b)
        SELECT 'histogram' AS part, {_bin('click', 'lo', 'hi')} AS bin_x, CAST(NULL AS INTEGER) AS bin_y, count(*) AS n FROM weekly, h WHERE click IS NOT NULL GROUP BY 1, 2
        UNION ALL SELECT 'scatter', {_bin('click', 'xl', 'xh')}, {_bin('view', 'yl', 'yh')}, count(*) FROM b, e GROUP BY 1, 2, 3""",
)
def j7_bins(spark, sf):
    """Histogram and scatter of the exploration, bin by bin."""
    wide = weekly(spark, sf).select("reading_id", *CHANNELS)
    found = explore.explore(wide, CHANNELS, "click", ("click", "view"), "reading_id", 30)
    none = F.lit(None).cast("int").alias("bin_y")
    histogram = found["histogram"].select(F.lit("histogram").alias("part"), F.col("bin").alias("bin_x"), none, "n")
    return histogram.unionByName(found["scatter"].select(F.lit("scatter").alias("part"), "bin_x", "bin_y", "n"))


@query(
    "k6_metrics_all_fields",
    f"""WITH {MEASURED}, n AS (SELECT count(*) AS n FROM lineitem) SELECT '2024-01-01T00:00:00' AS run_timestamp, 'local' AS mode, n AS total_rows, n AS train_rows,
        0::BIGINT AS test_rows, 'l_quantity' AS features, 'l_extendedprice' AS target, 3 AS cv_folds, round(lr_rmse, 4) AS lr_rmse, round(lr_mae, 4) AS lr_mae, round(lr_r2, 6) AS lr_r2,
        1.5::DOUBLE AS lr_time, round(rf_rmse, 4) AS rf_rmse, round(rf_mae, 4) AS rf_mae, round(rf_r2, 6) AS rf_r2, 1.5::DOUBLE AS rf_time,
        CASE WHEN rf_rmse < lr_rmse THEN 'Random Forest' ELSE 'Linear Regression' END AS winner, 3.5::DOUBLE AS total_time FROM m, n""",
)
def k6_all(spark, sf):
    record = comparison.read_metrics(spark, metrics_record(spark, sf))
    digits = {"rmse": 4, "mae": 4, "r2": 6}
    measured = [
        F.round(f"models.{m}.{k}", d).alias(f"{badge.lower()}_{k}") for m, badge in comparison.MODEL_BADGES.items() for k, d in digits.items()
    ]
    times = [F.col(f"models.{m}.train_time_sec").alias(f"{badge.lower()}_time") for m, badge in comparison.MODEL_BADGES.items()]
    return record.select(
        "run_timestamp", "mode", "dataset.total_rows", "dataset.train_rows", "dataset.test_rows", F.array_join("dataset.features", ", ").alias("features"),
        "dataset.target", "dataset.cv_folds", *measured, *times, "winner", F.col("total_pipeline_time_sec").alias("total_time"),
    )


@query(
    "j8_cluster_study",
    f"""WITH p AS (SELECT {GRADED} AS x FROM events), z AS (SELECT x, (x - avg(x) OVER ()) / stddev_samp(x) OVER () AS z FROM p),
         parts AS (SELECT k, var_pop(z) * count(*) AS v FROM z, (VALUES (1), (2), (3)) t(k)
           GROUP BY k, CASE k WHEN 1 THEN 0 WHEN 2 THEN CASE WHEN x = 1000 THEN 1 ELSE 0 END ELSE CASE WHEN x <= 10 THEN 0 ELSE x END END)
       SELECT 'elbow' AS part, CAST(k AS INTEGER) AS k, round(3 * sum(v), 3) AS value FROM parts GROUP BY k
       UNION ALL SELECT 'elbow', CAST(range AS INTEGER), 0.0::DOUBLE FROM range(4, 11)
       UNION ALL SELECT 'rows', CAST(round(log10(x)) AS INTEGER), CAST(count(*) AS DOUBLE) FROM p GROUP BY x
       UNION ALL SELECT 'mean', CAST(round(log10(x)) AS INTEGER), 2 * x FROM (SELECT DISTINCT x FROM p)
       UNION ALL SELECT 'variance', 1, 3.0::DOUBLE UNION ALL SELECT 'variance', 2, 0.0::DOUBLE""",
)
def j8(spark, sf):
    """Four distinct points, each ten times as far as the one before, on three features that move together."""
    x = F.pow(F.lit(10.0), F.col("user_id") % 4)
    rows = table(spark, sf, "events").select("event_id", x.alias("f0"), (x * 2).alias("f1"), (F.lit(7.0) - x).alias("f2"))
    curve, projected, means = explore.cluster_study(rows, ["f0", "f1", "f2"], seeds=range(42, 52))
    line = lambda frame, part, k, value: frame.select(F.lit(part).alias("part"), k.cast("int").alias("k"), value.alias("value"))
    place = F.round(F.log10("mean_f0"))
    spread = projected.agg(F.var_samp("pc1").alias("pc1"), F.var_samp("pc2").alias("pc2"))
    parts = [
        line(curve, "elbow", F.col("k"), F.round("inertia", 3)),
        line(means, "rows", place, F.col("n").cast("double")), line(means, "mean", place, F.round("mean_f1", 6)),
        *[line(spread, "variance", F.lit(i), F.round(f"pc{i}", 6)) for i in (1, 2)],
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query(
    "j9_compare_classifiers",
    f"""WITH t AS (SELECT CASE WHEN user_id % 3 = 0 THEN 1 ELSE 0 END AS y FROM events WHERE {_hash_sql('event_id', 100)} >= 80),
         r AS (SELECT CAST(y AS VARCHAR) AS class, count(*) AS support FROM t GROUP BY y UNION ALL SELECT c, (SELECT count(*) FROM t) FROM (VALUES ('macro avg'), ('weighted avg')) a(c))
       SELECT model, class, 1.0::DOUBLE AS precision, 1.0::DOUBLE AS recall, 1.0::DOUBLE AS f1, support FROM r, (VALUES ('logistic'), ('forest')) m(model)
       UNION ALL SELECT model, 'accuracy', 1.0, 1.0, 1.0, (SELECT count(*) FROM t) FROM (VALUES ('logistic'), ('forest')) m(model)
       UNION ALL SELECT 'forest', 'importances', 1.0, 1.0, 1.0, 4""",
)
def j9(spark, sf):
    """A third of the users lies above the median, and every feature tells them apart."""
    high = (F.col("user_id") % 3 == 0).cast("int")
    rows = _grouped_events(spark, sf, high).withColumn("co", high.cast("double") * 10)
    found = explore.compare_classifiers(rows, "event_id", GROUP_FEATURES, "co")
    whole = lambda frame, model, name, value, n: frame.select(
        F.lit(name).alias("class"), *[F.round(value, 6).alias(c) for c in ("precision", "recall", "f1")], n.cast("long").alias("support"), F.lit(model).alias("model"))
    out = None
    for name, tables in found.items():
        n = tables["confusion"].agg(F.sum("n")).scalar()
        part = tables["report"].withColumn("model", F.lit(name)).unionByName(whole(tables["accuracy"], name, "accuracy", F.col("accuracy"), n))
        out = part if out is None else out.unionByName(part)
    shares = found["forest"]["importances"].agg(F.sum("importance").alias("importance"), F.count(F.lit(1)).alias("n"))
    out = out.unionByName(whole(shares, "forest", "importances", F.col("importance"), F.col("n")))
    return rounded(out, "precision", "recall", "f1")
