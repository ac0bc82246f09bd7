"""Model invariants, determinism and reports."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gaugeflow.functions.arrays import nearest_centre
from gaugeflow.learning import clustering, comparison, pipelines, scaling, split
from gaugeflow.plans import explore, predict, report, train
from gaugeflow.sources.records import write_json

# --- fixed values: a recorded metrics file ---
METRICS = {
    "LinearRegression": {"rmse": 0.5936, "mae": 0.3997, "r2": 0.7969, "train_time_sec": 11.2},
    "RandomForestRegressor": {"rmse": 0.4921, "mae": 0.3174, "r2": 0.8604, "train_time_sec": 62.5},
}
RECORD = {
    "run_timestamp": "2026-04-18T21:23:57", "mode": "local",
    "dataset": {"total_rows": 9471, "train_rows": 7645, "test_rows": 1826, "features": ["a", "b"], "target": "CO_GT", "cv_folds": 3},
    "models": METRICS, "winner": "Random Forest", "total_pipeline_time_sec": 86.3,
}


@pytest.fixture(scope="module")
def sample(spark):
    """Linear target with a little noise, three groups, some gaps."""
    i = F.col("id")
    noise = lambda salt: (F.abs(F.hash(i, F.lit(salt))) % 1000) / 1000.0 - 0.5
    df = spark.range(1200).select(
        i.alias("key"), (noise(1) * 4 + (i % 3) * 6).alias("a"), (noise(2) * 4).alias("b"), (noise(3) * 4 - (i % 3) * 5).alias("c"),
        noise(4).alias("e"),
    )
    target = 3 * F.col("a") - 2 * F.col("b") + 1 + F.col("e") * 0.1
    return df.withColumns({"y": target, "b": F.when(F.col("key") % 50 != 0, F.col("b"))}).drop("e").cache()


def test_split_and_folds_do_not_depend_on_partitioning(spark, sample):
    def parts(df):
        train_rows, test_rows = split.hash_split(df, "key")
        folds = split.with_fold(df, "key", 3)
        return (sorted(r["key"] for r in test_rows.collect()), sorted((r["key"], r["fold"]) for r in folds.collect()), train_rows.count())

    one, many = parts(sample.coalesce(1)), parts(sample.repartition(13))
    assert one == many
    assert one[2] + len(one[0]) == 1200 and 0.75 < one[2] / 1200 < 0.85


def test_standardise_matches_spark_scaler(sample):
    scaled = scaling.standardise(sample, ["a", "c"]).agg(F.avg("a"), F.stddev_samp("a"), F.avg("c"), F.stddev_samp("c")).first()
    assert scaled == pytest.approx((0, 1, 0, 1), abs=1e-9)
    flat = scaling.standardise(sample.withColumn("a", F.lit(4.0)), ["a"]).select("a").distinct().collect()
    assert [r["a"] for r in flat] == [0.0]


def test_least_squares_residuals_are_orthogonal(sample):
    model = pipelines.pipeline(["a", "b", "c"], pipelines.least_squares("y")).fit(sample.na.drop())
    residual = F.col("y") - F.col("prediction")
    sums = model.transform(sample.na.drop()).agg(*[F.avg(residual * F.col(c)) for c in "abc"], F.avg(residual)).first()
    assert max(abs(s) for s in sums) < 1e-6
    assert model.transform(sample).count() == 1176  # rows with a gap are skipped


def test_save_load_and_missing_model(spark, sample, tmp_path):
    model = pipelines.pipeline(["a", "b"], pipelines.forest_regressor("y", numTrees=5, maxDepth=3)).fit(sample)
    pipelines.save_model(model, str(tmp_path / "m"))
    scored = predict.predict_table(sample, str(tmp_path / "m"), ["key"], str(tmp_path / "csv"))
    direct = model.transform(sample).select("key", "prediction")
    assert sorted(map(tuple, scored.collect())) == sorted(map(tuple, direct.collect()))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 1176
    with pytest.raises(FileNotFoundError):
        pipelines.load_model(str(tmp_path / "absent"))


def test_train_and_compare(spark, sample, tmp_path):
    models, record = train.train_and_compare(
        sample, "key", "y", model_path=str(tmp_path / "models"), metrics_path=str(tmp_path / "metrics"), forest=((5, 8), (3, 5)))
    assert record["winner"] == "Linear Regression" and record["models"]["LinearRegression"]["r2"] > 0.99
    assert record["dataset"]["features"] == ["a", "b", "c"]
    assert record["dataset"]["train_rows"] + record["dataset"]["test_rows"] == 1200
    again = pipelines.load_model(str(tmp_path / "models" / "LinearRegression"))
    assert again.stages[-1].coefficients == models["LinearRegression"].stages[-1].coefficients
    read = comparison.read_metrics(spark, str(tmp_path / "metrics")).first()
    assert read["winner"] == record["winner"] and read["models"]["LinearRegression"]["rmse"] == record["models"]["LinearRegression"]["rmse"]


def test_cross_validation_is_repeatable_after_repartition(sample):
    net = pipelines.elastic_net("y")
    scores = []
    for parts in (1, 7):
        folded = split.with_fold(sample.repartition(parts), "key", 3)
        grid = pipelines.elastic_net_grid(net)
        scores.append(pipelines.cross_validate(pipelines.pipeline(["a", "c"], net), grid, folded, "y", "fold").avgMetrics)
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)


def test_service_models_and_full_record(spark, sample, tmp_path):
    df = sample.withColumns({n: F.col("a") * i for i, n in enumerate(["f1", "f2", "hour", "f4", "f5", "f6", "f7"], 1)})
    models, record = train.train_service_models(
        df, "key", (["a", "b", "c", "f1", "f2", "hour"], "y"), (["a", "b", "c", "f1"], "y"), (["a", "b", "c", "f4", "f5", "f6", "f7"], "y"),
        k=3, trees=5, depth=4, model_path=str(tmp_path / "m"), metadata_path=str(tmp_path / "meta"))
    assert set(record["clustering"]["internal_label_map"].values()) == {0, 1, 2}
    assert record["classification"]["accuracy"] > 0.9
    loaded = {n: pipelines.load_model(str(tmp_path / "m" / n)) for n in models}
    inputs = {n: record[n]["features"] for n in models}
    readings = spark.createDataFrame([(1, 20.0, 12), (2, 200.0, 8)], "id int, aqi double, hour int")
    scored = predict.score_readings(readings, loaded, record["clustering"]["internal_label_map"], inputs)
    got = {r["id"]: r for r in scored.collect()}
    assert got[2]["cluster"]["label"] == "Severe" and got[1]["benzene"] >= 0
    assert got[1]["health_risk"]["score"] == 0.0 and (got[1]["rush_hour"]["label"], got[2]["rush_hour"]["label"]) == ("Off-Peak", "Rush Hour")


def test_elbow_and_cluster_study(spark, sample):
    curve, projected, means = explore.cluster_study(sample, ["a", "b", "c"], k=3, ks=range(1, 5), seeds=(1, 2))
    costs = {r["k"]: r["inertia"] for r in curve.collect()}
    assert costs[1] == pytest.approx(3 * 1175, rel=1e-6)
    assert all(costs[k + 1] <= costs[k] * 1.001 for k in range(1, 4))
    assert projected.count() == 1176 and {"pc1", "pc2", "cluster"} <= set(projected.columns)
    assert means.count() == 3


def test_pca_is_centred_and_ordered(sample):
    from pyspark.ml import Pipeline

    rows = sample.na.drop()
    scaled = Pipeline(stages=[pipelines.assembler(["a", "b", "c"]), pipelines.scaler()]).fit(rows).transform(rows)
    got = clustering.project_pca(scaled).agg(F.avg("pc1"), F.avg("pc2"), F.var_samp("pc1"), F.var_samp("pc2")).first()
    assert abs(got[0]) < 1e-9 and abs(got[1]) < 1e-9
    data = np.array([[r["a"], r["b"], r["c"]] for r in rows.collect()])
    spectrum = np.sort(np.linalg.eigvalsh(np.corrcoef(data.T)))[::-1]
    assert (got[2], got[3]) == pytest.approx(tuple(spectrum[:2]), rel=1e-6)


def test_nearest_centre_ties_and_values(spark):
    df = spark.createDataFrame([([0.0, 0.0],), ([3.0, 4.0],), ([1.0, 0.0],)], "v array<double>")
    got = df.select(nearest_centre(F.col("v"), [[0.0, 0.0], [2.0, 0.0], [3.0, 4.0]]).alias("n")).select("n.*").collect()
    assert [tuple(r) for r in got] == [(0, 0.0), (2, 0.0), (0, 1.0)]
    gaps = spark.createDataFrame([(None,), ([None, 1.0],), ([3.0, 4.0],)], "v array<double>")
    found = gaps.select(nearest_centre(F.col("v"), [[3.0, 3.0]]).alias("n")).collect()
    assert [r["n"] and tuple(r["n"]) for r in found] == [None, None, (0, 1.0)]
    with pytest.raises(Exception, match="length"):
        gaps.select(nearest_centre(F.col("v"), [[1.0]])).collect()


def test_kmeans_assignment_equals_nearest_centre(sample):
    vectors = pipelines.assembler(["a", "b", "c"], "features").transform(sample)
    model = clustering.fit_kmeans(vectors, 3, seeds=(1, 2, 3))
    centres = [list(map(float, c)) for c in model.clusterCenters()]
    scored = model.transform(vectors).withColumn("n", nearest_centre(F.array("a", "b", "c"), centres).getField("cluster"))
    assert scored.filter("n <> prediction").count() == 0


def test_classifiers(spark, sample):
    found = explore.compare_classifiers(sample, "key", ["a", "b", "c"], "y", trees=10, depth=4)
    assert found["logistic"]["accuracy"].first()[0] > 0.95
    shares = found["forest"]["importances"].collect()
    assert shares[0]["feature"] == "a" and sum(r["importance"] for r in shares) == pytest.approx(1.0)
    matrix = found["forest"]["confusion"].agg(F.sum("n")).first()[0]
    support = found["forest"]["report"].filter("class = 'macro avg'").first()["support"]
    assert matrix == support


def test_winners_and_radar(spark):
    long = comparison.metrics_long(spark, METRICS)
    assert {r["metric"]: r["winner"] for r in comparison.winners(long).collect()} == dict.fromkeys(("rmse", "mae", "r2"), "RandomForestRegressor")
    tie = comparison.metrics_long(spark, {m: METRICS["LinearRegression"] for m in METRICS})
    assert {r["winner"] for r in comparison.winners(tie).collect()} == {"LinearRegression"}
    got = {(r["model"], r["axis"]): r["value"] for r in comparison.radar(long).collect()}
    assert got[("LinearRegression", "r2")] == 0.7969 and got[("LinearRegression", "rmse")] == 0
    assert got[("RandomForestRegressor", "rmse")] == pytest.approx(1 - 0.4921 / 0.5936)
    assert got[("RandomForestRegressor", "mae")] == pytest.approx(1 - 0.3174 / 0.3997)


def test_report(spark, tmp_path):
    write_json(spark.createDataFrame([RECORD], comparison.METRICS_SCHEMA), str(tmp_path / "metrics"))
    (tmp_path / "train_run.log").write_text("x" * 12)
    rows, radar = report.build_report(spark, str(tmp_path / "metrics"), str(tmp_path), str(tmp_path / "report"))
    got = {(r["section"], r["key"]): r["value"] for r in rows.collect()}
    assert got[("performance", "RMSE")] == "0.5936|0.4921|RF" and got[("dataset", "Features")] == "a, b"
    assert got[("files", "train_run.log")].startswith("12|") and got[("outcome", "Winner")] == "Random Forest"
    lines = [r["line"] for r in comparison.report_text(rows).collect()]
    assert "  RMSE                     0.5936           0.4921  RF ✓" in lines
    assert "  Total rows            : 9471" in lines and lines[0] == "  RUN REPORT"
    assert radar.count() == 6
    with pytest.raises(Exception, match="(?i)metrics|path"):
        comparison.read_metrics(spark, str(tmp_path / "none"))


def test_vectors_from_arrays(spark):
    df = spark.createDataFrame([([1.0, 2.0],)], "v array<double>").withColumn("features", array_to_vector("v"))
    assert pipelines.plain_vectors(df).first()["features"] == [1.0, 2.0]
    assert math.isclose(clustering.one_cluster_cost(df.union(df)).first()[0], 0.0)
