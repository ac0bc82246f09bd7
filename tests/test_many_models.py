"""k-means for many settings at once and linear models from moments, against one fit at a time."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from gaugeflow.functions import arrays
from gaugeflow.learning import clustering, moments, pca, pipelines, split
from gaugeflow.operators import partials


def _vectors(spark, points, parts=5):
    rows = [(i, [float(c) for c in p]) for i, p in enumerate(points)]
    return spark.createDataFrame(rows, "i long, v array<double>").repartition(parts).withColumn("features", array_to_vector("v"))


def _cost(points, centres):
    return ((points[:, None] - np.array(centres)[None]) ** 2).sum(axis=2).min(axis=1).sum()


@pytest.fixture(scope="module")
def clouds():
    rng = np.random.default_rng(7)
    return np.concatenate([rng.standard_normal((n, 3)) * s + c for n, s, c in ((200, 1, [0, 0, 0]), (150, 0.5, [9, 0, 0]), (90, 2, [0, 12, 5]), (3, 0.1, [60, 60, 60]))])


def test_costs_are_those_of_the_centres(spark, clouds):
    frame = _vectors(spark, clouds)
    models = [(k, seed) for k in (1, 2, 4, 7) for seed in (1, 2, 3)]
    fits = clustering.fit_many(frame, models, max_iter=50)
    for (k, _), fit in zip(models, fits):
        assert len(fit.centre_table()) == k
        assert fit.training_cost() == pytest.approx(_cost(clouds, fit.centre_table()), rel=1e-9)
    assert fits[0].training_cost() == pytest.approx(((clouds - clouds.mean(axis=0)) ** 2).sum())


def test_as_good_as_single_fits(spark, clouds):
    frame = _vectors(spark, clouds).cache()
    ours = {r["k"]: r["inertia"] for r in clustering.elbow(frame, range(1, 7), seeds=range(42, 47)).collect()}
    for k in range(2, 7):
        theirs = min(KMeans(k=k, seed=seed).fit(frame).summary.trainingCost for seed in range(42, 47))
        assert ours[k] <= theirs * 1.02
    assert all(ours[k + 1] <= ours[k] for k in range(1, 6))


def test_fits_do_not_depend_on_partitions(spark, clouds, monkeypatch):
    models = [(3, 1), (4, 2)]
    one, many = (clustering.fit_many(_vectors(spark, p, n), models) for p, n in ((clouds, 1), (clouds[::-1], 9)))
    monkeypatch.setattr(partials.gather, "__defaults__", (None, 2))  # results meet in a tree
    tree = clustering.fit_many(_vectors(spark, clouds, 9), models)
    for a, b, c in zip(one, many, tree):
        assert np.allclose(a.centre_table(), b.centre_table(), rtol=1e-9) and np.allclose(a.centre_table(), c.centre_table(), rtol=1e-9)


def test_few_distinct_rows_ties_and_gaps(spark):
    points = [[1.0, 0.0]] * 20 + [[5.0, 0.0]] * 3
    frame = _vectors(spark, points).withColumn("features", F.when(F.col("i") != 2, F.col("features")))
    three, one = clustering.fit_many(frame, [(3, 1), (1, 5)])
    assert len(three.centre_table()) == 2 and three.training_cost() == 0
    assert one.training_cost() == pytest.approx(16 * 19 * 3 / 22)
    with pytest.raises(ValueError, match="no rows"):
        clustering.fit_many(frame.where("false"), [(2, 1)])


def test_one_job_per_iteration(spark, clouds):
    frame = _vectors(spark, clouds, 4).cache()
    frame.count()

    def jobs(models):
        spark.sparkContext.setJobGroup("lloyd", "lloyd")
        before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("lloyd"))
        clustering.fit_many(frame, models, max_iter=4, tol=0.0)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup("lloyd")) - before

    few, many = jobs([(3, 1)]), jobs([(k, seed) for k in range(2, 8) for seed in range(5)])
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert many <= 1 + 3 + 1 + 5 and many - few <= 4  # a first row, the draws, the weights, the iterations


def test_saved_as_a_stage(spark, clouds, tmp_path):
    from pyspark.ml import PipelineModel

    frame = _vectors(spark, clouds)
    fit = clustering.fit_kmeans(frame, 3, seeds=(1, 2))
    PipelineModel([fit]).write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    both = fit.transform(frame).join(again.transform(frame).select("i", F.col("prediction").alias("again")), "i")
    assert both.where("prediction != again").count() == 0 and both.count() == len(clouds)


@pytest.fixture(scope="module")
def lines(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((240, 4)) * [1, 30, 0.1, 1] + [0, 500, 3, 7]
    x[:, 3] = x[:, 0] * 0.9 + rng.standard_normal(240) * 0.2  # nearly the same as the first
    y = 3 * x[:, 0] - 0.2 * x[:, 1] + 5 * x[:, 2] + rng.standard_normal(240)
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    frame = spark.createDataFrame(rows, "key long, a double, b double, c double, d double, y double").repartition(6)
    return split.with_fold(frame.withColumn("flat", F.lit(2.0)), "key", 3).cache()


FEATURES = ["a", "b", "c", "d", "flat"]


@pytest.mark.parametrize("penalty,mix", [(0.0, 0.0), (0.01, 0.0), (0.1, 0.5), (0.5, 1.0), (100.0, 1.0)])
def test_elastic_net_equals_spark(lines, penalty, mix):
    w, intercept = moments.elastic_net(moments.fold_moments(lines, FEATURES, "y")[0], penalty, mix)
    net = pipelines.elastic_net("y").setRegParam(penalty).setElasticNetParam(mix).setTol(1e-12).setMaxIter(2000)
    model = pipelines.pipeline(FEATURES, net, standardised=False).fit(lines).stages[-1]
    assert np.allclose(w, model.coefficients.toArray(), atol=1e-6) and intercept == pytest.approx(model.intercept, abs=1e-4)


def test_search_equals_cross_validation(lines):
    net = pipelines.elastic_net("y").setTol(1e-12).setMaxIter(2000)
    grid = pipelines.elastic_net_grid(net, (0.01, 0.1), (0.0, 0.5))
    theirs = pipelines.cross_validate(pipelines.pipeline(FEATURES[:4], net), grid, lines, "y", "fold").avgMetrics
    ours = [s.rmse for s in moments.search(lines, FEATURES[:4], "y", "fold", (0.01, 0.1), (0.0, 0.5))]
    assert np.allclose(ours, theirs, rtol=1e-6)


def test_moments_skip_gaps_and_keep_digits(spark, lines):
    shifted = lines.withColumn("a", F.col("a") + 1e8)
    plain, far = (moments.fold_moments(f, ["a", "c"], "y")[0] for f in (lines, shifted))
    assert np.allclose(plain.products, far.products, rtol=1e-5)
    gaps = lines.withColumn("a", F.when(F.col("key") % 7 == 0, None).when(F.col("key") % 7 == 1, math.nan).otherwise(F.col("a")))
    assert moments.fold_moments(gaps, ["a"], "y")[0].n == lines.where("key % 7 > 1").count()
    assert moments.fold_moments(lines.where("false"), ["a"], "y") == {}
    with pytest.raises(ValueError, match="two folds"):
        moments.search(lines.where("fold = 1"), ["a"], "y", "fold", (0.1,), (0.0,))


def test_constant_label(lines):
    w, intercept = moments.elastic_net(moments.fold_moments(lines.withColumn("y", F.lit(4.0)), ["a", "b"], "y")[0], 0.1, 0.5)
    assert list(w) == [0, 0] and intercept == 4.0


@pytest.mark.parametrize("k", [3, 30])
def test_components_of_a_wide_table(spark, k):
    rng = np.random.default_rng(k)
    points = rng.standard_normal((400, 30)) @ np.diag(np.linspace(3, 0.1, 30)) @ rng.standard_normal((30, 30)) + 1000
    points[:, 7] = 5.0  # constant
    frame = _vectors(spark, points)
    frame = frame.withColumn("features", F.when(F.col("i") != 4, F.col("features")))
    found = pca.fit_components(frame, k)
    kept = np.delete(points, 4, axis=0)
    exact, axes = np.linalg.eigh(np.cov(kept.T))
    n = min(k, 29)
    assert len(found.variances) == n and np.allclose(found.variances, exact[::-1][:n], rtol=1e-6, atol=1e-9)
    assert np.abs(found.directions.T @ found.directions - np.eye(n)).max() < 1e-9 and found.total == pytest.approx(np.trace(np.cov(kept.T)))
    assert np.abs(np.abs((found.directions * axes[:, ::-1][:, :n]).sum(axis=0)) - 1).max() < 1e-6
    rows = pca.project(frame, found).orderBy("i").collect()
    assert rows[4]["pc"] is None
    assert np.allclose([r["pc"] for r in rows if r["i"] != 4], (kept - kept.mean(axis=0)) @ found.directions, atol=1e-8)


def test_components_of_few_rows(spark):
    with pytest.raises(ValueError, match="two rows"):
        pca.fit_components(_vectors(spark, [[1.0, 2.0]]), 1)
    flat = pca.fit_components(_vectors(spark, [[1.0, 2.0]] * 5), 2)
    assert flat.variances.size == 0 and pca.project(_vectors(spark, [[1.0, 2.0]]), flat).first()["pc"] == []
    line = pca.fit_components(_vectors(spark, [[float(i), 2.0 * i] for i in range(9)]), 2)
    assert len(line.variances) == 1 and np.allclose(line.directions[:, 0], np.array([1, 2]) / 5**0.5)


def test_many_centres_are_pruned_and_exact():
    rng = np.random.default_rng(3)
    homes = rng.standard_normal((100, 6)) * 30
    centres = (homes[:, None] + rng.standard_normal((100, 100, 6))).reshape(-1, 6)
    centres[777] = centres[42]  # a tie goes to the lower number
    points = np.vstack([centres[rng.integers(0, 10_000, 300)] + rng.standard_normal((300, 6)) * 0.2, centres[[777, 42]]])
    best, least, measured = arrays.nearest_of(points, centres, arrays._centre_groups(centres))
    away = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    assert (best == away.argmin(axis=1)).all() and np.allclose(least, away.min(axis=1)) and best[-2] == 42
    assert measured < 0.1 * away.size


def test_training_tables_are_dealt_by_their_rows(spark, monkeypatch):
    """Neither many tasks for few rows nor few tasks for many, however the table is cut."""
    from gaugeflow.learning import pipelines
    from gaugeflow.plans import train

    seen = []
    fit = pipelines.RandomForestRegressor._fit
    monkeypatch.setattr(pipelines.RandomForestRegressor, "_fit", lambda self, df: seen.append(df.rdd.getNumPartitions()) or fit(self, df))
    rows = spark.range(0, 600, 1, 50).selectExpr("id", "double(id % 7) AS a", "double(id % 5) AS b", "double(id % 7 * 2) AS y")
    forest = ((2,), (2,))
    train.train_and_compare(rows, "id", "y", forest=forest)
    assert seen and max(seen) == 1
    seen.clear()
    monkeypatch.setattr(pipelines, "TASK_ROWS", 100, raising=False)
    train.train_and_compare(rows.coalesce(1), "id", "y", forest=forest)
    assert seen and min(seen) == 6


def test_service_clusters_keep_only_their_columns(spark, monkeypatch):
    """The rows kept for the passes of k-means carry no columns of the other models."""
    from gaugeflow.plans import train

    seen = []
    fit = train.clustering.fit_kmeans
    monkeypatch.setattr(train.clustering, "fit_kmeans", lambda df, *a, **k: seen.append(df.columns) or fit(df, *a, **k))
    rows = spark.range(0, 400, 1, 2).selectExpr("id", "double(id % 7) AS a", "double(id % 4 * 10) AS b", "double(id % 7 * 2) AS y", "'wide' AS more")
    train.train_service_models(rows, "id", (["a"], "y"), (["b"], "y"), (["b"], "b"), trees=2, depth=2, seeds=(42,))
    assert seen == [["b", "features"]]
