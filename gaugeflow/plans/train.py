"""Training jobs."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame

from .. import presets
from ..learning import clustering, comparison, moments, pipelines, split
from ..operators import filters, quality, stats
from ..operators.schema import feature_columns, quoted
from ..sources.records import write_json


def _timed(task: Callable):
    start = time.monotonic()
    out = task()
    return out, round(time.monotonic() - start, 1)


def train_and_compare(
    df: DataFrame,
    key: str,
    target: str,
    exclude: Sequence[str] = (),
    folds: int = 3,
    model_path: str | None = None,
    metrics_path: str | None = None,
    elastic=((0.01, 0.1), (0.0, 0.5)),
    forest=((50, 100), (5, 10)),
    parallelism: int = 2,
    mode: str | None = None,
) -> tuple[dict[str, PipelineModel], dict]:
    """Cross-validated elastic net and random forest on the same split, compared on the test rows.

    The net's folds and settings are all solved from one scan (:func:`moments.search`); the best setting is
    then fitted as a pipeline on the training rows.

    Features are the numeric columns without key, target and exclusions. Split and folds are hashes of
    ``key``. The winner is the forest only if its test RMSE is strictly lower. Models and the metrics
    record are saved when paths are given. Returns the models and the record.
    """
    started = time.monotonic()
    spark = df.sparkSession
    features = feature_columns(df, exclude={key, target, *exclude})
    read = split.with_fold(df.select(key, target, *features), key, folds).persist()
    total = read.count()
    rows = pipelines.dealt(read, key, total).persist()
    try:
        train, test = split.hash_split(rows, key)
        n_train = train.count()
        read.unpersist()

        def best_net() -> PipelineModel:
            found = min(moments.search(train, features, target, "fold", *elastic), key=lambda s: s.rmse)
            net = pipelines.elastic_net(target).setRegParam(found.penalty).setElasticNetParam(found.mix)
            return pipelines.pipeline(features, net).fit(train)

        def best_forest() -> PipelineModel:
            trees = pipelines.forest_regressor(target)
            pipeline, grid = pipelines.pipeline(features, trees), pipelines.forest_grid(trees, *forest)
            return pipelines.cross_validate(pipeline, grid, train, target, "fold", folds, parallelism).bestModel

        models, metrics = {}, {}
        for name, search in (("LinearRegression", best_net), ("RandomForestRegressor", best_forest)):
            models[name], seconds = _timed(search)
            measured = stats.regression_metrics(models[name].transform(test), target, "prediction").first()
            metrics[name] = {m: measured[m] for m in comparison.HIGHER_IS_BETTER} | {"train_time_sec": seconds}
            if model_path:
                pipelines.save_model(models[name], f"{model_path}/{name}")
    finally:
        rows.unpersist()

    left, right = metrics
    best = right if metrics[right]["rmse"] < metrics[left]["rmse"] else left
    record = {
        "run_timestamp": datetime.now().isoformat(timespec="seconds"),
        "mode": mode or ("local" if spark.sparkContext.master.startswith("local") else "cluster"),
        "dataset": {
            "total_rows": total, "train_rows": n_train, "test_rows": total - n_train,
            "features": features, "target": target, "cv_folds": folds,
        },
        "models": metrics,
        "winner": comparison.MODEL_TITLES[best],
        "total_pipeline_time_sec": round(time.monotonic() - started, 1),
    }
    if metrics_path:
        write_json(spark.createDataFrame([record], comparison.METRICS_SCHEMA), metrics_path)
    return models, record


MODELS_SCHEMA = (
    "regression struct<features: array<string>, target: string, mse: double, r2: double, "
    "coef: map<string, double>, intercept: double>, "
    "classification struct<features: array<string>, target: string, median: double, accuracy: double, "
    "classes: map<string, string>>, "
    "clustering struct<features: array<string>, k: int, internal_label_map: map<string, int>, "
    "cluster_labels: map<string, string>, inertia: double>"
)


def train_service_models(
    df: DataFrame,
    key: str,
    regression: tuple[Sequence[str], str],
    classification: tuple[Sequence[str], str],
    clusters: tuple[Sequence[str], str],
    model_path: str | None = None,
    metadata_path: str | None = None,
    k: int = 4,
    trees: int = 100,
    depth: int = 10,
    seeds: Sequence[int] = range(42, 52),
) -> tuple[dict[str, PipelineModel], dict]:
    """The three models of the scoring surface and their metadata.

    * ``regression``: least squares of a target on features (standardised inputs)
    * ``classification``: forest for "target above its median"
    * ``clusters``: k-means; clusters are ranked by the mean of the second element's column and named

    Each uses the rows that are complete in its own columns.
    """
    spark = df.sparkSession
    models, record = {}, {}

    columns, target = regression
    usable = filters.drop_incomplete_rows(df, [*columns, target])
    train, test = split.hash_split(usable, key)
    models["regression"] = pipelines.pipeline(columns, pipelines.least_squares(target)).fit(train)
    measured = stats.regression_metrics(models["regression"].transform(test), target, "prediction").first()
    linear = models["regression"].stages[-1]
    record["regression"] = {
        "features": list(columns), "target": target, "mse": measured["mse"], "r2": measured["r2"],
        "coef": dict(zip(columns, map(float, linear.coefficients))), "intercept": float(linear.intercept),
    }

    columns, target = classification
    usable = filters.drop_incomplete_rows(df, [*columns, target])
    labelled, middle = quality.binarise_by_median(usable, target, "high")
    train, test = split.hash_split(labelled.select(key, *columns, "high"), key)
    forest = pipelines.forest_classifier("high", trees, depth)
    models["classification"] = pipelines.pipeline(columns, forest).fit(pipelines.dealt(train, key))
    scored = models["classification"].transform(test)
    record["classification"] = {
        "features": list(columns), "target": f"high {target}", "median": middle,
        "accuracy": stats.accuracy(scored, "high", "prediction").first()[0],
        "classes": {"0": f"low {target}", "1": f"high {target}"},
    }

    columns, ordering = clusters
    needed = list(dict.fromkeys([*columns, ordering]))
    usable = filters.drop_incomplete_rows(df.select(*[quoted(c) for c in needed]), needed)
    prepared = Pipeline(stages=[pipelines.assembler(columns), pipelines.scaler()]).fit(usable)
    vectors = prepared.transform(usable).select(quoted(ordering), "features").persist()
    vectors.count()  # all parts at once; the fit first asks for one row, which would fill the first part alone
    try:
        fitted = clustering.fit_kmeans(vectors, k, seeds=seeds)
        assigned = fitted.transform(vectors).withColumnRenamed("prediction", "cluster")
        ranks = clustering.rank_groups(assigned, "cluster", ordering).collect()
    finally:
        vectors.unpersist()
    models["clustering"] = PipelineModel([*prepared.stages, fitted])
    record["clustering"] = {
        "features": list(columns), "k": k, "inertia": fitted.training_cost(),
        "internal_label_map": {str(r["cluster"]): r["rank"] for r in ranks},
        "cluster_labels": {str(i): presets.CLUSTER_NAMES.get(i, f"Cluster {i}") for i in range(k)},
    }

    if model_path:
        for name, model in models.items():
            pipelines.save_model(model, f"{model_path}/{name}")
    if metadata_path:
        write_json(spark.createDataFrame([record], MODELS_SCHEMA), metadata_path)
    return models, record
