"""Exploration job and the two model studies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..learning import clustering, pipelines, split
from ..operators import filters, quality, schema, stats
from ..session import materialise


def explore(
    df: DataFrame, columns: Sequence[str], focus: str, scatter: tuple[str, str], key: str, limit: float, bins: int = 30
) -> dict[str, DataFrame]:
    """The tables behind a first look: info, preview, missing counts, summary and histogram of
    ``focus``, correlations, binned scatter, rows with ``focus`` above ``limit``. All lazy."""
    return {
        "info": schema.dataset_info(df),
        "preview": schema.preview(df, [key], 5),
        "missing": quality.missing_counts(df),
        "summary": stats.summary(df, focus),
        "histogram": stats.histogram(df, focus, bins),
        "correlation": stats.correlation_matrix(df, columns),
        "scatter": stats.scatter_bins(df, *scatter, bins),
        "above": filters.above(df, focus, limit),
    }


def cluster_study(
    df: DataFrame, features: Sequence[str], k: int = 4, ks: Sequence[int] = range(1, 11), seeds: Sequence[int] = (42,)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(elbow, projected rows, cluster means)`` on standardised complete rows.

    The projected rows carry the features, ``cluster`` and the first two principal components.
    """
    usable = filters.drop_incomplete_rows(df, features)
    prepared = Pipeline(stages=[pipelines.assembler(features), pipelines.scaler()]).fit(usable)
    vectors = materialise(prepared.transform(usable), "vectors")  # each fit and both results read it again
    curve = clustering.elbow(vectors, ks, seeds=seeds)
    assigned = clustering.fit_kmeans(vectors, k, seeds=seeds).transform(vectors)
    assigned = assigned.withColumnRenamed("prediction", "cluster")
    projected = clustering.project_pca(assigned).drop("raw_features", "features")
    return curve, projected, stats.group_means(assigned, ["cluster"], features)


def compare_classifiers(
    df: DataFrame, key: str, features: Sequence[str], target: str, trees: int = 100, depth: int = 10
) -> dict[str, dict[str, DataFrame]]:
    """Logistic regression and forest for "target above its median", on the same split.

    Per model: accuracy, per-class report and confusion matrix on the test rows; for the forest the
    feature importances as well.
    """
    usable = filters.drop_incomplete_rows(df, [*features, target])
    labelled, _ = quality.binarise_by_median(usable, target, "label")
    train, test = split.hash_split(labelled.withColumn("label", F.col("label").cast("double")), key)
    n = train.count()
    train = pipelines.dealt(train, key, n).persist()
    try:
        fits = {
            "logistic": pipelines.pipeline(features, pipelines.logistic("label", n)).fit(train),
            "forest": pipelines.pipeline(features, pipelines.forest_classifier("label", trees, depth)).fit(train),
        }
    finally:
        train.unpersist()
    out = {}
    for name, model in fits.items():
        scored = model.transform(test).select(F.col("label").cast("int"), F.col("prediction").cast("int"))
        out[name] = {
            "accuracy": stats.accuracy(scored, "label", "prediction"),
            "report": stats.class_report(scored, "label", "prediction"),
            "confusion": stats.confusion(scored, "label", "prediction"),
        }
    out["forest"]["importances"] = pipelines.importances(df.sparkSession, fits["forest"])
    return out
