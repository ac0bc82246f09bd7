"""Spark ML pipelines: assemble, standardise, estimate; and saving and loading them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEED = 42
#: Rows of a training table in a task. A forest keeps a weight and a place per row and tree, about a kilobyte.
TASK_ROWS = 1 << 16


def assembler(features: Sequence[str], output: str = "raw_features") -> VectorAssembler:
    """Feature vector; rows with a null or NaN feature are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="skip")


def scaler(source: str = "raw_features", output: str = "features") -> StandardScaler:
    return StandardScaler(inputCol=source, outputCol=output, withMean=True, withStd=True)


def pipeline(features: Sequence[str], estimator: Estimator, standardised: bool = True) -> Pipeline:
    """Assembler, scaler and estimator as one unit, so that they are fitted, validated and saved
    together and no statistics leak from validation rows."""
    if standardised:
        return Pipeline(stages=[assembler(features), scaler(), estimator])
    return Pipeline(stages=[assembler(features, "features"), estimator])


def least_squares(label: str) -> LinearRegression:
    """Ordinary least squares by the normal equations: one pass over the data."""
    return LinearRegression(labelCol=label, solver="normal", regParam=0.0)


def elastic_net(label: str) -> LinearRegression:
    return LinearRegression(labelCol=label, maxIter=100)


def elastic_net_grid(estimator: LinearRegression, reg=(0.01, 0.1), mix=(0.0, 0.5)) -> list:
    return ParamGridBuilder().addGrid(estimator.regParam, list(reg)).addGrid(estimator.elasticNetParam, list(mix)).build()


def forest_regressor(label: str, seed: int = SEED, **params) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, seed=seed, maxMemoryInMB=512, cacheNodeIds=True, **params)


def forest_grid(estimator, trees=(50, 100), depth=(5, 10)) -> list:
    return ParamGridBuilder().addGrid(estimator.numTrees, list(trees)).addGrid(estimator.maxDepth, list(depth)).build()


def forest_classifier(label: str, trees: int = 100, depth: int = 10, seed: int = SEED) -> RandomForestClassifier:
    """Depth is explicit: Spark's default of 5 is shallow and 30 is its limit."""
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, maxMemoryInMB=512, cacheNodeIds=True)


def logistic(label: str, rows: int, inverse_penalty: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """Ridge-penalised logistic regression. The penalty ``1 / (C * rows)`` matches a loss that sums
    over rows instead of averaging."""
    return LogisticRegression(
        labelCol=label, maxIter=max_iter, standardization=False, regParam=1.0 / (inverse_penalty * max(rows, 1))
    )


def dealt(df: DataFrame, key: str, rows: int | None = None) -> DataFrame:
    """``df`` in tasks of about ``TASK_ROWS`` rows each, dealt by ``key``: a small table is not scattered over
    tasks that cost more than its rows, and the tasks of a large one stay of one size however its files are cut."""
    rows = df.count() if rows is None else rows
    return df.repartition(max(1, -(-rows // TASK_ROWS)), key)


def cross_validate(
    estimator: Estimator, grid: list, df: DataFrame, label: str, fold_col: str, folds: int = 3, parallelism: int = 2
) -> CrossValidatorModel:
    """Grid search by RMSE over given folds, best setting refitted on all rows."""
    evaluator = RegressionEvaluator(labelCol=label, metricName="rmse")
    return CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, numFolds=folds,
        foldCol=fold_col, seed=SEED, parallelism=parallelism,
    ).fit(df)


def feature_names(model: PipelineModel) -> list[str]:
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def _by_feature(spark: SparkSession, names, values, value_name: str) -> DataFrame:
    rows = [(i, n, float(v)) for i, (n, v) in enumerate(zip(names, values))]
    return spark.createDataFrame(rows, f"position int, feature string, {value_name} double")


def coefficients(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(position, feature, coefficient)`` of a linear model, intercept last. The scale is that of
    the model's inputs: standardised if the pipeline standardises."""
    fitted = model.stages[-1]
    names = [*feature_names(model), "(intercept)"]
    return _by_feature(spark, names, [*fitted.coefficients.toArray(), fitted.intercept], "coefficient")


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(position, feature, importance)``, most important first, ties by position."""
    table = _by_feature(spark, feature_names(model), model.stages[-1].featureImportances.toArray(), "importance")
    return table.orderBy(F.col("importance").desc(), F.col("position").asc())


def with_features(df: DataFrame, array_column: str, names: Sequence[str]) -> DataFrame:
    """Array elements as separate double columns, for tables that hold vectors as arrays."""
    return df.withColumns({n: F.get(array_column, F.lit(i)).cast("double") for i, n in enumerate(names)})


def plain_vectors(df: DataFrame) -> DataFrame:
    """Vector columns as arrays, for sinks that have no vector type."""
    vectors = [f.name for f in df.schema if isinstance(f.dataType, T.UserDefinedType)]
    return df.withColumns({c: vector_to_array(c) for c in vectors})


def save_model(model: PipelineModel, path: str) -> None:
    """Save scaler and model as one unit, replacing an earlier save."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; a missing or partial save fails here, not at scoring time."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        raise FileNotFoundError(f"no complete model at {path}") from error
