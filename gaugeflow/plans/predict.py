"""Scoring jobs: saved models over a table or a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import presets
from ..functions.labels import lookup
from ..functions.numbers import nan_to_null
from ..learning.pipelines import load_model
from ..operators import quality, scoring
from ..sources.delimited import write_csv


def predict_table(
    df: DataFrame, model_path: str, keep: Sequence[str], output: str | None = None
) -> DataFrame:
    """Apply a saved pipeline and keep the listed columns plus ``prediction``; rows with an invalid
    feature are skipped by the pipeline. Written as CSV when ``output`` is given."""
    scored = load_model(model_path).transform(df).select(*keep, "prediction")
    if output:
        write_csv(scored, output)
    return scored


def score_readings(
    readings: DataFrame,
    models: Mapping[str, PipelineModel],
    label_map: Mapping[str, int],
    inputs: Mapping[str, Sequence[str]],
    timestamp=None,
) -> DataFrame:
    """Full scored record from readings and the three service models.

    Absent fields get their defaults. ``inputs`` names, per model, the feature columns the model was
    trained with, in the order of the features built here: regression (half CO, 1.3 NO2, NO2,
    temperature, humidity, absolute humidity), classification (CO, NO2, temperature, humidity),
    clustering (CO in mg, CO, benzene, 1.3 NO2, NO2, temperature, humidity). Raw CO stands in for
    the sensor response, as a proxy. Works on a stream as well: only expressions and transforms.
    """
    fields = list(presets.READING_DEFAULTS)
    extra = [c for c in readings.columns if c not in fields]
    # NaN is missing too: the models would drop such a row
    number = [f for f in fields if f in readings.columns and isinstance(readings.schema[f].dataType, T.FractionalType)]
    present = readings.withColumns({f: nan_to_null(F.col(f)) for f in number})
    df = quality.fill_defaults(present, presets.READING_DEFAULTS)
    co, no2, t, rh = F.col("co_ugm3"), F.col("no2_ugm3"), F.col("temperature"), F.col("humidity")

    def apply(frame, name, values, output):
        # The reading travels as one struct, so a feature may share a name with a reading field.
        named = [v.alias(n) for n, v in zip(inputs[name], values, strict=True)]
        scored = models[name].transform(frame.select(F.struct("*").alias("__reading"), *named))
        return scored.select("__reading.*", F.col("prediction").alias(output))

    df = apply(df, "regression", list(scoring.benzene_features(co, no2, t, rh).values()), "__benzene")
    df = df.withColumn("__benzene", F.greatest(F.lit(0.0), F.col("__benzene")))
    df = apply(df, "classification", [co, no2, t, rh], "__class")
    nox = no2 * presets.NOX_PER_NO2
    df = apply(df, "clustering", [co / presets.CO_TO_MG, co, F.col("__benzene"), nox, no2, t, rh], "__cluster")
    rank = lookup(F.col("__cluster").cast("string"), dict(label_map), F.col("__cluster"))
    scored = scoring.score_record(df, F.col("__class"), F.col("__benzene"), rank, timestamp)
    record = ["co_class", "benzene", "cluster", "rush_hour", "health_risk", "timestamp"]
    return scored.select(*extra, *record)
