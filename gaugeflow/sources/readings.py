"""Live readings: nested JSON records landed as files, read as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --- fixed values: fields of a landed reading ---
READING_FIELDS = {
    "time": "string",
    "pm10": "double",
    "pm2_5": "double",
    "carbon_monoxide": "double",
    "nitrogen_dioxide": "double",
    "ozone": "double",
    "european_aqi": "double",
    "temperature_2m": "double",
    "relative_humidity_2m": "double",
}


def reading_schema(extra: str = "") -> str:
    """``current`` struct plus optional top-level columns such as ``"location long"``."""
    fields = ", ".join(f"{name}: {kind}" for name, kind in READING_FIELDS.items())
    return ", ".join(part for part in (extra, f"current struct<{fields}>") if part)


def stream_readings(
    spark: SparkSession, folder: str, extra: str = "", files_per_trigger: int | None = None
) -> DataFrame:
    """Flattened readings from JSON files as they land in ``folder``."""
    schema = reading_schema(extra)
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    top = [f.name for f in T._parse_datatype_string(schema) if f.name != "current"]
    return reader.json(folder).select(*top, "current.*")


def stream_table(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_trigger: int | None = None
) -> DataFrame:
    """Parquet files of one folder (or of those that a pattern names) as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)
