"""JSON and XML records, and columnar tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet, one file per partition; never squeezed into a single writer task."""
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """All rows and columns of a catalog table or view."""
    return spark.table(name)


def read_json_array(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Files that each hold one JSON array of objects, possibly over many lines.

    Such a file is parsed by one task. Large data should come as JSON lines, see
    :func:`read_json_lines`.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_json_lines(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """One object, or one array of objects, per line. Splittable."""
    return spark.read.schema(schema).json(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents of varying shape: the ``line`` as it stands and the ``VARIANT`` column ``doc``, null where
    the line cannot be parsed."""
    return spark.read.text(path).select(F.col("value").alias("line"), F.try_parse_json("value").alias("doc"))


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str | T.StructType) -> DataFrame:
    """XML records by tag. An empty element is missing, so empty strings become null."""
    df = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in texts})


def parse_json(text: Column, schema: str) -> Column:
    """Struct from JSON text. Malformed text gives a null struct (route it with
    :func:`split_malformed`), never a failed job."""
    return F.from_json(text, schema, {"mode": "PERMISSIVE"})


def is_malformed(text: Column, schema: str) -> Column:
    """True for text that is present but not one JSON object whose fields fit ``schema`` (as DDL).

    The parser of :func:`parse_json` is the judge. Arrays, scalars, blank text and values of a wrong type
    are malformed; of a repeated key the last value counts.
    """
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__corrupt"}
    parsed = F.from_json(text, f"{schema}, __corrupt string", options)
    fits = F.ltrim(text).startswith("{") & parsed.isNotNull() & parsed["__corrupt"].isNull()
    return text.isNotNull() & ~fits


def split_malformed(df: DataFrame, column: str, schema: str, output: str) -> tuple[DataFrame, DataFrame]:
    """``(parsed, rejected)``: rows whose text is null or a fitting JSON object, with
    ``output`` added, and the rest."""
    bad = is_malformed(F.col(column), schema)
    good = df.filter(~F.coalesce(bad, F.lit(False)))
    return good.withColumn(output, parse_json(F.col(column), schema)), df.filter(bad)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
