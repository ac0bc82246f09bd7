"""Report job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..learning import comparison
from ..sources.text import list_files, write_text


def build_report(
    spark: SparkSession, metrics_path: str, log_folder: str | None = None, output: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """``(report rows, radar values)`` from a saved metrics record; the rendered text is written when
    ``output`` is given."""
    record = comparison.read_metrics(spark, metrics_path)
    files = list_files(spark, log_folder, "*.log") if log_folder else None
    rows = comparison.report_rows(record, files)
    if output:
        write_text(comparison.report_text(rows), output)
    return rows, comparison.radar(comparison.unpack_metrics(record))
