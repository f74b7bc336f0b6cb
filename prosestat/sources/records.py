"""Record lines and the summary document, read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from prosestat.schemas import SUMMARY_SCHEMA


def scan_record_lines(spark: SparkSession, path: str) -> DataFrame:
    """``value`` = one ``book_id TAB json`` line, good or bad, for ``operators.cohorts``."""
    return spark.read.text(path, lineSep="\n")


def scan_summary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SUMMARY_SCHEMA).json(path, multiLine=True)
