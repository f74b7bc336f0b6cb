"""The cohort comparison as a small table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosestat.constants import REPORT_FIRST
from prosestat.functions.numbers import display


def comparison_report(comparison: DataFrame, top: int = 6) -> DataFrame:
    """``(position, metric, bestseller_mean, standard_mean, delta, direction)`` as text.

    Preferred metrics come first, the others by name; at least one row is kept.
    """
    scalars = comparison.where(F.col("family") == "scalar")
    place = F.array_position(F.array(*map(F.lit, REPORT_FIRST)), F.col("metric"))
    chosen = (scalars.withColumn("_place", F.when(place > 0, place).otherwise(len(REPORT_FIRST) + 1))
              .orderBy("_place", "metric").limit(max(1, top)))
    # At most ``top`` rows are numbered in one task.
    numbered = chosen.withColumn("position", F.row_number().over(
        Window.orderBy("_place", "metric")).cast("bigint"))
    return numbered.select(
        "position", "metric",
        display("bestseller_mean").alias("bestseller_mean"),
        display("standard_mean").alias("standard_mean"), display("delta").alias("delta"),
        F.coalesce("direction", F.lit("NA")).alias("direction"))


def preview(records: DataFrame, n: int = 5, key: str = "book_id") -> DataFrame:
    """The first ``n`` records in the order of their keys."""
    return records.orderBy(key).limit(n)
