"""Word-score lexicon."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.functions.numbers import as_int
from prosestat.functions.text import strip


def scan_lexicon(spark: SparkSession, path: str) -> DataFrame:
    """``(term, score)`` from lines ``term<TAB>score``; a repeated term keeps its last score.

    Lines of another width or without a whole-number score are left out.
    """
    raw = spark.read.text(path)
    fields = F.split(strip("value"), "\t", -1)
    position = F.struct("_metadata.file_path", "_metadata.file_block_start",
                        F.monotonically_increasing_id().alias("row"))
    rows = raw.select(fields.alias("f"), position.alias("position")).where(F.size("f") == 2)
    scored = rows.select(F.get("f", F.lit(0)).alias("term"),
                         as_int(F.get("f", F.lit(1))).cast("int").alias("score"), "position")
    return (scored.where(F.col("score").isNotNull())
            .groupBy("term").agg(F.max_by("score", "position").alias("score")))
