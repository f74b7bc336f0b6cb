"""Component outputs as tagged facts ``(book_id, component, metric, value)``.

Values stay text: what a metric is worth is decided when records are built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.constants import METADATA_FIELDS
from prosestat.functions.numbers import as_float, as_int
from prosestat.functions.paths import path_book_id, path_component, plain_path
from prosestat.functions.text import strip
from prosestat.sources.metadata import is_listing, parse_metadata_line


def scan_lines(spark: SparkSession, path: str | list[str], book_id: str | None = None,
               component: str | None = None) -> DataFrame:
    """``(book_id, component, line)`` of component output files.

    Both tags come from the file path unless given. Several paths are one scan.
    """
    raw = spark.read.text(path, lineSep="\n", recursiveFileLookup=True)
    rows = raw.select("value", plain_path("_metadata.file_path").alias("where"))
    return rows.select(
        (F.lit(book_id) if book_id else path_book_id("where")).alias("book_id"),
        (F.lit(component) if component else path_component("where")).alias("component"),
        F.col("value").alias("line"))


def facts_from_lines(lines: DataFrame) -> DataFrame:
    """Facts of ``(book_id, component, line)`` rows; unusable lines give none.

    wordfreq   ``word TAB whole number``
    sentiment  ``metric TAB number``
    syntactic  ``metric TAB number``, an id in front is ignored
    metadata   CSV; its own id counts and each row gives three facts

    The lines are read once: a line gives the array of its facts. What several
    rules use is a column of its own and nothing is filtered before the arrays
    are taken apart, as a filter moved below these columns would work them out
    again at every use.
    """
    component = F.col("component")
    clean = lines.select("book_id", "component", strip("line").alias("line"))
    # what stands before and after the first tab; the second is null in a line without one
    parts = clean.select("*", F.split("line", "\t", 2).alias("parts"))
    cells = F.when(component == "syntactic", F.split("line", "\t", -1))
    told = parts.select("book_id", "component", strip(F.get("parts", F.lit(0))).alias("key"), strip(F.get("parts", F.lit(1))).alias("value"),
                        cells.alias("cells"), F.when(component == "metadata", parse_metadata_line("line")).alias("about"))
    width = F.size("cells")
    told = told.select("*", F.get("cells", width - 2).alias("name"), F.get("cells", width - 1).alias("last"))

    fact = lambda book, kind, metric, value: F.struct(
        book.alias("book_id"), kind.alias("component"), metric.alias("metric"), value.alias("value"))
    plain = F.array(fact(F.col("book_id"), component, F.col("key"), F.col("value")))
    three = F.array(*[fact(F.col("about.book_id"), F.lit("metadata"), F.lit(name), F.col(f"about.{name}")) for name in METADATA_FIELDS])
    facts = (F.when((component == "wordfreq") & as_int("value").isNotNull(), plain)
             .when((component == "sentiment") & as_float("value").isNotNull(), plain)
             .when((component == "syntactic") & width.isin(2, 3) & as_float("last").isNotNull(),
                   F.array(fact(F.col("book_id"), component, F.col("name"), F.col("last"))))
             .when(is_listing(F.col("about")), three))
    return complete(told.select(F.explode(facts).alias("f")).select("f.*"))


def complete(facts: DataFrame) -> DataFrame:
    """Facts with an id and a value; an empty field makes a fact disappear."""
    return facts.where((F.col("book_id") != "") & (F.col("value") != ""))


def wordfreq_facts(counts: DataFrame) -> DataFrame:
    """Facts of ``(book_id, word, n)``."""
    return counts.select(F.col("book_id").cast("string").alias("book_id"),
                         F.lit("wordfreq").alias("component"), F.col("word").alias("metric"),
                         F.col("n").cast("string").alias("value"))


def metric_facts(long_metrics: DataFrame, component: str) -> DataFrame:
    """Facts of ``(book_id, metric, value)``."""
    return long_metrics.select(F.col("book_id").cast("string").alias("book_id"),
                               F.lit(component).alias("component"), "metric",
                               F.col("value").cast("string").alias("value"))


def metadata_facts(metadata: DataFrame) -> DataFrame:
    """Three facts per metadata row; empty values vanish."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name)
              for name in METADATA_FIELDS]
    wide = metadata.select(F.col("book_id").cast("string").alias("book_id"), *fields)
    long = wide.unpivot("book_id", list(METADATA_FIELDS), "metric", "value")
    return complete(long.select("book_id", F.lit("metadata").alias("component"), "metric", "value"))
