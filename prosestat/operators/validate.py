"""Checks on books and component outputs, and the polarity gap of the cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosestat.constants import SENTIMENT_METRICS
from prosestat.functions.numbers import as_float
from prosestat.functions.text import strip


def present_books(metadata: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed books whose file is there."""
    return metadata.join(inventory, "filename", "left_semi")


def missing_books(metadata: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed books without a file."""
    return metadata.join(inventory, "filename", "left_anti")


def book_sizes(metadata: DataFrame, inventory: DataFrame) -> DataFrame:
    """Listed books that have a file, with its size in KB, the largest first."""
    return metadata.join(inventory.select("filename", "size_kb"), "filename").orderBy(
        F.desc("size_kb"), "book_id")


def check_wordfreq(lines: DataFrame) -> DataFrame:
    """``(book_id, wordfreq_ok, unique_words)`` of ``(book_id, line)`` output rows.

    A book is valid with at least one line whose count is all digits.
    """
    parts = F.split("line", "\t", 2)
    counted = (F.size(parts) == 2) & F.rlike(strip(F.get(parts, F.lit(1))), F.lit(r"^[0-9]+\z"))
    return lines.groupBy("book_id").agg(
        F.count_if(counted).alias("unique_words")).select(
        "book_id", (F.col("unique_words") > 0).alias("wordfreq_ok"), "unique_words")


def check_sentiment(lines: DataFrame) -> DataFrame:
    """``(book_id, sentiment_ok, polarity)`` of ``(book_id, line)`` output rows.

    A book is valid when all four metrics have a number. Metrics are first
    reduced to one row each, so a book's lines never meet as a list.
    """
    parts = F.split("line", "\t", 2)
    pairs = lines.where(F.size(parts) == 2).select(
        "book_id", strip(F.get(parts, F.lit(0))).alias("metric"),
        as_float(F.get(parts, F.lit(1))).alias("value"))
    has = [F.max((F.col("metric") == m) & F.col("value").isNotNull()) for m in SENTIMENT_METRICS]
    every = has[0]
    for test in has[1:]:
        every = every & test
    return pairs.groupBy("book_id").agg(
        F.coalesce(every, F.lit(False)).alias("sentiment_ok"),
        F.max(F.when(F.col("metric") == SENTIMENT_METRICS[0], F.col("value"))).alias("polarity"))


def validate_outputs(metadata: DataFrame, wordfreq: DataFrame, sentiment: DataFrame) -> DataFrame:
    """One row per listed book: are its outputs valid? A book without output is not."""
    checked = metadata.join(check_wordfreq(wordfreq), "book_id", "left").join(
        check_sentiment(sentiment), "book_id", "left")
    return checked.withColumns({
        "wordfreq_ok": F.coalesce("wordfreq_ok", F.lit(False)),
        "unique_words": F.coalesce("unique_words", F.lit(0)),
        "sentiment_ok": F.coalesce("sentiment_ok", F.lit(False)),
        "polarity": F.coalesce("polarity", F.lit(0.0))})


def validation_totals(checks: DataFrame) -> DataFrame:
    """One row: books tested and books with an invalid output."""
    return checks.agg(F.count("*").alias("books_tested"),
                      F.count_if(~F.col("wordfreq_ok")).alias("wordfreq_errors"),
                      F.count_if(~F.col("sentiment_ok")).alias("sentiment_errors"))


def listing_totals(metadata: DataFrame, inventory: DataFrame) -> DataFrame:
    """One row: books listed, present and missing."""
    here = inventory.select("filename").distinct().withColumn("here", F.lit(True))
    return metadata.join(here, "filename", "left").agg(
        F.count("*").alias("books_listed"), F.count("here").alias("books_present"),
        F.count_if(F.col("here").isNull()).alias("books_missing"))


def polarity_gap(checks: DataFrame) -> DataFrame:
    """One row: mean polarity of the valid books of each cohort, their gap and its sign.

    A cohort without valid books averages 0.0 and leaves gap and sign null.
    """
    def average(flag: str):
        mine = (F.col("is_bestseller") == flag) & F.col("sentiment_ok")
        return F.count_if(mine), F.avg(F.when(mine, F.col("polarity")))

    (best_n, best), (standard_n, standard) = average("1"), average("0")
    sums = checks.agg(best_n.alias("bestseller_books"), best.alias("best"),
                      standard_n.alias("standard_books"), standard.alias("std"))
    gap = F.col("best") - F.col("std")
    return sums.select(
        "bestseller_books", F.coalesce("best", F.lit(0.0)).alias("bestseller_polarity"),
        "standard_books", F.coalesce("std", F.lit(0.0)).alias("standard_polarity"),
        gap.alias("gap"),
        F.when(gap > 0, "more positive").when(gap.isNotNull(), "more negative").alias("direction"))
