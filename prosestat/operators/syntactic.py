"""Sentence, word and syllable counts of books, and readability scores.

Input rows are ``(book_id, text)`` with ``text`` already cut to the body.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosestat.constants import SYNTACTIC_COUNTERS, SYNTACTIC_METRICS
from prosestat.functions.numbers import ratio
from prosestat.functions.text import (
    complex_words_of_line, content_words, let, line_of, sentence_count, syllables_of_line, words,
)

_ROUNDED = SYNTACTIC_METRICS[3:]


def syntactic_partials(bodies: DataFrame, *keep: str, distinct: bool = True) -> DataFrame:
    """Counters and ``vocabulary`` (distinct content words) of each input row, without a shuffle.

    All its words as they come instead, in ``words``, if they need not be ``distinct`` in a row.
    """
    def measures(said: Column) -> Column:
        size = F.array_size(said)
        return let(line_of(said), lambda line: F.struct(
            size.cast("bigint").alias("word_count"),
            # words are ASCII; a line has a space more than it has words, but two if it has none
            (F.octet_length(line) - F.greatest(size, F.lit(1)) - 1).cast("bigint").alias("char_count"),
            syllables_of_line(line).alias("syllable_count"),
            complex_words_of_line(line).alias("complex_word_count"),
            content_words(said).alias("vocabulary") if distinct else said.alias("words")))

    measured = let(words("text"), measures)
    return bodies.select("book_id", *keep, sentence_count("text").alias("sentence_count"),
                         measured.alias("_m")).select("book_id", *keep, "sentence_count", "_m.*")


def syntactic_counts(bodies: DataFrame, *keep: str) -> DataFrame:
    """Counters per row for tables with one row per book: a map-only job."""
    counters = [F.col(name) for name in SYNTACTIC_COUNTERS]
    return syntactic_partials(bodies, *keep).select(
        "book_id", *keep, *counters, F.size("vocabulary").cast("bigint").alias("unique_word_count"))


def merge_partials(partials: DataFrame) -> DataFrame:
    """Counters per book over its rows: sums, and the size of the united vocabulary.

    Each row's counters ride on its first word. The distinct count goes through
    (book, word), so the words of a book with many rows are spread over tasks.
    """
    exploded = partials.select("book_id", *SYNTACTIC_COUNTERS,
                               F.posexplode_outer("vocabulary").alias("pos", "word"))
    first = F.col("pos").isNull() | (F.col("pos") == 0)
    return exploded.groupBy("book_id").agg(
        *[F.sum(F.when(first, F.col(name)).otherwise(0)).alias(name)
          for name in SYNTACTIC_COUNTERS],
        F.count_distinct("word").alias("unique_word_count"))


def _if_any(score: Column) -> Column:
    return F.when((F.col("word_count") > 0) & (F.col("sentence_count") > 0), score).otherwise(0.0)


def readability(counts: DataFrame, *keep: str) -> DataFrame:
    """The nine syntactic metrics of counters, unrounded; scores are 0.0 without words."""
    w, s = F.col("word_count"), F.col("sentence_count")
    per_sentence, per_word = F.try_divide(w, s), F.try_divide("syllable_count", w)
    complex_share = F.try_divide(F.col("complex_word_count") * 100, w)
    return counts.select(
        "book_id", *keep, "word_count", "sentence_count", "unique_word_count",
        ratio(w, s).alias("avg_sentence_length"),
        ratio("char_count", w).alias("avg_word_length"),
        ratio("unique_word_count", w).alias("type_token_ratio"),
        # The coefficients of the three published scores.
        _if_any(F.lit(206.835) - F.lit(1.015) * per_sentence - F.lit(84.6) * per_word)
        .alias("flesch_reading_ease"),
        _if_any(F.lit(0.39) * per_sentence + F.lit(11.8) * per_word - F.lit(15.59))
        .alias("flesch_kincaid_grade"),
        _if_any(F.lit(0.4) * (per_sentence + complex_share)).alias("gunning_fog_index"))


def rounded(metrics: DataFrame) -> DataFrame:
    """Readability metrics to four decimals."""
    return metrics.withColumns({name: F.round(name, 4) for name in _ROUNDED})


def syntactic_long(metrics: DataFrame) -> DataFrame:
    """``(book_id, metric, value)`` of the nine metrics."""
    doubles = metrics.select("book_id", *[F.col(m).cast("double").alias(m)
                                          for m in SYNTACTIC_METRICS])
    return doubles.unpivot("book_id", list(SYNTACTIC_METRICS), "metric", "value")
