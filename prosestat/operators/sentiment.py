"""Lexicon sentiment of books."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosestat.constants import SENTIMENT_METRICS
from prosestat.functions.numbers import ratio
from prosestat.operators.wordfreq import content_runs


def sentiment_by_book(bodies: DataFrame, lexicon: DataFrame) -> DataFrame:
    """``(book_id, polarity_score, positive_count, negative_count, total_scored_words)``.

    ``lexicon`` is ``(term, score)``; a repeated term has its greatest score, a
    null score is no score. Each text is reduced to its distinct words and their
    counts where it is read; these are joined with the lexicon on the word. How
    the join runs is left to the optimizer: a small lexicon is broadcast, a large
    one shuffled with hot words split. Every book gets a row.
    """
    # A book without words keeps one row with a null word.
    runs = bodies.select("book_id", F.explode_outer(content_runs(F.col("text"))).alias("run")).select(
        "book_id", F.col("run.word").alias("term"), F.col("run.n").alias("n"))
    sums = runs.join(term_scores(lexicon), "term", "left").groupBy("book_id").agg(*score_sums(F.col("n")))
    return sums.select("book_id", *sentiment_metrics())


def term_scores(lexicon: DataFrame) -> DataFrame:
    """``(term, score)``, one row per term."""
    return lexicon.where("score is not null").groupBy("term").agg(F.max("score").alias("score"))


def score_values(n: Column) -> dict[str, Column]:
    """What a word that occurs ``n`` times adds to the sums behind the metrics; ``score`` is null outside the lexicon."""
    score = F.col("score")
    return {"score_sum": score * n, "positive_count": F.when(score > 0, n), "negative_count": F.when(score < 0, n),
            "total_scored_words": F.when(score.isNotNull(), n)}


def score_sums(n: Column) -> list[Column]:
    """The sums of ``score_values``, 0 without a scored word."""
    return [F.coalesce(F.sum(value), F.lit(0)).alias(name) for name, value in score_values(n).items()]


def sentiment_metrics() -> list[Column]:
    """The four metrics from the columns of ``score_sums``."""
    return [ratio("score_sum", "total_scored_words").alias("polarity_score"),
            *[F.col(name).cast("double").alias(name) for name in SENTIMENT_METRICS[1:]]]


def sentiment_long(sentiment: DataFrame) -> DataFrame:
    """``(book_id, metric, value)``, unrounded."""
    return sentiment.unpivot("book_id", list(SENTIMENT_METRICS), "metric", "value")


def sum_by_metric(long_metrics: DataFrame) -> DataFrame:
    """``(metric, value)``: equal metric names add up, polarity included."""
    return long_metrics.groupBy("metric").agg(F.sum("value").alias("value"))
