"""Word frequency: per book, over the corpus, and the most frequent words.

Input rows are ``(book_id, text)`` with ``text`` already cut to the body. A book
may be one row or many (shards, lines): counts of its rows add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosestat.constants import TOP_WORDS
from prosestat.functions.text import is_content, let, letter_tokens, total, word_runs


def explode_words(bodies: DataFrame) -> DataFrame:
    """``(book_id, word)``, one row per content word occurrence."""
    return (bodies.select("book_id", F.explode(letter_tokens("text")).alias("word"))
            .where(is_content("word")))


def word_counts_by_book(bodies: DataFrame, partial: bool = False) -> DataFrame:
    """``(book_id, word, n)``. The partial count runs where the text was read.

    ``partial`` gives the counts of each row of ``bodies``, without a shuffle, to
    those who shuffle by book and word themselves and sum up what is equal there,
    as ``write_word_counts`` does. Meant for books of one or few rows.
    """
    if partial:
        runs = bodies.select("book_id", F.explode(content_runs("text")).alias("run"))
        return runs.select("book_id", "run.word", "run.n")
    return explode_words(bodies).groupBy("book_id", "word").agg(F.count("*").alias("n"))


def word_counts(bodies: DataFrame) -> DataFrame:
    """``(word, n)`` over all books; a frequent word is summed before it is shuffled."""
    return explode_words(bodies).groupBy("word").agg(F.count("*").alias("n"))


def merge_word_counts(counts: DataFrame, *keys: str) -> DataFrame:
    """Sum counts ``(..., word, n)`` over everything but ``keys`` and the word."""
    return counts.groupBy(*keys, "word").agg(F.sum("n").alias("n"))


def top_corpus_words(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """The ``k`` most frequent words, equal counts in falling word order."""
    return counts.orderBy(F.desc("n"), F.desc("word")).limit(k)


def top_words_by_book(counts: DataFrame, k: int = TOP_WORDS) -> DataFrame:
    """``(book_id, rank, word, n)``, equal counts in rising word order.

    The rank filter is applied on both sides of the shuffle, so a book of any
    vocabulary sends at most ``k`` rows per task.
    """
    order = Window.partitionBy("book_id").orderBy(F.desc("n"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("book_id", "rank", "word", "n")


def content_runs(text: Column | str) -> Column:
    """``array<struct<word, n>>`` of a text's content words."""
    return word_runs(F.filter(letter_tokens(text), is_content))


def word_profiles(bodies: DataFrame, *keep: str, k: int = TOP_WORDS) -> DataFrame:
    """Per row of ``bodies``: total, unique count and top words, without a shuffle.

    For tables with one row per book. ``keep`` columns are passed on. Totals and
    top words are null when a book has no words.
    """
    profile = let(content_runs("text"), lambda runs: profile_of(runs, k))
    return bodies.select("book_id", *keep, profile.alias("_p")).select(
        "book_id", *keep, "_p.total_word_count", "_p.unique_word_count", "_p.top_words")


def profile_of(runs: Column, k: int = TOP_WORDS) -> Column:
    """Struct of totals and top words of one row's word runs."""
    # Words found once are ranked only where those found more often don't fill the list.
    repeated = F.filter(runs, lambda r: r["n"] > 1)
    ranked = let(repeated, lambda some: F.when(F.size(some) >= k, some).otherwise(runs))
    # Falling count then rising word is the rising order of (-count, word).
    order = F.sort_array(F.transform(ranked, lambda r: F.struct((-r["n"]).alias("minus"), r["word"])))
    top = F.transform(F.slice(order, 1, k), lambda r: F.struct(
        r["word"].alias("word"), (-r["minus"]).alias("count")))
    some = F.size(runs) > 0
    return F.struct(
        F.when(some, total(runs, lambda r: r["n"])).alias("total_word_count"),
        F.when(some, F.size(runs).cast("bigint")).alias("unique_word_count"),
        F.when(some, top).alias("top_words"))
