"""Tagged facts to one typed record per book."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosestat.constants import TOP_WORDS
from prosestat.functions.numbers import as_float, as_int


def _usable(component: Column, value: Column) -> Column:
    """The value text if its component can use it, else null."""
    return (F.when((component == "wordfreq") & as_int(value).isNotNull(), value)
            .when(component.isin("sentiment", "syntactic") & as_float(value).isNotNull(), value)
            .when(component == "metadata", value))


def deduplicate(facts: DataFrame) -> DataFrame:
    """One fact per (book, component, metric): the greatest usable value text.

    A value the component cannot use never wins; a metric with no usable value
    keeps one row with a null, as its book still gets a record. A 64-bit hash of
    the fact leads its key, so that sorting compares numbers; the key itself
    decides which facts are the same.
    """
    keys = ("book_id", "component", "metric")
    usable = facts.select(F.xxhash64(*keys).alias("hash"), *keys, _usable(F.col("component"), F.col("value")).alias("value"))
    return usable.groupBy("hash", *keys).agg(F.max("value").alias("value")).drop("hash")


#: Parts that the facts of a book are dealt to.
SALTS = 8


def build_records(facts: DataFrame, salts: int = SALTS) -> DataFrame:
    """Records of all books that have a fact; whatever a book lacks is empty or null.

    The facts of a book are dealt to ``salts`` parts by the hash of their metric,
    so no task holds a large book, and equal facts meet. In its part a fact is
    deduplicated and words are summed and ranked; of a part go on its sums, its
    top words and its few metrics, which meet in one row per book. Two shuffles
    in all: the facts, and these.
    """
    keys = ("book_id", "salt", "component", "metric")
    dealt = (facts.where(F.col("book_id").isNotNull())
             .select("book_id", F.pmod(F.xxhash64("metric"), F.lit(salts)).alias("salt"), "component", "metric",
                     _usable(F.col("component"), F.col("value")).alias("value"))
             .repartition("book_id", "salt"))
    # hashes lead the keys of both sorts, which then compare numbers, as in deduplicate
    unique = dealt.withColumn("hash", F.xxhash64(*keys)).groupBy("hash", *keys).agg(F.max("value").alias("value"))
    is_word = F.col("component") == "wordfreq"
    typed = unique.select(*keys, "value", F.when(is_word, as_int("value")).alias("n"), F.xxhash64(*keys[:3]).alias("hash"))
    part = Window.partitionBy("hash", "book_id", "salt", "component")
    order = part.orderBy(F.desc_nulls_last("n"), "metric")
    ranked = typed.select("*", F.row_number().over(order).alias("rank"), F.sum("n").over(part).alias("total"), F.count("n").over(part).alias("unique"))
    # words beyond the top go; the first of a part stays for its sums, also where no word has a usable count
    few = ranked.where(~is_word | (F.col("rank") <= TOP_WORDS))
    first = is_word & (F.col("rank") == 1)
    word = F.when(is_word & F.col("n").isNotNull(), F.struct((-F.col("n")).alias("minus"), F.col("metric").alias("word")))
    by = few.groupBy("book_id").agg(
        F.sum(F.when(first, F.col("total"))).alias("total_word_count"),
        F.nullif(F.sum(F.when(first, F.col("unique"))), F.lit(0)).alias("unique_word_count"),
        F.slice(F.sort_array(F.collect_list(word)), 1, TOP_WORDS).alias("top"),
        _metric_map("metadata", F.col("value")),
        _metric_map("sentiment", as_float("value")),
        _metric_map("syntactic", as_float("value")))
    top = F.transform("top", lambda w: F.struct(w["word"].alias("word"), (-w["minus"]).alias("count")))
    return by.select(
        "book_id", "metadata", "sentiment", "syntactic", "total_word_count", "unique_word_count",
        F.when(F.size("top") > 0, top).alias("top_words"))


def _metric_map(component: str, value: Column) -> Column:
    entry = F.when((F.col("component") == component) & value.isNotNull(), F.struct("metric", value.alias("value")))
    return F.map_from_entries(F.array_sort(F.collect_list(entry))).alias(component)
