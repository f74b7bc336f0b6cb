"""Record lines to payloads, and the comparison of the two cohorts.

Payload: ``(drop_reason, cohort, book_id, title, author, <7 scalars>, syntactic)``,
one row per input line; ``drop_reason`` is null for a usable record. The same
book twice counts twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosestat.constants import (
    COHORTS, DROP_REASONS, SCALAR_METRICS, SENTIMENT_METRICS, TIE_EPSILON,
)
from prosestat.functions import jsonlines as J

_COHORT_NAMES = tuple(COHORTS.values())


def payloads_from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Classify and project ``book_id TAB json`` lines, each parsed once.

    An object that repeats a key has its last value, which is a setting of the
    session: it is made here.
    """
    lines.sparkSession.conf.set(J.REPEATED_KEYS, "true")
    split = lines.select(F.col(column).alias("line"), J.line_key(column).alias("key"),
                         J.line_json(column).alias("json"))
    parsed = split.select("*", J.parse("json").alias("rec"))
    rec = F.col("rec")
    flagged = parsed.select("*", J.flag(J.member(rec, "$.metadata.is_bestseller")).alias("flag"))
    fields = flagged.select(
        J.drop_reason(F.col("line"), rec, F.col("flag")).alias("drop_reason"),
        J.cohort("flag").alias("cohort"), J.record_id("rec", F.col("key")).alias("book_id"),
        F.coalesce(F.try_variant_get(rec, "$.metadata.title", "string"), F.lit("")).alias("title"),
        F.coalesce(F.try_variant_get(rec, "$.metadata.author", "string"), F.lit("")).alias("author"),
        J.whole_number(J.member(rec, "$.total_word_count")).alias("total_word_count"),
        J.whole_number(J.member(rec, "$.unique_word_count")).alias("unique_word_count"),
        *[J.number(J.member(rec, f"$.sentiment.{m}")).alias(m) for m in SENTIMENT_METRICS],
        J.number_map(rec, "$.syntactic").alias("syntactic"))
    return _with_ratio(fields)


def payloads_from_records(records: DataFrame) -> DataFrame:
    """Payloads of typed records, without a detour through JSON text."""
    known = J.cohort(F.try_element_at("metadata", F.lit("is_bestseller")))
    fields = records.select(
        F.when(known.isNull(), DROP_REASONS[-1]).alias("drop_reason"),
        known.alias("cohort"), "book_id",
        *[F.coalesce(F.try_element_at("metadata", F.lit(name)), F.lit("")).alias(name)
          for name in ("title", "author")],
        "total_word_count", "unique_word_count",
        *[F.try_element_at("sentiment", F.lit(m)).alias(m) for m in SENTIMENT_METRICS],
        F.map_filter("syntactic", lambda _, v: v.isNotNull()).alias("syntactic"))
    return _with_ratio(fields)


def _with_ratio(fields: DataFrame) -> DataFrame:
    """Adds the unrounded type-token ratio of a record's own totals."""
    total = F.col("total_word_count")
    return fields.withColumn("type_token_ratio",
                             F.when(total > 0, F.col("unique_word_count") / total))


def cohort_totals(payloads: DataFrame) -> DataFrame:
    """``(drop_reason, cohort, family, metric, n, total)``: all sums in one pass.

    Each payload gives one ``size`` entry, its scalars and its syntactic metrics.
    They are added up before the shuffle, so what leaves a task is a few dozen
    rows whatever the number of books. Everything below starts from this table.
    """
    def entry(family: str, metric: Column, value: Column) -> Column:
        return F.struct(F.lit(family).alias("family"), metric.alias("metric"), value.alias("value"))

    usable = F.col("drop_reason").isNull()
    size = F.array(entry("size", F.lit(""), F.lit(0.0)))
    scalars = F.filter(
        F.array(*[entry("scalar", F.lit(m), F.col(m).cast("double")) for m in SCALAR_METRICS]),
        lambda e: usable & e["value"].isNotNull())
    syntactic = F.when(usable, F.transform(
        F.map_entries(F.coalesce("syntactic", F.create_map().cast("map<string,double>"))),
        lambda e: entry("syntactic", e["key"], e["value"]))).otherwise(
        F.array().cast("array<struct<family:string,metric:string,value:double>>"))
    entries = payloads.select("drop_reason", "cohort",
                              F.inline(F.concat(size, scalars, syntactic)))
    return entries.groupBy("drop_reason", "cohort", "family", "metric").agg(
        F.count("*").alias("n"), F.sum("value").alias("total"))


def drop_counts(totals: DataFrame) -> DataFrame:
    """``(drop_reason, n)`` of the lines left out."""
    left_out = totals.where(F.col("drop_reason").isNotNull() & (F.col("family") == "size"))
    return left_out.groupBy("drop_reason").agg(F.sum("n").alias("n"))


def record_counts(totals: DataFrame) -> DataFrame:
    """One row: lines read, books aggregated, lines left out."""
    lines = totals.where(F.col("family") == "size")
    return lines.agg(*_line_counts())


def _line_counts() -> list[Column]:
    n = F.when(F.col("family") == "size", F.col("n"))
    usable = F.col("drop_reason").isNull()
    return [F.coalesce(F.sum(n), F.lit(0)).alias("input_lines"),
            F.coalesce(F.sum(F.when(usable, n)), F.lit(0)).alias("books_aggregated"),
            F.coalesce(F.sum(F.when(~usable, n)), F.lit(0)).alias("dropped_lines")]


def cohort_means(totals: DataFrame) -> DataFrame:
    """``(cohort, family, metric, n_books, total, mean)`` of the metrics a cohort has.

    A scalar mean divides by all books of the cohort, with or without the metric;
    a syntactic mean divides by the books that have it. ``n_books`` is the divisor.
    """
    mine = totals.where(F.col("drop_reason").isNull() & F.col("cohort").isin(*_COHORT_NAMES))
    size = F.sum(F.when(F.col("family") == "size", F.col("n"))).over(Window.partitionBy("cohort"))
    divided = mine.withColumn("n_books", F.when(F.col("family") == "scalar", size)
                              .otherwise(F.col("n"))).where(F.col("family") != "size")
    return divided.select("cohort", "family", "metric", "n_books", "total",
                          (F.col("total") / F.col("n_books")).alias("mean"))


def direction(delta: Column, eps: float = TIE_EPSILON) -> Column:
    """Which cohort is higher; null without a delta."""
    return (F.when(F.abs(delta) < eps, "tie").when(delta > 0, "bestseller_higher")
            .when(delta.isNotNull(), "standard_higher"))


def compare(means: DataFrame, eps: float = TIE_EPSILON) -> DataFrame:
    """``(family, metric, bestseller_mean, standard_mean, delta, direction)``.

    One row per metric either cohort has; a mean is null where a cohort lacks it.
    """
    sides = [F.max(F.when(F.col("cohort") == name, F.col("mean"))).alias(f"{name}_mean")
             for name in _COHORT_NAMES]
    delta = F.col("bestseller_mean") - F.col("standard_mean")
    return means.groupBy("family", "metric").agg(*sides).select(
        "*", delta.alias("delta"), direction(delta, eps).alias("direction"))


def aggregate_cohorts(payloads: DataFrame, eps: float = TIE_EPSILON) -> DataFrame:
    """The summary document as one row of nested columns, see ``SUMMARY_SCHEMA``.

    Both cohorts are always present; one without books has count 0 and no means.
    The single task at the end reads the few rows of ``cohort_totals``.
    """
    totals = cohort_totals(payloads)
    family, cohort = F.col("family"), F.col("cohort")
    usable = F.col("drop_reason").isNull()

    def gathered(where: Column, *fields: Column) -> Column:
        return F.array_sort(F.collect_list(F.when(where, F.struct(*fields))))

    key = F.col("metric").alias("key")
    place = F.array_position(F.array(*map(F.lit, SCALAR_METRICS)), F.col("metric")).alias("place")
    sums = [*_line_counts(), F.map_from_entries(gathered(
        ~usable & (family == "size"), F.col("drop_reason"), F.col("n"))).alias("dropped_by_reason")]
    for name in _COHORT_NAMES:
        mine = usable & (cohort == name)
        sums += [
            F.coalesce(F.sum(F.when(mine & (family == "size"), F.col("n"))), F.lit(0)).alias(f"{name}_n"),
            gathered(mine & (family == "scalar"), place, key, F.col("total")).alias(f"{name}_scalar"),
            gathered(mine & (family == "syntactic"), key, (F.col("total") / F.col("n")).alias("value"))
            .alias(f"{name}_syntactic")]
    row = totals.agg(*sums)

    def pairs(entries: Column, value) -> Column:
        return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["key"], value(e))))

    row = row.withColumns({
        f"{name}_means": pairs(F.col(f"{name}_scalar"), lambda e, n=name: e["total"] / F.col(f"{n}_n"))
        for name in _COHORT_NAMES} | {
        f"{name}_syn": F.map_from_entries(f"{name}_syntactic") for name in _COHORT_NAMES})

    def deltas(kind: str, value) -> Column:
        best, standard = (F.col(f"{name}_{kind}") for name in _COHORT_NAMES)
        names = F.array_sort(F.array_union(F.map_keys(best), F.map_keys(standard)))
        return F.map_from_entries(F.transform(names, lambda m: F.struct(m, value(
            F.try_element_at(best, m) - F.try_element_at(standard, m)))))

    by_name = lambda entries: F.array_sort(F.transform(
        entries, lambda e: F.struct(e["key"], e["total"])))
    cohort_structs = [c for name in _COHORT_NAMES for c in (F.lit(name), F.struct(
        F.lit(name).alias("cohort"), F.col(f"{name}_n").alias("n_books"),
        F.col(f"{name}_means").alias("means"), F.col(f"{name}_syn").alias("syntactic_means"),
        F.map_from_entries(by_name(f"{name}_scalar")).alias("sums")))]
    return row.select(
        F.lit("results_aggregation").alias("component"), F.lit(1).alias("version"),
        "input_lines", "books_aggregated", "dropped_lines", "dropped_by_reason",
        F.create_map(*cohort_structs).alias("by_cohort"),
        F.struct(
            deltas("means", lambda d: d).alias("mean_deltas_bestseller_minus_standard"),
            deltas("means", lambda d: direction(d, eps)).alias("direction"),
            deltas("syn", lambda d: F.struct(d.alias("delta"), direction(d, eps).alias("direction")))
            .alias("syntactic_mean_deltas")).alias("comparison"))
