"""Writers. Every write replaces what the path held.

Parquet, ranged by book, is the form for large results; the text forms exist
for exchange. ``parts=1`` merges the output into one file and is meant for
small results only.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.functions.numbers import fixed4


@contextmanager
def staged(df: DataFrame, path: str) -> Iterator[DataFrame]:
    """``df`` written to a folder of its own beside ``path`` and read back; the folder goes at the end."""
    place = f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    spark = df.sparkSession
    try:
        df.write.parquet(place)
        yield spark.read.schema(df.schema).parquet(place)
    finally:
        remove(spark, place)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of any file system that Spark knows."""
    jvm, settings = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(settings).delete(place, True)


def _parts(df: DataFrame, parts: int | None) -> DataFrame:
    return df.coalesce(parts) if parts else df


def _tsv(df: DataFrame, path: str, *partition_by: str) -> None:
    line = F.concat_ws("\t", *[F.col(c) for c in df.columns if c not in partition_by])
    out = df.select(*partition_by, line.alias("value")).write.mode("overwrite")
    (out.partitionBy(*partition_by) if partition_by else out).text(path)


def write_word_counts(counts: DataFrame, path: str, fmt: str = "parquet",
                      per_book: bool = False, parts: int | None = None, held: bool = False, summed: bool = False) -> None:
    """Word counts of the corpus ``(word, n)`` or of books ``(book_id, word, n)``.

    Parquet is ranged by the key columns, so readers skip row groups by book or
    word; the counts are written beside the output first, as the bounds of the
    ranges are sampled in a run of their own, which would count everything again;
    ``held`` counts are read from files already and are not. Parquet takes partial
    counts too: those of equal keys meet in a range and add up there, so that
    counting and ranging are one shuffle; ``summed`` counts have a key once and are only
    ranged. ``per_book`` lays out one directory per book, for small corpora.
    """
    if fmt == "tsv":
        _tsv(_parts(counts, parts), path, *(["book_id"] if per_book else []))
        return
    keys = [c for c in ("book_id", "word") if c in counts.columns]
    with nullcontext(counts) if held else staged(counts, path) as kept:
        ranged = kept.select(*keys, "n").repartitionByRange(*keys)
        merged = ranged if summed else ranged.groupBy(*keys).agg(F.sum("n").alias("n"))
        _parts(merged.sortWithinPartitions(*keys), parts).write.mode("overwrite").parquet(path)


def write_metrics(long_metrics: DataFrame, path: str, fmt: str = "tsv",
                  parts: int | None = None) -> None:
    """``(book_id, metric, value)`` as ``book_id TAB metric TAB value``, numbers as given text."""
    if fmt == "tsv":
        _tsv(_parts(long_metrics.select("book_id", "metric", "value"), parts), path)
    else:
        _parts(long_metrics, parts).write.mode("overwrite").parquet(path)


def fixed_values(long_metrics: DataFrame, whole: tuple[str, ...] = ()) -> DataFrame:
    """Metric values as text: four decimals, except those named in ``whole``."""
    text = F.when(F.col("metric").isin(*whole), F.col("value").cast("bigint").cast("string")
                  ).otherwise(fixed4("value")) if whole else fixed4("value")
    return long_metrics.select("book_id", "metric", text.alias("value"))


def _json_text(text: Column) -> Column:
    return F.regexp_replace(F.to_json(F.array(text)), r"^\[|\]\z", "")


def record_json(records: DataFrame) -> Column:
    """JSON of one record; top words are ``[word, count]`` pairs, absent totals are left out."""
    def member(name: str, body: Column) -> Column:
        return F.concat(F.lit(f'"{name}": '), body)

    pairs = F.array_join(F.transform("top_words", lambda w: F.concat(
        F.lit("["), _json_text(w["word"]), F.lit(", "), w["count"].cast("string"), F.lit("]"))), ", ")
    members = [member("book_id", _json_text(F.col("book_id")))]
    for name in ("metadata", "sentiment", "syntactic"):
        members.append(member(name, F.coalesce(F.to_json(name), F.lit("{}"))))
    for name in ("total_word_count", "unique_word_count"):
        members.append(member(name, F.col(name).cast("string")))
    members.append(member("top_words", F.concat(F.lit("["), pairs, F.lit("]"))))
    return F.concat(F.lit("{"), F.concat_ws(", ", *members), F.lit("}"))


def record_lines(records: DataFrame) -> DataFrame:
    """``value`` = ``book_id TAB json``."""
    return records.select(F.concat_ws("\t", "book_id", record_json(records)).alias("value"))


def write_records(records: DataFrame, path: str, fmt: str = "parquet",
                  parts: int | None = None) -> None:
    """Records as Parquet, or as ``book_id TAB json`` lines with ``fmt="jsonl"``."""
    if fmt == "jsonl":
        _parts(record_lines(records), parts).write.mode("overwrite").text(path)
    else:
        _parts(records, parts).write.mode("overwrite").parquet(path)


def summary_json(summary: DataFrame) -> DataFrame:
    """The one-row summary as a pretty JSON document; missing deltas stay as null."""
    return summary.select(F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}
                                    ).alias("value"))


def write_summary(summary: DataFrame, path: str) -> None:
    summary_json(summary).coalesce(1).write.mode("overwrite").text(path)


def write_metadata(metadata: DataFrame, path: str, parts: int | None = None) -> None:
    _parts(metadata, parts).write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_report(report: DataFrame, path: str) -> None:
    """The report as CSV, rows in report order; a report has a handful of rows."""
    (report.repartition(1).sortWithinPartitions("position").drop("position")
     .write.mode("overwrite").csv(path, header=True))
