"""Book metadata from CSV."""

from __future__ import annotations

import csv
import io

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosestat.constants import METADATA_FIELDS
from prosestat.functions.text import is_blank, strip

# Stands in for a field a row does not have; an empty field reads as null.
_ABSENT = "\u0001"
_CSV = {"quote": '"', "escape": '"'}


def parse_metadata_line(line: Column | str) -> Column:
    """Struct of the first four CSV fields, stripped, or null for a shorter line.

    Sentinels are appended so that a missing fourth field differs from an empty one.
    """
    padded = F.concat(strip(line), F.lit(("," + _ABSENT) * 4))
    row = F.from_csv(padded, "book_id string, title string, author string, is_bestseller string", _CSV)
    fields = F.struct(*[F.coalesce(strip(row[name]), F.lit("")).alias(name)
                        for name in ("book_id", "title", "author", "is_bestseller")])
    whole = F.coalesce(row["is_bestseller"], F.lit("")) != _ABSENT
    return F.when(~is_blank(line) & whole, fields)


def is_listing(fields: Column) -> Column:
    """Whether the fields of a metadata line are there and no header."""
    return fields.isNotNull() & (F.lower(fields["book_id"]) != "book_id")


def parse_metadata(lines: DataFrame, column: str = "value") -> DataFrame:
    """``(book_id, title, author, is_bestseller)`` from CSV lines, by position.

    A line whose id field is "book_id", in either case, is a header.
    """
    rows = lines.select(parse_metadata_line(column).alias("m"))
    return rows.where(is_listing(F.col("m"))).select("m.*")


def scan_metadata_lines(spark: SparkSession, path: str) -> DataFrame:
    return parse_metadata(spark.read.text(path, lineSep="\n"))


def scan_csv_records(spark: SparkSession, path: str) -> DataFrame:
    """``(path, block, row, record)`` of CSV files whose quoted fields may hold line ends, read in splits.

    ``(block, row)`` orders the records of a file. Whether a line begins inside
    quotes follows from the number of quote marks before it: counted within its
    split, and carried from split to split over one short row each. A record is a
    line that begins outside, with the lines up to the next such one; these
    meet from two splits if need be. A quote that is never closed makes the rest of
    its file one record. Blank records are left out, as in any CSV reader.
    """
    raw = spark.read.text(path, lineSep="\n", recursiveFileLookup=True)
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("row"), F.regexp_replace("value", r"\r\z", "").alias("line"))
    in_split = Window.partitionBy("path", "block").orderBy("row")
    marks = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    before = F.coalesce(F.sum(marks % 2).over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) % 2
    counted = lines.withColumn("marks", marks).withColumn("inside", before)

    # what a split hands on: its parity, and its last line begun outside quotes for either state it may begin in
    splits = counted.groupBy("path", "block").agg(
        (F.sum("marks") % 2).alias("parity"),
        *[F.max(F.when(F.col("inside") == state, F.col("row"))).alias(f"last_{state}") for state in (0, 1)])
    above = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("carry", F.coalesce(F.sum("parity").over(above), F.lit(0)) % 2)
    last = F.when(F.col("carry") == 0, F.col("last_0")).otherwise(F.col("last_1"))
    last = F.when(last.isNotNull(), F.struct(F.col("block").alias("block"), last.alias("row")))
    splits = splits.withColumn("last", last).select("path", "block", "carry", F.last("last", ignorenulls=True).over(above).alias("open"))

    met = counted.join(splits, ["path", "block"])
    begins = F.when(F.col("inside") == F.col("carry"), F.struct("block", "row"))
    start = F.coalesce(F.last(begins, ignorenulls=True).over(in_split), "open")
    records = met.select("path", start.alias("start"), F.struct("block", "row", "line").alias("l")).groupBy("path", "start").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("l")), lambda x: x["line"]), "\n").alias("record"))
    return records.where(~is_blank("record")).select("path", "start.block", "start.row", "record")


def scan_metadata(spark: SparkSession, path: str, limit: int = 0) -> DataFrame:
    """Metadata by column name, ``filename`` defaulting to ``<book_id>.txt``.

    The first record of each file is its header; the names are those of the first
    file's. ``limit`` > 0 keeps the first rows in file order. Quoted fields may
    hold line ends, and the files are read in splits (``scan_csv_records``).
    """
    records = scan_csv_records(spark, path)
    order = F.struct("block", "row")
    heads = records.groupBy("path").agg(F.min(F.struct(order.alias("start"), "record")).alias("head"))
    first = heads.orderBy("path").first()
    if first is None:
        return spark.createDataFrame([], ", ".join(f"{n} string" for n in (*METADATA_FIELDS, "book_id", "filename")))
    names = next(csv.reader(io.StringIO(first.head.record)))
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))])
    rows = records.join(heads, "path").where(order > F.col("head.start")).select("path", "block", "row", F.from_csv("record", fields.simpleString()[7:-1].replace(":", " "), _CSV).alias("c"))
    if limit > 0:
        rows = rows.orderBy("path", "block", "row").limit(limit)
    found: dict[str, int] = {}
    for i, n in enumerate(names):
        found.setdefault(n.strip(), i)
    column = lambda n: F.col(f"c.c{found[n]}") if n in found else F.lit(None).cast("string")
    made = {"book_id": strip(column("book_id")),
            "filename": F.coalesce(F.nullif(strip(column("filename")), F.lit("")), F.concat(strip(column("book_id")), F.lit(".txt")))}
    return rows.select(*[made.get(n, column(n)).alias(n) for n in dict.fromkeys([*found, "filename"])])
