"""Book texts and the inventory of book files.

A scan opens all files below a folder, or only those of a ``Selection``: ``named``
ones (a bounded list, part of the plan), or those ``listed`` in a table of any size.
The table is joined; where the files lie in ``key=value`` folders whose keys are in
``partitions``, and the folders with a listed file are few enough to be named,
files in others are not opened. Nor are those outside the bounds of size.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.functions.paths import file_name, path_below, path_book_id, plain_path, stem_book_id

#: Files that a plan names, at most.
NAMED_FILES = 10_000


def _book_id(id_from: str) -> Column:
    return {"path": path_book_id, "stem": stem_book_id}[id_from]("path")


class Selection(NamedTuple):
    """Which files of a folder to open, told by their paths below it."""
    named: list[str] | None = None
    listed: DataFrame | None = None  # its column filename
    partitions: tuple[str, ...] = ()  # outermost first
    folders: list[str] | None = None  # their values, joined by _BETWEEN
    over: int | None = None  # only files of more bytes
    up_to: int | None = None  # only files of as many bytes at most


_BETWEEN = "\0"


def selection(listing: DataFrame, most: int = NAMED_FILES, partitions: tuple[str, ...] = (), most_folders: int = NAMED_FILES) -> Selection:
    """The files in ``listing.filename``: by name if there are ``most`` or fewer, else by a join.

    With a join, up to ``most_folders`` partition folders that list a file are named in the plan.
    """
    names = listing.select("filename").where(F.length("filename") > 0).distinct()
    rows = names.limit(most + 1).collect()
    if len(rows) <= most:
        return Selection([r.filename for r in rows])
    folders = None
    if partitions:
        found = names.select(F.concat_ws(_BETWEEN, *map(_folder, partitions)).alias("f")).distinct().limit(most_folders + 1).collect()
        folders = [r.f for r in found] if len(found) <= most_folders else None
    return Selection(None, names, partitions, folders)


def _folder(partition: str) -> Column:
    """The value of a partition folder in a file name."""
    value = F.regexp_extract("filename", f"(?:^|/){re.escape(partition)}=([^/]*)/", 1)
    return F.url_decode(F.replace(value, F.lit("+"), F.lit("%2B")))


#: Session setting: tasks that list folders, at most.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Folders are listed by a few tasks a core, where the session does not say how many; else each has a task of its own, which takes far longer than its listing."""
    if spark.conf.get(LISTING_TASKS, None) is not None:
        yield
        return
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.unset(LISTING_TASKS)


def _scan(spark: SparkSession, path: str, kind: str, schema: str, pattern: str, files: Selection, **options) -> DataFrame:
    """The columns of ``schema`` with ``_path`` and ``_block`` (the split's offset) of the files of a selection."""
    reader = spark.read.format(kind).options(pathGlobFilter=pattern, **options)
    with few_listing_tasks(spark):
        if files.partitions:
            # given as text, so that a folder's name stays what it is
            columns = ", ".join([schema, *[f"`{p}` string" for p in files.partitions]])
            raw = reader.schema(columns).option("basePath", path).load(path)
        else:
            raw = reader.option("recursiveFileLookup", "true").load(path)
    below = path_below(plain_path("_metadata.file_path"), path)
    if files.named is not None:
        # a predicate on the file's name alone: files that fail it are not opened
        raw = raw.where(below.isin(files.named) if files.named else F.lit(False))
    if files.folders is not None:
        raw = raw.where(F.concat_ws(_BETWEEN, *[F.col(p) for p in files.partitions]).isin(files.folders) if files.folders else F.lit(False))
    if files.over is not None:
        raw = raw.where(F.col("_metadata.file_size") > files.over)
    if files.up_to is not None:
        raw = raw.where(F.col("_metadata.file_size") <= files.up_to)
    block = F.col("_metadata.file_block_start") if kind == "text" else F.lit(0)
    rows = raw.select("*", plain_path("_metadata.file_path").alias("_path"), block.alias("_block"), below.alias("filename"))
    if files.listed is not None:
        rows = rows.join(files.listed, "filename", "left_semi")
    return rows.drop("filename", *files.partitions)


def scan_books(spark: SparkSession, path: str, id_from: str = "stem", pattern: str = "*.txt",
               files: Selection = Selection()) -> DataFrame:
    """``(book_id, path, text)``, one row per file; a book must fit in one row, see ``scan_book_lines``.

    Names that aren't there give no row. Bytes that are not UTF-8 decode to
    replacement characters, the book is kept.
    """
    raw = _scan(spark, path, "text", "value string", pattern, files, wholetext="true")
    return (raw.select(F.col("_path").alias("path"), F.col("value").alias("text"))
            .select(_book_id(id_from).alias("book_id"), "path", "text"))


def scan_book_lines(spark: SparkSession, path: str, id_from: str = "stem", pattern: str = "*.txt",
                    files: Selection = Selection()) -> DataFrame:
    """``(book_id, path, position, text)``, one row per line, for books of any size.

    Files are read in splits, so one huge book is shared by many tasks.
    ``position`` orders the lines of a file: split offset, then row within the
    task that read it. Cut the body with ``operators.body.body_of_lines``.
    """
    raw = _scan(spark, path, "text", "value string", pattern, files, lineSep="\n")
    return (raw.select(
                F.col("_path").alias("path"),
                F.struct(F.col("_block").alias("block"), F.monotonically_increasing_id().alias("row")).alias("position"),
                F.col("value").alias("text"))
            .select(_book_id(id_from).alias("book_id"), "path", "position", "text"))


def scan_inventory(spark: SparkSession, path: str, pattern: str = "*.txt", files: Selection = Selection()) -> DataFrame:
    """``(filename, path, size_kb)`` of the files present; contents are not read."""
    found = _scan(spark, path, "binaryFile", "path string, modificationTime timestamp, length bigint, content binary", pattern, files)
    return found.select(file_name("path").alias("filename"), "path", F.floor(F.col("length") / 1024).cast("bigint").alias("size_kb"))
