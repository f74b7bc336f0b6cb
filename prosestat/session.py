"""Session settings the jobs are written for."""

from __future__ import annotations

import re
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession


#: Session setting: into how many partitions a table is dealt after it is read.
INPUT_PARTITIONS = "spark.prosestat.inputPartitions"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "prosestat", input_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution (runtime join choice, skew splitting).

    On a cluster leave ``shuffle_partitions`` unset and start high: adaptive
    execution merges small partitions, it cannot split a plain aggregate's.
    ``input_partitions`` is for tables of a single row group, which one task would
    read and measure: ``read_table`` deals their rows out anew. Tables of many row
    groups are split as they are and need none.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if input_partitions:
        builder = builder.config(INPUT_PARTITIONS, str(input_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table, dealt to the session's ``input_partitions`` if it has that setting."""
    df = spark.read.parquet(path)
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def shuffle_partitions(spark: SparkSession) -> int:
    """Partitions for rows that mean much work: adaptive execution merges those of a shuffle by their bytes, but not where their number is given."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else a folder of the warehouse.

    A warehouse on a local disk, as the default one, is refused on a cluster.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    local = re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master)
    if not local and urlsplit(warehouse).scheme in ("", "file"):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return warehouse.rstrip("/") + "/written"
