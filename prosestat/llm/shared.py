"""Helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import os
import re
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.session import shared_folder


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the lineage ends there.

    A lost executor then costs a read, not the steps before. Each call writes a
    new folder, so a repeated run never meets the files of another.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of the batches that go to Python workers, unless the session says otherwise: long texts in batches by number fill an executor.
BATCH_BYTES = 8 << 20
_BATCH_SETTING, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"


def ship(df: DataFrame) -> DataFrame:
    """``df``, ready for Python workers: its session sends batches of ``BATCH_BYTES``, its local workers know this package.

    A cluster's workers have the package installed or by ``--py-files``, like any
    other library; local workers know only the standard path.
    """
    if df.sparkSession.conf.get(_BATCH_SETTING, None) == _BATCH_DEFAULT:
        df.sparkSession.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    context = df.sparkSession.sparkContext
    if re.fullmatch(r"local(\[.*\])?", context.master) and context.applicationId not in _SHIPPED:
        _SHIPPED.add(context.applicationId)
        context.addFile(package, recursive=True)
    return df


_SHIPPED: set[str] = set()


def settled(run):
    """``run`` of a ``mapInArrow``, which at the end of a task gives freed memory back to the system.

    Python workers stay for later tasks; what an idle one keeps is lost to the executor.
    """
    def out(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (AttributeError, OSError):
            pass  # no such call in this C library
    return out


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row, however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def whole(column: str | Column) -> Column:
    """A text column, null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))
