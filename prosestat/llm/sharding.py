"""Shards of near equal bytes by a histogram sort.

Rows are ordered by a key of hexadecimal digits: the digest of the group's value
and, within a group, of the row's id, so equal texts stand together and a group
larger than a shard can still be parted. Candidate boundaries are prefixes of the
key. A round counts the exact bytes and rows below all of them, across
partitions; boundaries whose place among the bytes isn't within tolerance get
longer prefixes in the next round, inside their own stretch only. Once all
splitters stand, the rows are exchanged once, by small runs between splitters,
and numbered.

Null sizes count as nothing; null texts are a group of their own with the empty
texts; rows with equal keys (repeated rows) stay together and are numbered in
any order; an empty table gives an empty table; further columns named in
``keep`` are carried.
"""

from __future__ import annotations

from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosestat.llm.shared import written

#: Digits of the first round's boundaries, and how many each further round adds.
FIRST, MORE = 3, 2
GROUP_DIGITS, ROW_DIGITS = 16, 16
#: Runs of a shard that are numbered apart.
RUNS = 64


def sort_key(group: Column, row: Column) -> Column:
    """Digits that order rows by group, then by id, both in an even spread."""
    return F.concat(F.substring(F.md5(F.coalesce(group.cast("string"), F.lit(""))), 1, GROUP_DIGITS),
                    F.substring(F.md5(F.coalesce(row.cast("string"), F.lit(""))), 1, ROW_DIGITS))


def splitters(keyed: DataFrame, shards: int, tolerance: float, runs: int = RUNS) -> list[str]:
    """shards * runs - 1 boundaries (ascending key prefixes): a row lies behind those that are at most its key.

    Every ``runs``-th boundary has within ``tolerance`` of a shard's bytes below
    it what it should, or as near as whole rows allow; the ones between have half
    a run's. The driver sees a round's counts: at most 16**FIRST, then 16**MORE
    for each stretch still open.
    """
    digits = GROUP_DIGITS + ROW_DIGITS

    def count(rows: DataFrame, length: int) -> list[tuple[str, int, int]]:
        head = F.substring("key", 1, length).alias("p")
        return sorted(map(tuple, rows.groupBy(head).agg(F.sum("size").cast("long"), F.count("*")).collect()))

    found = count(keyed, FIRST)
    total = sum(size for _, size, _ in found)
    pieces = shards * runs
    targets = [total * i / pieces for i in range(1, pieces)]
    slack = [total / shards * tolerance if i % runs == 0 else total / pieces / 2 for i in range(1, pieces)]
    out: dict[int, str] = {}

    def settle(counts: list[tuple[str, int, int]], below: int, end: str, waiting: list[int], length: int) -> dict[str, tuple[int, str, list[int]]]:
        """Place the boundaries ``waiting`` among ``counts``; returns the stretches to refine."""
        sums = list(accumulate((size for _, size, _ in counts), initial=below))
        starts = [p for p, _, _ in counts] + [end]
        refine: dict[str, tuple[int, str, list[int]]] = {}
        for t in waiting:
            i = max(1, min(bisect_left(sums, targets[t]), len(counts)))
            near = i if abs(sums[i] - targets[t]) <= abs(targets[t] - sums[i - 1]) else i - 1
            if abs(sums[near] - targets[t]) <= slack[t] or length >= digits or counts[i - 1][2] == 1:
                out[t] = starts[near]
            else:
                refine.setdefault(starts[i - 1], (sums[i - 1], starts[i], []))[2].append(t)
        return refine

    open_ = settle(found, 0, "g", list(range(pieces - 1)), FIRST) if found else {}
    length = FIRST
    while open_:
        here, length = length, min(length + MORE, digits)
        by: dict[str, list[tuple[str, int, int]]] = {}
        for row in count(keyed.where(F.substring("key", 1, here).isin(list(open_))), length):
            by.setdefault(row[0][:here], []).append(row)
        nxt: dict[str, tuple[int, str, list[int]]] = {}
        for prefix, (below, end, waiting) in open_.items():
            nxt |= settle(by[prefix], below, end, waiting, length)
        open_ = nxt
    return [out.get(t, "g") for t in range(pieces - 1)]


def histogram_shards(df: DataFrame, group: Column, row: Column, size: Column, shards: int, tolerance: float = 0.001, keep: tuple[str, ...] = ()) -> DataFrame:
    """The columns ``keep`` with ``size``, ``shard`` and ``slot`` (from 0 within the shard, in the order of the key)."""
    spark = df.sparkSession
    rows = df.select(*[df[c] for c in keep], sort_key(group, row).alias("key"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"))
    keyed = written(rows, "shard-keys")
    bounds = splitters(keyed.select("key", "size"), shards, tolerance)
    # A table by the first digits: 16**FIRST rows that hold each boundary once or twice.
    heads = [f"{i:0{FIRST}x}" for i in range(16 ** FIRST)]
    inner: dict[str, list[str]] = {}
    for b in bounds:
        inner.setdefault(b[:FIRST], []).append(b)
    below, table = 0, []
    for h in heads:
        table.append((h, below, inner.get(h, [])))
        below += len(inner.get(h, []))
    schema = T.StructType([T.StructField("head", T.StringType()), T.StructField("below", T.IntegerType()), T.StructField("inner", T.ArrayType(T.StringType()))])
    ladder = F.broadcast(spark.createDataFrame(table, schema))  # 16**FIRST rows and shards * RUNS boundaries, whatever the data
    run = F.col("below") + F.size(F.filter("inner", lambda b: b <= F.col("key")))
    placed = keyed.withColumn("head", F.substring("key", 1, FIRST)).join(ladder, "head", "left").withColumn("run_", run).drop("head", "below", "inner")
    counts = placed.groupBy("run_").agg(F.count("*").alias("n")).withColumn("shard", F.floor(F.col("run_") / RUNS).cast("int"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("shard").orderBy("run_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(counts.select("run_", "shard", before.alias("before")))  # shards * RUNS rows at most
    number = F.row_number().over(Window.partitionBy("run_").orderBy("key"))
    return placed.join(offsets, "run_").select(*keep, "size", "shard", (F.col("before") + number - 1).cast("long").alias("slot"))
