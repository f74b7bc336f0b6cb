"""The smallest node reachable over links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from prosestat.llm.shared import written


def _stars(pairs: DataFrame, small: bool) -> DataFrame:
    """One star step over (u, v), u > v.

    Large: every larger neighbour of a node links to the node's smallest
    neighbour, itself counted. Small: the same for the smaller neighbours and the
    node itself.
    """
    both = pairs if small else pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
    joined = both.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(least.select("u", F.col("low").alias("v")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return out.where("u > v").distinct()


def smallest_reachable(pairs: DataFrame) -> DataFrame:
    """(node, least) for every node of ``pairs`` (columns x, y, no nulls needed) but those that are the least themselves.

    Each round halves the distance to the least node or better, so rounds grow
    with the logarithm of the longest path. A round's links are written to the
    shared folder; only two sums per round reach the driver.
    """
    now = written(pairs.where("x != y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "links")
    seen = None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("least"))
        seen = mark
        now = written(_stars(_stars(now, small=False), small=True), "links")
