"""Mixing sources to target weights by a budget that runs down a tree.

The root's token budget is split among the children of each node by weight. A
child never gets more than it can give (its tokens times the epochs allowed);
what it lacks goes to its siblings by weight, and only what a whole family can't
give is missed by its parent, and so goes to the parent's siblings. A leaf's
budget is met by whole epochs of its documents and a prefix of one more: the
documents in the seeded order of that epoch, as long as their tokens fit.

All of it is whole-number arithmetic, so results don't depend on the order of
rows. Null node names count as empty ones; null and negative tokens as none, a
document without tokens follows its place in the order; repeated rows are
documents of their own as long as their keys differ, and share their place and
fate if they don't; an empty table and a budget of zero give no copies.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prosestat.llm.shared import whole, written

#: Hexadecimal digits of a document's place by which a leaf's order is counted before it is sorted.
PREFIX = 4


@dataclass(frozen=True)
class Level:
    """A level of the tree: its name, the node a row belongs to and that node's weight (whole, not negative)."""

    name: str
    node: Column
    weight: Column


def _exact(c: Column) -> Column:
    return c.cast("decimal(19,0)")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _part(total: Column, weight: Column, whole_weight: Column) -> Column:
    """total * weight div whole_weight without overflow or rounding."""
    return _div(_exact(total) * _exact(weight), F.nullif(_exact(whole_weight), F.lit(0)))


def leaf_budgets(supply: DataFrame, levels: Sequence[str], budget: Column) -> DataFrame:
    """The columns of ``supply`` (level names, w_<level>, tokens, capacity) and ``budget`` for each leaf.

    Within a family, children in the order of capacity per weight are filled
    while their capacity is below their share of what is left; the others share
    the rest by weight, cumulatively rounded, so that it adds up exactly.
    """
    tree = supply.withColumn("at_0", budget.cast("long"))
    for depth, level in enumerate(levels):
        path = list(levels[: depth + 1])
        nodes = tree.groupBy(*path).agg(F.max(f"w_{level}").alias("w"), F.sum("capacity").alias("c"), F.max(f"at_{depth}").alias("t"))
        family = Window.partitionBy(*path[:-1]) if depth else Window.partitionBy(F.lit(0))
        by_ratio = family.orderBy((F.col("c") / F.nullif(F.col("w"), F.lit(0))).asc_nulls_last(), level)
        so_far = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
        nodes = nodes.select("*", F.coalesce(F.sum("c").over(so_far), F.lit(0)).alias("c_before"),
                             (F.sum("w").over(family) - F.coalesce(F.sum("w").over(so_far), F.lit(0))).alias("w_left"))
        left = F.greatest(F.col("t") - F.col("c_before"), F.lit(0))
        full = (F.col("w") > 0) & (_exact(F.col("c")) * _exact(F.col("w_left")) <= _exact(F.col("w")) * _exact(left))
        # once one child is not full none after it is
        nodes = nodes.withColumn("open", F.max(F.when(full, 0).otherwise(1)).over(by_ratio.rowsBetween(Window.unboundedPreceding, 0)))
        rest = F.col("t") - F.sum(F.when(F.col("open") == 0, F.col("c")).otherwise(0)).over(family)
        open_w = F.when(F.col("open") == 1, F.col("w")).otherwise(0)
        nodes = nodes.select("*", rest.alias("rest"), F.sum(open_w).over(family).alias("w_open"),
                             F.sum(open_w).over(family.orderBy(level).rowsBetween(Window.unboundedPreceding, 0)).alias("w_to"))
        share = _part(F.col("rest"), F.col("w_to"), F.col("w_open")) - _part(F.col("rest"), F.col("w_to") - F.col("w"), F.col("w_open"))
        given = F.when(F.col("open") == 0, F.col("c")).otherwise(F.coalesce(share, F.lit(0)))
        tree = tree.join(nodes.select(*path, F.least(given, F.col("c")).alias(f"at_{depth + 1}")), path)
    return tree.select(*supply.columns, F.col(f"at_{len(levels)}").alias("budget"))


def place(seed: int, epoch: Column, key: Column) -> Column:
    """Where a document stands in the seeded order of an epoch: hexadecimal digits."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(key.cast("string"), F.lit("null"))))


def mix(df: DataFrame, levels: Sequence[Level], tokens: Column, key: str = "doc_id", budget: int | None = None, budget_percent: int = 100,
        max_epochs: int = 4, seed: int = 1) -> DataFrame:
    """Every row of ``df`` with the level columns, ``tokens`` and ``copies``: how many epochs of its leaf take it.

    ``budget`` is a number of tokens; without one it is ``budget_percent`` of all
    there are. The extra columns replace columns of ``df`` of the same name.

    Leaves are few: their sums, budgets and cuts are small tables. A leaf's order
    is first summed by the leading digits of the places, so a leaf with a third
    of all documents is cut by small groups: only documents whose digits are
    those of a leaf's cut are sorted.
    """
    names = [x.name for x in levels]
    rows = df.withColumns({**{x.name: whole(x.node.cast("string")) for x in levels},
                           "tokens": F.greatest(F.coalesce(tokens.cast("long"), F.lit(0)), F.lit(0))})
    weights = {f"w_{x.name}": F.coalesce(x.weight.cast("long"), F.lit(0)) for x in levels}
    small = rows.select(*names, F.col(key).alias("key_"), "tokens", *[w.alias(n) for n, w in weights.items()])
    supply = small.groupBy(*names).agg(F.sum("tokens").alias("supply"), *[F.max(w).alias(w) for w in weights]).withColumn(
        "capacity", F.col("supply") * max_epochs)
    # with a weight of zero a node gives nothing
    open_leaf = F.lit(True)
    for w in weights:
        open_leaf = open_leaf & (F.col(w) > 0)
    supply = supply.withColumn("capacity", F.when(open_leaf, F.col("capacity")).otherwise(0))
    everything = Window.partitionBy(F.lit(0))
    wanted = F.lit(budget) if budget is not None else _div(F.sum("supply").over(everything) * budget_percent, F.lit(100))
    wanted = F.least(wanted.cast("long"), F.sum("capacity").over(everything))
    supply = supply.withColumn("wanted", wanted)
    leaves = written(leaf_budgets(supply, names, F.col("wanted")).select(
        *names, F.when(F.col("supply") > 0, _div(F.col("budget"), F.col("supply"))).otherwise(0).alias("epochs"),
        F.when(F.col("supply") > 0, F.col("budget") % F.col("supply")).otherwise(0).alias("rest")), "leaves")

    placed = small.select(*names, "key_", "tokens").join(leaves, names).where("rest > 0").withColumn("place", place(seed, F.col("epochs"), F.col("key_")))
    placed = placed.withColumn("lead", F.substring("place", 1, PREFIX))
    sums = placed.groupBy(*names, "lead").agg(F.sum("tokens").alias("sum"), F.max("rest").alias("rest"))
    up_to = F.sum("sum").over(Window.partitionBy(*names).orderBy("lead").rowsBetween(Window.unboundedPreceding, 0))
    cut = sums.withColumn("up_to", up_to).where("up_to > rest").groupBy(*names).agg(F.min(F.struct("lead", (F.col("rest") - F.col("up_to") + F.col("sum")).alias("room"))).alias("cut"))
    edge = placed.join(cut.select(*names, F.col("cut.lead").alias("lead"), F.col("cut.room").alias("room")), [*names, "lead"])
    edge = edge.groupBy(*names, "lead", "place", "room").agg(F.sum("tokens").alias("tokens"))
    running = F.sum("tokens").over(Window.partitionBy(*names, "lead").orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    first_out = edge.withColumn("running", running).where("running > room").groupBy(*names).agg(F.min("place").alias("stop"))
    plan = written(leaves.join(first_out, names, "left"), "mixture")
    # columns of the plan are named by it, as ``df`` may have some of the same names
    own = place(seed, plan["epochs"], rows[key])
    extra = F.when((plan["rest"] > 0) & (plan["stop"].isNull() | (own < plan["stop"])), 1).otherwise(0)
    kept = [rows[c] for c in rows.columns if c != "copies"]
    return rows.join(plan, names).select(*kept, (plan["epochs"] + extra).cast("int").alias("copies"))
