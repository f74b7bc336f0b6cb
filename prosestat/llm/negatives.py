"""Hard negatives by threshold joins over an inverted index with suffix-norm bounds (L2AP style).

Two joins of the anchors with all rows, block by block (``blocks.meet``). The first
finds each anchor's best rows of its own label (positives), the second, for every
score p of a positive, the best rows of other labels with ``low`` percent of p to p.

A block's index holds its rows by groups of dimensions, those with the most weight
first. A row is in the posting list of a group only as far as the length of what is
left of it there times that of the anchor's rest reaches the threshold: the list is
ordered by that length, so any threshold reads the front of it, and dimensions
beyond are covered by the bound. Partial scores add up over the lists; a row whose
partial score and remaining lengths stay below the threshold is pruned; what
survives is scored in full. Thresholds start high and are lowered until the window
(the first ``positives`` rows, the first ``negatives`` of each p) is full or its lower end is
reached, so nothing is cut off. Each block gives at most its first few a window.

Components are floor(scale x) in double precision, scores exact whole numbers.
Higher scores come first, ties to the smaller id. Rows with a null id, label or
vector, a null or non-finite component, or a squared length from 2^62 (whose scores fit
no long) take no part; vectors of different length never meet; rows with the anchor's
id are neither its positives nor negatives; rows equal in id, label and vector are
one, other rows of one id are candidates and anchors of their own. An anchor whose positives score
below zero has no window there; an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosestat.llm.blocks import matrix, meet
from prosestat.llm.shared import written

#: Rows of a block, about; dimensions of a group.
BLOCK_ROWS, GROUP = 8192, 8
#: A positive window starts at this share of the greatest possible score, a negative one at this share of its lowest p; both go down by such steps.
START, STEP, NEAR, NEXT = 0.6, 0.6, 0.96, 0.93
_MOST = float(1 << 62)


class Index:
    """The rows of one block and vector length."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels = ids, labels
        self.order = np.argsort(-(vectors ** 2).sum(0), kind="stable")
        self.vectors = np.ascontiguousarray(vectors[:, self.order])
        self.whole = self.vectors.astype(np.int64)
        self.cuts = [*range(0, vectors.shape[1], GROUP), vectors.shape[1]]
        self.rest = np.stack([self._lengths(self.vectors[:, c:]) for c in self.cuts])
        self.posting = np.argsort(-self.rest, axis=1, kind="stable")
        self.lengths = np.take_along_axis(self.rest, self.posting, 1)

    @staticmethod
    def _lengths(vectors: np.ndarray) -> np.ndarray:
        return np.sqrt((vectors ** 2).sum(-1))

    def asked(self, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A vector in the order of the index, and its remaining lengths at each group."""
        own = vector[self.order]
        return own, np.array([self._lengths(own[c:]) for c in self.cuts])

    def scores(self, own: np.ndarray, length: float, rows: np.ndarray) -> np.ndarray:
        """Exact scores of ``rows``; doubles hold them where no sum can pass 2^53."""
        if length * self.lengths[0][0] < 2 ** 52:
            return np.rint(self.vectors[rows] @ own).astype(np.int64)
        return self.whole[rows] @ own.astype(np.int64)

    def at_least(self, own: np.ndarray, rest: np.ndarray, threshold: float, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, scores) of the ``open_`` rows with a score from ``threshold``; those that reach it, and no other, are looked up in full."""
        alive = open_.copy()
        slack = 1 + 1e-9 * rest[0] * self.lengths[0][0]
        wanted = threshold - slack
        partial, bound = np.zeros(len(alive)), rest[0] * self.rest[0]
        for j, (a, b) in enumerate(zip(self.cuts, self.cuts[1:])):
            rows = self.posting[j]
            if wanted > 0:  # beyond, the rest of a row is covered by the bound
                rows = rows[: np.searchsorted(-self.lengths[j], -wanted / rest[j], side="right")] if rest[j] > 0 else rows[:0]
            rows = rows[alive[rows]]
            if not len(rows):
                break
            partial[rows] += self.vectors[rows, a:b] @ own[a:b]
            bound[rows] = rest[j + 1] * self.rest[j + 1][rows]
            alive[rows] = partial[rows] + bound[rows] >= wanted
        rows = np.flatnonzero(alive & (partial + bound >= wanted))
        found = self.scores(own, rest[0], rows)
        reach = found >= threshold
        return rows[reach], found[reach]

    def first(self, rows: np.ndarray, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
        """The k best as (score, id)."""
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return list(zip(scores[best].tolist(), self.ids[rows[best]].tolist()))

    def positives(self, key: int, label: int, vector: np.ndarray, k: int) -> list[tuple[int, int]]:
        open_ = (self.labels == label) & (self.ids != key)
        k = min(k, int(open_.sum()))
        own, rest = self.asked(vector)
        threshold = START * rest[0] * self.lengths[0][0]
        while k:
            rows, scores = self.at_least(own, rest, threshold, open_)
            if len(rows) >= k:
                return self.first(rows, scores, k)
            threshold = threshold * STEP if threshold > 1 else -np.inf
        return []

    def negatives(self, key: int, label: int, vector: np.ndarray, tops: list[int], low: int, k: int) -> list[tuple[int, int, int]]:
        """(p, score, id): for each p of ``tops`` the k best rows of other labels in its window."""
        open_ = (self.labels != label) & (self.ids != key)
        own, rest = self.asked(vector)
        ends = {p: -(-low * p // 100) for p in tops}
        last, threshold = min(ends.values()), NEAR * min(tops)
        while True:
            threshold = max(threshold, last)
            rows, scores = self.at_least(own, rest, threshold, open_)
            windows = {p: (scores >= e) & (scores <= p) for p, e in ends.items()}
            if threshold <= last or all(w.sum() >= k or threshold <= ends[p] for p, w in windows.items()):
                return [(p, s, i) for p, w in windows.items() for s, i in self.first(rows[w], scores[w], k)]
            threshold *= NEXT


def usable(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, v, size): the rows that take part, components rounded down, as doubles."""
    rows = df.select(df[key].cast("long").alias("id"), df[label].cast("long").alias("label"), df[vector].cast("array<double>").alias("v"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) * scale < 2.0 ** 31))
    rows = rows.where("id is not null and label is not null and v is not null").where(sound)
    rows = rows.select("id", "label", F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("double")).alias("v"))
    return rows.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < _MOST).withColumn("size", F.size("v"))


def _build(held: pa.Table) -> Index:
    """The index of a block, equal rows once."""
    ids, labels = (held.column(c).to_numpy() for c in ("id", "label"))
    vectors = matrix(held, "v", held.column("size")[0].as_py())
    order = np.lexsort((labels, ids))
    ids, labels, vectors = ids[order], labels[order], vectors[order]
    twin = np.flatnonzero((ids[1:] == ids[:-1]) & (labels[1:] == labels[:-1])) + 1
    if len(twin):
        seen, keep = set(), np.ones(len(ids), bool)
        for i in sorted({*twin.tolist(), *(twin - 1).tolist()}):
            own = (ids[i], labels[i], vectors[i].tobytes())
            keep[i] = own not in seen
            seen.add(own)
        ids, labels, vectors = ids[keep], labels[keep], vectors[keep]
    return Index(ids, labels, vectors)


def _batch(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(len(names))], names=names)


def _anchors(batch: pa.RecordBatch):
    """(id, mark, label, vector, tops) of a batch of anchors."""
    ids, marks, labels, tops = (batch.column(c).to_pylist() for c in ("id", "mark", "label", "tops"))
    return zip(ids, marks, labels, matrix(batch, "v", batch.column("size")[0].as_py()), tops)


def hard_negatives(df: DataFrame, is_anchor, key: str = "vec_id", vector: str = "embedding", label: str = "label", scale: int = 256, positives: int = 5,
                   negatives: int = 5, low: int = 80) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score."""
    rows = usable(df, key, vector, label, scale)
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    none = F.lit(None).cast("array<long>").alias("tops")
    # a mark tells apart anchors of one id
    anchors = rows.where(is_anchor(F.col("id"))).dropDuplicates(["id", "label", "v"]).select("id", "label", "v", "size", F.xxhash64("label", "v").alias("mark"))
    held = rows.select("id", "label", "v", "size", F.lit(0).cast("long").alias("mark"), none)
    deal = F.xxhash64("id")

    def near(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        return _batch([(a, m, i, s) for a, m, own, v, _ in _anchors(batch) for s, i in index.positives(a, own, v, positives)], ["anchor", "mark", "positive", "score"])

    def hard(index: Index, batch: pa.RecordBatch) -> pa.RecordBatch:
        return _batch([(a, m, p, i, s) for a, m, own, v, tops in _anchors(batch) for p, s, i in index.negatives(a, own, v, tops, low, negatives)],
                      ["anchor", "mark", "score", "negative_id", "negative_score"])

    met = meet(held, anchors.withColumn("tops", none), blocks, deal, "size", _build, near, "anchor long, mark long, positive long, score long")
    best = Window.partitionBy("anchor", "mark").orderBy(F.desc("score"), "positive")
    good = written(met.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives), "positives")
    tops = good.where("score >= 0").groupBy("anchor", "mark").agg(F.collect_set("score").alias("tops"))
    asked = anchors.join(tops, (anchors["id"] == tops["anchor"]) & (anchors["mark"] == tops["mark"])).select(
        "id", "label", "v", "size", anchors["mark"].alias("mark"), "tops")
    met = meet(held, asked, blocks, deal, "size", _build, hard, "anchor long, mark long, score long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "mark", "score").orderBy(F.desc("negative_score"), "negative_id")
    found = met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return good.join(found, ["anchor", "mark", "score"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score")
