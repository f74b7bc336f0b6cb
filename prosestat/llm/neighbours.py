"""Nearest neighbours by a forest of sorted hash prefixes.

A tree gives each vector a long string of bits, one per random direction: on
which side of the sample's median its projection lies. A block of vectors keeps,
for each tree, its strings as a sorted array. A query descends in all trees to
its longest matching prefixes and takes the vectors there; then all trees ascend
together, a bit at a time, and each level adds the vectors that share one bit
less. Exact distances are taken of every new vector. A query stops once a vector
as near as its k-th best so far would hardly still be unseen: the chance comes
from the query's own place beside each median. No cap stops it earlier; without
that certainty it ascends to the root, where all vectors are candidates.

Vectors are dealt to blocks of about ``BLOCK_ROWS`` by the hash of their id, so a
group of equal vectors is spread evenly; a block's forest is built once, and all
queries stream through it (``blocks.meet``). The few best of each block are merged.

Vectors that are null, zero, or hold a null or a value that isn't finite take no
part; vectors of different length are never compared; a null id takes no part;
equal distances go to the smaller id; rows with one id twice are candidates
twice, but one query (of different vectors the smallest, compared component by
component); an empty table gives an empty result; further columns are left out.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosestat.llm.blocks import matrix, meet

TREES, BITS, SEED = 32, 16, 7
#: Vectors from which medians are taken, at most: those with the smallest hashes of their ids.
SAMPLE = 2048
#: Vectors of one length in the sample from which its medians and spread count; lengths with fewer are searched to the root.
LEAST_SAMPLE = 64
#: Vectors of a block, about; queries looked up at a time.
BLOCK_ROWS, QUERY_ROWS = 8192, 1024
#: Chance left that a vector as near as the k-th best is unseen when a query stops.
MISS = 0.05
_ERFC = np.vectorize(math.erfc)


def directions(size: int) -> np.ndarray:
    """Unit vectors, one per tree and bit, from the seed."""
    d = np.random.default_rng([SEED, size]).standard_normal((TREES * BITS, size))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


@dataclass(frozen=True)
class Fit:
    """Of a sample: the median along each direction, the centre and the mean square distance from it."""

    medians: np.ndarray
    center: np.ndarray
    spread: float


class Forest:
    """The sorted arrays of one block of vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, fit: Fit | None):
        self.ids, self.vectors, self.sampled = ids, vectors, fit is not None
        self.fit = fit or Fit(np.zeros(TREES * BITS), np.zeros(vectors.shape[1]), 1.0)
        self.planes = directions(vectors.shape[1])
        strings = self.strings(vectors @ self.planes.T)
        self.order = np.argsort(strings, axis=0, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, 0)

    def strings(self, projected: np.ndarray) -> np.ndarray:
        """A number of ``BITS`` bits per row and tree, the first direction's bit leading."""
        bits = (projected > self.fit.medians).reshape(len(projected), TREES, BITS)
        return bits @ (1 << np.arange(BITS - 1, -1, -1))

    def same_side(self, vector: np.ndarray, own: np.ndarray, cuts: np.ndarray, distance: float) -> np.ndarray:
        """For each direction the chance that a vector of usual length at ``distance`` lies on the query's side.

        Such a vector is the query, shortened by the cosine between them, and a
        rest in a direction that nothing is known of.
        """
        length = float(((vector - self.fit.center) ** 2).sum())
        along = (self.fit.spread + length - distance ** 2) / (2 * length) if length else 0.0
        rest = math.sqrt(max(self.fit.spread - along ** 2 * length, 1e-12) / len(vector))
        return 1 - 0.5 * _ERFC(np.sign(own - cuts) * (along * own - cuts) / (rest * math.sqrt(2)))

    def search(self, asked: np.ndarray, vectors: np.ndarray, k: int) -> list[list[tuple[float, int]]]:
        """For each query (id, vector) the (distance, id) of the k nearest found but its own, nearest first."""
        projected = vectors @ self.planes.T
        strings = self.strings(projected)
        steps = 1 << np.arange(BITS, -1, -1)  # by depth: how many strings share a prefix
        lows = strings[:, None, :] // steps[:, None] * steps[:, None]
        # (query, depth, tree): where the matches of that prefix begin and end in the tree's array
        begin, end = (np.stack([np.searchsorted(self.sorted[:, t], at[:, :, t]) for t in range(TREES)], axis=2) for at in (lows, lows + steps[:, None]))
        near = self.planes @ self.fit.center
        cuts = (self.fit.medians - near).reshape(TREES, BITS)
        return [self._ascend(*one, cuts, k) for one in zip(asked, vectors, (projected - near).reshape(-1, TREES, BITS), begin, end)]

    def _ascend(self, query: int, vector: np.ndarray, own: np.ndarray, begin: np.ndarray, end: np.ndarray, cuts: np.ndarray, k: int) -> list[tuple[float, int]]:
        """One query's way from its longest prefixes towards the roots, all trees in step."""
        seen = self.ids == query
        found: list[tuple[float, int]] = []
        for depth in range(BITS, -1, -1):
            if (end[depth] - begin[depth]).sum() < k and depth:
                continue  # the longest prefixes with enough matches are further up
            rows = np.concatenate([self.order[a:b, t] for t, (a, b) in enumerate(zip(begin[depth], end[depth]))])
            rows = np.unique(rows[~seen[rows]])
            seen[rows] = True
            if len(rows):
                distances = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(1))
                best = np.lexsort((self.ids[rows], distances))[:k]
                found = sorted(found + list(zip(distances[best].tolist(), self.ids[rows][best].tolist())))[:k]
            if self.sampled and len(found) == k and depth:
                if np.prod(1 - self.same_side(vector, own[:, :depth], cuts[:, :depth], found[-1][0]).prod(axis=1)) <= MISS:
                    break
        return found


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): the rows that take part, with components in double precision."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")).where("id is not null and v is not null")
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(sound & F.exists("v", lambda x: x != 0))


def fits_of(rows: DataFrame) -> dict[int, Fit]:
    """By vector length, what the sample tells; nothing of lengths that it has few of."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).collect()
    by: dict[int, list] = {}
    for r in sample:
        by.setdefault(len(r.v), []).append(r.v)
    out = {}
    for size, v in by.items():
        if len(v) < LEAST_SAMPLE:
            continue
        m = np.array(v)
        out[size] = Fit(np.median(m @ directions(size).T, axis=0), m.mean(0), float(((m - m.mean(0)) ** 2).sum(1).mean()))
    return out


def nearest(df: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 10) -> DataFrame:
    """query_id, rank (from 1), ``key`` and score (Euclidean distance) of the k nearest found of every row where ``is_query``."""
    rows = usable(df, key, vector)
    size = F.size("v").alias("size")
    queries = rows.where(is_query(F.col("id"))).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    fits = fits_of(rows)

    def build(held: pa.Table) -> Forest:
        width = held.column("size")[0].as_py()
        return Forest(held.column("id").to_numpy(), matrix(held, "v", width), fits.get(width))

    def answer(forest: Forest, asked: pa.RecordBatch) -> pa.RecordBatch:
        ids = asked.column("id").to_numpy()
        out: list[tuple[int, float, int]] = []
        for at in range(0, len(ids), QUERY_ROWS):
            some = asked.slice(at, QUERY_ROWS)
            found = forest.search(ids[at: at + QUERY_ROWS], matrix(some, "v", forest.vectors.shape[1]), k)
            out += [(q, d, i) for q, best in zip(ids[at:].tolist(), found) for d, i in best]
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.float64()),
                                           pa.array([x[2] for x in out], pa.int64())], names=["query_id", "score", "hit"])

    met = meet(rows.select("id", "v", size), queries.select("id", "v", size), blocks, F.xxhash64("id"), "size", build, answer,
               "query_id long, score double, hit long")
    order = Window.partitionBy("query_id").orderBy("score", "hit")
    return met.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", F.col("hit").alias(key), "score")
