"""Hard negatives against all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosestat.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every, k=5, low=80):
    sound = {(i, n, tuple(math.floor(256 * x) for x in v)) for i, v, n in rows
             if i is not None and v is not None and n is not None and all(x is not None and math.isfinite(x) for x in v)}
    sound = [r for r in sound if sum(x * x for x in r[2]) < 2 ** 62]
    out = []
    for i, n, v in sound:
        if i % every:
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), j, m) for j, m, w in sound if j != i and len(w) == len(v)]
        for p, j, _ in sorted(r for r in scored if r[2] == n)[:k]:
            found = sorted(r for r in scored if r[2] != n and low * -p <= 100 * -r[0] <= 100 * -p)[:k]
            out += [(i, j, rank, m, -p, -s) for rank, (s, m, _) in enumerate(found, 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit(1) for c in ("id", "v", "size", "mark", "part_", "score")})
    return sorted(map(tuple, negatives.hard_negatives(df, lambda i: i % every == 0, **more).collect()))


@pytest.mark.parametrize("seed,size,scale", [(1, 24, 0.2), (2, 3, 1.0), (3, 9, 300.0)])
def test_negatives_equal_all_pairs(spark, seed, size, scale):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, size))
    rows = [(i, (scale * (centres[i % 4] * rng.random() + rng.standard_normal(size))).tolist(), int(rng.integers(0, 3))) for i in range(500)]
    rows += [(1000 + i, rows[0][1], i % 3) for i in range(60)]  # ties
    rows += [rows[0], rows[0], (0, rows[5][1], 1), (0, rows[5][1], 2), (10, rows[7][1], 0)]  # repeated rows, several rows of one id
    got = mined(spark, rows, 10)
    assert got == plain(rows, 10) and len(got) > 200
    assert mined(spark, rows, 50, positives=2, negatives=3, low=95) == plain_with(rows, 50)


def plain_with(rows, every):
    out = plain(rows, every, 5, 95)
    tops = {}
    for r in plain_positives(rows, every):
        tops.setdefault(r[:2], []).append(r[2:])
    kept = {(a, p, s) for (a, _), found in tops.items() for s, p in sorted(found, key=lambda x: (-x[0], x[1]))[:2]}
    return [r for r in out if r[2] <= 3 and (r[0], r[1], r[4]) in kept]


def plain_positives(rows, every):
    sound = {(i, n, tuple(math.floor(256 * x) for x in v)) for i, v, n in rows}
    return [(i, (n, v), sum(a * b for a, b in zip(v, w)), j) for i, n, v in sound if i % every == 0 for j, m, w in sound if j != i and m == n]


def test_odd_vectors_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0], 1), (1, [1.0, 1.5], 1), (2, [1.0, 1.4], 2), (3, [0.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, 2.0], None), (None, [1.0, 2.0], 2),
            (7, [nan, 1.0], 2), (8, [inf, 1.0], 2), (9, [None, 1.0], 2), (10, [1e300, 0.0], 2), (11, [1.0], 2), (12, [], 1), (13, [], 2), (14, [], 1),
            (15, [-1.0, -2.0], 1), (16, [1.6e7, 1.6e7], 1), (17, [1.5e7, 1.6e7], 2), (18, [8e6, 8e6], 1)]
    assert mined(spark, rows, 1) == plain(rows, 1) != []
    assert negatives.hard_negatives(spark.createDataFrame([], SCHEMA), lambda i: i > 0).collect() == []


def test_index_finds_what_reaches_the_threshold():
    rng = np.random.default_rng(5)
    vectors = np.floor(40 * rng.standard_normal((700, 30)) * np.linspace(3, 0.05, 30))
    index = negatives.Index(np.arange(700), np.zeros(700, np.int64), vectors)
    for q in vectors[:20]:
        own, rest = index.asked(q)
        scores = vectors @ q
        for threshold in (scores.max(), np.sort(scores)[-20], 100, 0, -5000, -np.inf):
            rows, found = index.at_least(own, rest, threshold, np.arange(700) % 3 > 0)
            want = [i for i in range(700) if i % 3 and scores[i] >= threshold]
            assert rows.tolist() == want and found.tolist() == scores[want].tolist()


def test_query(spark):
    from prosestat.llm.queries import QUERIES
    rows = QUERIES["op12_negatives"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(80 * r.positive_score <= 100 * r.negative_score <= 100 * r.positive_score and 1 <= r["rank"] <= 5 for r in rows)
