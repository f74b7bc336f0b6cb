"""Substring dedup against a plain version."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosestat.llm import passages

LAST = (1 << 63) - 1


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def plain(rows, window):
    """(n_words, n_removed, kept) of each row, by all windows in a dictionary."""
    first = {}
    for key, text in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            own = tuple(w[i:i + window])
            first[own] = min(first.get(own, LAST), LAST if key is None else key)
    out = []
    for key, text in rows:
        w = words(text)
        gone = {j for i in range(len(w) - window + 1) if first[tuple(w[i:i + window])] < (LAST if key is None else key) for j in range(i, i + window)}
        out.append((key, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "Ä😀", "\x85x", "\xa0"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    shared = [text(n) for n in (12, 20, 60)]
    rows = [(i, "\n".join([text(rng.randrange(30)), rng.choice(shared), text(rng.randrange(30)), rng.choice(shared)])) for i in range(60)]
    rows += [(i, None) for i in (100, 101)] + [(102, ""), (103, " \t\n"), (104, "a"), (105, "a " * 500), (106, "a " * 300), (107, "b a " * 200), (108, text(4000) + shared[2])]
    rows += [(3, rows[3][1]), (3, shared[2] + " x " + text(9)), (None, shared[0] + " " + shared[1]), (None, shared[0] + " " + shared[1]), (None, None), (-5, shared[1])]
    return rows


@pytest.mark.parametrize("window,hot_least,hot_most", [(12, 4096, 1_000_000), (12, 0, 1_000_000), (12, 5, 100), (3, 4096, 1_000_000), (3, 20, 1_000_000), (1, 0, 1_000_000)])
def test_repeated_windows_go_as_in_the_plain_version(spark, window, hot_least, hot_most):
    rows = made(window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).withColumns({c: F.lit(1) for c in ("id", "digest", "spans", "kept", "bucket")})
    got = [tuple(r) for r in passages.remove(df, window=window, hot_least=hot_least, hot_most=hot_most).collect()]
    want = plain(rows, window)
    assert sorted(got, key=str) == want and 0 < sum(r[2] for r in want) < sum(r[1] for r in want)


def test_windows_of_one_minimiser_make_strings_that_hold_them_all():
    rng = random.Random(2)
    for n in (0, 5, 11, 12, 13, 400):
        w = [f"w{rng.randrange(50)}".encode() for _ in range(n)]
        least, first, end = passages.super_kmers(w, 12, 4)
        assert [i for a, b in zip(first, end) for i in range(a, b)] == list(range(max(0, n - 11)))
        assert all(least[1:] != least[:-1])
        plain_least = [min(passages._over(np.fromiter(map(passages.xxhash.xxh64_intdigest, w[i:i + 12]), np.uint64), 4)) for i in range(max(0, n - 11))]
        assert [m for m, a, b in zip(least, first, end) for _ in range(a, b)] == plain_least


def test_empty_and_other_keys(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert passages.remove(df).collect() == []
    odd = spark.createDataFrame([(2, "a b c"), (1, "x a b c y")], "n int, body string")
    assert sorted(map(tuple, passages.remove(odd, "n", "body", 3).collect())) == [(1, 5, 0, "x a b c y"), (2, 3, 3, "")]


def test_query_counts_what_goes(spark):
    from prosestat.llm.queries import QUERIES
    rows = QUERIES["op13_passages"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(0 <= r.n_removed <= r.n_words for r in rows) and sum(r.n_removed for r in rows) > 0
