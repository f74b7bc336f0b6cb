"""Phrase collocations against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosestat.llm import phrases


def pieces(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def plain(rows, longest, least, half, top):
    f, n = {}, Counter()
    for text, lang in rows:
        own = f.setdefault(lang or "und", Counter())
        for words in pieces(text):
            n[lang or "und"] += len(words)
            own.update(tuple(words[i:i + s]) for s in range(1, longest + 1) for i in range(len(words) - s + 1))
    out = []
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in found.items():
            inside = any(len(q) > len(p) and 100 * b >= half * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in found.items())
            if not inside:
                score, k = min((1_000_000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def made(seed, n=120):
    rng = random.Random(seed)
    vocabulary = ["New", "york", "city", "the", "of", "é", "x'y", "\xa0", "Ä", "big-apple", "a", "b"]
    ends = [" ", " ", " ", "\t", ", ", ". ", "\n", "!?", " ; ", "\r"]
    rows = [("".join(rng.choice(vocabulary[: rng.choice([4, 12])]) + rng.choice(ends) for _ in range(rng.randrange(60))), rng.choice(["en", "en", "de", None])) for _ in range(n)]
    return rows + [(None, "en"), ("", None), (" .,\n", "fr"), ("tic tac toe " * 40, "und"), rows[0], rows[0], ("a b " * 3000, "en"), ("New York City. " * 2000, "de")]


@pytest.mark.parametrize("longest,shard_bytes,top", [(3, 8 << 20, None), (3, 500, 7), (2, 2000, None), (5, 700, None)])
def test_collocations_equal_the_plain_version(spark, longest, shard_bytes, top):
    rows = made(longest)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3).withColumns({c: F.lit(1) for c in ("size", "phrase", "n", "a", "rank")})
    got = phrases.collocations(df, longest=longest, least=6, top=top, shard_bytes=shard_bytes).collect()
    assert sorted(map(tuple, got)) == plain(rows, longest, 6, 50, top) and len(got) > 10


@pytest.mark.parametrize("seed", range(6))
def test_index_extends_to_both_sides_as_a_plain_count(seed):
    ids = np.concatenate([[0], np.random.default_rng(seed).integers(0, 5, 300), [seed % 5, 0]])
    whole = {s: Counter(tuple(ids[i:i + s].tolist()) for i in range(len(ids) - s + 1) if (ids[i:i + s] > 0).all()) for s in (1, 2, 3, 4)}
    for path in (["right", "left", "left"], ["left", "right", "right"], ["right", "right", "left"], ["left", "left", "right"]):
        index = phrases.BiIndex(ids, 3, 5)
        word, begin, n = index.words()
        held, places = [(w,) for w in word.tolist()], {"left": begin, "right": begin}
        for size, to in enumerate(path, 2):
            other = "left" if to == "right" else "right"
            number, more, first, second, n = index.extend(to, places[to], places[other], n)
            held = [held[i] + (w,) if to == "right" else (w,) + held[i] for i, w in zip(number.tolist(), more.tolist())]
            places = {to: first, other: second}
            assert dict(zip(held, n.tolist())) == whole[size]


def test_nothing_to_find(spark):
    assert phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), ("a b c", "en")], "text string, lang string")).collect() == []


def test_query_ranks_each_language(spark):
    from prosestat.llm.queries import QUERIES
    rows = QUERIES["op11_phrases"](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r.a >= 10 and r.l >= r.a and r.r >= r.a and r.score == 10**6 * r.a**2 // (r.l * r.r) for r in rows)
