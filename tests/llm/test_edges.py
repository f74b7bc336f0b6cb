"""Odd rows of the operators: nulls, empty and very long texts, repeated rows, empty tables, clashing columns."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from prosestat.llm import chat, language, mixing, quality, secrets, sharding

ONE = F.lit


def test_mixing_of_odd_rows(spark):
    rows = [(1, "a", 10), (2, "a", None), (3, "a", -5), (4, None, 10), (5, "", 10), (6, "b", 10), (6, "b", 10), (None, "a", 10), (7, "zero", 100), (8, "none", 0)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long")
    weight = F.when(F.col("source") == "zero", 0).otherwise(1)
    levels = [mixing.Level("source", F.col("source"), weight)]
    got = mixing.mix(df, levels, F.col("n"), budget=1000, max_epochs=2, seed=1).collect()
    copies = sorted((str(r.doc_id), r.source, r.tokens, r.copies) for r in got)
    # a source without weight gives nothing, whatever is missing; all others give all their epochs
    assert copies == sorted([("1", "a", 10, 2), ("2", "a", 0, 2), ("3", "a", 0, 2), ("4", "", 10, 2), ("5", "", 10, 2), ("6", "b", 10, 2), ("6", "b", 10, 2),
                             ("None", "a", 10, 2), ("7", "zero", 100, 0), ("8", "none", 0, 0)])
    some = mixing.mix(df, levels, F.col("n"), budget=30, max_epochs=1, seed=1).collect()
    assert sum(r.copies * r.tokens for r in some) <= 30 and {r.copies for r in some if r.doc_id == 6} in ({0}, {1})
    assert {r.copies for r in mixing.mix(df, levels, F.col("n"), budget=0, seed=1).collect()} == {0}


def test_shards_of_odd_rows(spark):
    rows = [(i, None if i % 5 == 0 else "" if i % 5 == 1 else "same" * 9 if i % 5 == 2 else f"t{i}", None if i % 7 == 0 else 8 + i % 3) for i in range(400)]
    rows += rows[:40] + [(None, "x", 9), (None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumns({c: F.lit(1) for c in ("key", "shard_", "run", "below")})
    got = sharding.histogram_shards(df, F.col("text"), F.col("doc_id"), F.col("n"), 5, keep=("doc_id", "text")).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(((i, t) for i, t, _ in rows), key=str)
    sums = []
    for s in range(5):
        own = [r for r in got if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        sums.append(sum(r.size or 0 for r in own))
    assert max(sums) - min(sums) < 100


def test_chat_of_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert chat.examples(spark.createDataFrame([], schema)).collect() == []
    rows = [(1, 0, "user", "q"), (1, 0, "user", "q"), (1, 1, "assistant", "x" * 200_000), (2, None, None, None), (2, None, "assistant", None), (3, 0, "user", "only")]
    made = chat.examples(spark.createDataFrame(rows, schema).withColumns({"example": F.lit(9), "loss_start": F.lit(8), "turns": F.lit(7)}))
    got = {r.conv_id: r for r in made.withColumn("read", chat.read_turns(F.col("text"))).where("whole_text").collect()}
    assert {k: [(t.role, t.text) for t in r.read] for k, r in got.items()} == {
        1: [("user", "q")] * 2 + [("assistant", "x" * 200_000)], 2: [("", ""), ("assistant", "")], 3: [("user", "only")]}


def plain_mixture(text, names, model):
    """Proportions by expectation-maximisation over all languages, one letter sequence at a time."""
    found = language.sequences(text)
    shares = np.full(len(names), 1 / len(names))
    for _ in range(60):
        total = np.zeros(len(names))
        for s in found:
            part = shares * np.exp(model[:, s].astype(float))
            total += part / part.sum()
        shares = total / total.sum()
    return dict(zip(names, shares))


def test_language_of_odd_rows_and_against_a_plain_mixture(spark):
    rng = random.Random(1)
    words = {"en": "the and with that this from they have been".split(), "de": "und der die das nicht ist mit von auch".split(), "fr": "les des est pas une dans pour sur avec".split()}
    text = lambda lang, n: " ".join(rng.choice(words[lang]) for _ in range(n))
    rows = [(100 * k + i, text(lang, 30), lang) for k, lang in enumerate(words) for i in range(30)]
    schema = "doc_id long, text string, lang string"
    names, model = language.train(spark.createDataFrame(rows + rows[:5], schema), F.lit(True))
    mixed = [(1, text("en", 50) + " " + text("de", 50)), (2, text("fr", 80) + " " + text("de", 40)), (3, text("en", 20_000)), (4, None), (4, None), (None, "das ist nicht"), (5, "")]
    df = spark.createDataFrame(mixed, "doc_id long, text string").withColumns({"lang": F.lit("xx"), "score": F.lit(2), "languages": F.lit(3)})
    got = language.identify(df, names, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and by[3].languages == ["en"] and by[3].score > 0.99 and by[None].lang_pred == "de" and by[4].lang_pred == by[5].lang_pred == "und"
    for i, t in mixed[:2]:
        shares = plain_mixture(t, names, np.log(model) if model.min() > 0 else model)
        top = sorted(shares, key=shares.get)[-2:]
        assert sorted(by[i].languages) == sorted(top) and by[i].lang_pred == top[-1]
        assert by[i].score == pytest.approx(shares[top[-1]], abs=0.05)
    assert language.identify(df.limit(0), names, model).collect() == []
    none, empty = language.train(spark.createDataFrame([], schema), F.lit(True))
    assert none == [] and {r.lang_pred for r in language.identify(df, none, empty).collect()} == {"und"}


def test_quality_of_odd_rows(spark):
    good = " ".join(f"w{i}" for i in range(60))
    docs = [(1, good, None), (1, good, None), (2, good, "en"), (None, good, "en"), (3, None, "en"), (4, "x " * 300_000, "en")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumn("good", F.lit(5))
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (77, 1)], "doc_id long, quality int")
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in quality.assess(df, labels).collect()), key=str)
    assert got == sorted([(1, 60, True), (1, 60, True), (2, 60, True), (None, 60, True), (3, 0, False), (4, 300_000, False)], key=str)
    assert sorted(str(r.doc_id) for r in quality.passing(df, labels).collect()) == ["1", "1", "2", "None"]


def test_secrets_of_odd_rows(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    rows = [(1, key, 20), (1, key, 20), (None, key, None), (2, None, None), (3, "word " * 100_000 + key, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").withColumn("spans", F.lit(1))
    assert sorted((str(r.doc_id), len(r.spans)) for r in secrets.find(df).collect()) == [("1", 1), ("1", 1), ("2", 0), ("3", 1), ("None", 1)]
    clean = secrets.redact(df).collect()
    assert sorted(str(r.text)[-8:] for r in clean) == ["None"] + ["[SECRET]"] * 4 and {r.spans for r in clean} == {1}
    assert secrets.redact(df.limit(0)).collect() == []
