import random
from collections import Counter

import pytest

from prosestat.constants import FREQUENCY_STOPWORDS
from prosestat.operators import sentiment as S
from prosestat.operators import wordfreq as W


@pytest.fixture(scope="module")
def shelf(spark):
    rng = random.Random(5)
    words = ["love", "hate", "the", "a", "tree", "x", "of", "river", "stone", "no", "blue"]
    rows = [(f"b{i % 9}", " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))) for i in range(30)]
    rows.append(("empty", ""))
    rows.append(("huge", "love " * 5000 + "tree"))
    return rows


def expected_counts(rows):
    counts = {}
    for book, text in rows:
        kept = [w for w in text.split() if len(w) > 1 and w not in FREQUENCY_STOPWORDS]
        counts.setdefault(book, Counter()).update(kept)
    return counts


def frame(spark, rows):
    return spark.createDataFrame(rows, "book_id string, text string")


def test_counts_by_book_and_corpus(spark, shelf):
    df, want = frame(spark, shelf), expected_counts(shelf)
    by_book = {(r.book_id, r.word): r.n for r in W.word_counts_by_book(df).collect()}
    assert by_book == {(b, w): n for b, c in want.items() for w, n in c.items()}
    corpus = {r.word: r.n for r in W.word_counts(df).collect()}
    assert corpus == dict(sum(want.values(), Counter()))
    merged = W.merge_word_counts(W.word_counts_by_book(df))
    assert {r.word: r.n for r in merged.collect()} == corpus


def test_top_words_ties(spark):
    rows = [("b", " ".join(f"z{chr(97 + i)}" for i in range(25)) + " much more much more")]
    df = frame(spark, rows)
    top = W.top_words_by_book(W.word_counts_by_book(df)).orderBy("rank").collect()
    assert [r.word for r in top] == ["more", "much"] + [f"z{chr(97 + i)}" for i in range(18)]
    corpus = W.top_corpus_words(W.word_counts(df), 3).collect()
    assert [r.word for r in corpus] == ["much", "more", "zy"]


def test_profiles_equal_window_ranking(spark, shelf):
    one_row = {}
    for book, text in shelf:
        one_row[book] = (one_row.get(book, "") + " " + text).strip()
    df = frame(spark, list(one_row.items()))
    ranked = {}
    for r in W.top_words_by_book(W.word_counts_by_book(df)).orderBy("book_id", "rank").collect():
        ranked.setdefault(r.book_id, []).append((r.word, r.n))
    want = expected_counts(shelf)
    for r in W.word_profiles(df).collect():
        if not want[r.book_id]:
            assert (r.total_word_count, r.unique_word_count, r.top_words) == (None, None, None)
            continue
        assert [tuple(w) for w in r.top_words] == ranked[r.book_id]
        assert r.total_word_count == sum(want[r.book_id].values())
        assert r.unique_word_count == len(want[r.book_id])


def lexicon(spark):
    return spark.createDataFrame(
        [("love", 3), ("hate", -4), ("stone", 0), ("no", -1), ("blue sky", 2)], "term string, score int")


def test_sentiment(spark, shelf):
    got = {r.book_id: r for r in S.sentiment_by_book(frame(spark, shelf), lexicon(spark)).collect()}
    want = expected_counts(shelf)
    assert set(got) == set(want)
    for book, counts in want.items():
        love, hate, zero = counts["love"], counts["hate"], counts["stone"]
        scored = love + hate + zero
        r = got[book]
        assert (r.positive_count, r.negative_count, r.total_scored_words) == (love, hate, scored)
        assert r.polarity_score == pytest.approx((3 * love - 4 * hate) / scored if scored else 0.0)


def test_repeated_and_null_terms_have_one_answer(spark):
    book = spark.createDataFrame([("b", "fine odd pair")], "book_id string, text string")
    lex = spark.createDataFrame([("fine", 1), ("odd", None), ("pair", 1), ("pair", 2)], "term string, score int")
    for bound in ("-1", "10m"):  # shuffled and broadcast
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)
        r = S.sentiment_by_book(book, lex).first()
        assert (r.polarity_score, r.positive_count, r.total_scored_words) == (1.5, 2, 2)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_metric_sums_add_polarity_too(spark):
    rows = spark.createDataFrame([("a", 0.5, 2.0, 1.0, 3.0), ("b", 0.25, 1.0, 0.0, 1.0)],
                                 "book_id string, polarity_score double, positive_count double, "
                                 "negative_count double, total_scored_words double")
    sums = {r.metric: r.value for r in S.sum_by_metric(S.sentiment_long(rows)).collect()}
    assert sums == {"polarity_score": 0.75, "positive_count": 3.0, "negative_count": 1.0,
                    "total_scored_words": 4.0}
