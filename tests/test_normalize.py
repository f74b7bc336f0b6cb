import json

import pytest


from prosestat.operators import cohorts, normalize
from prosestat.sources import sinks


def build(spark, *rows):
    facts = spark.createDataFrame([tuple(r.split(" ", 3)) for r in rows],
                                  "book_id string, component string, metric string, value string")
    return {r.book_id: r.asDict() for r in normalize.build_records(facts).collect()}


def test_totals(spark):
    r = build(spark, "51 wordfreq barn 17", "51 wordfreq oats 8", "51 wordfreq hay 21")["51"]
    assert (r["total_word_count"], r["unique_word_count"]) == (46, 3)
    assert [tuple(w) for w in r["top_words"]] == [("hay", 21), ("barn", 17), ("oats", 8)]


def test_top_twenty(spark):
    r = build(spark, *[f"1 wordfreq {'q' * i} {3 * i}" for i in range(1, 31)])["1"]
    assert [w["count"] for w in r["top_words"]] == list(range(90, 30, -3))
    assert (r["total_word_count"], r["unique_word_count"]) == (3 * 15 * 31, 30)


def test_ties_in_word_order(spark):
    r = build(spark, "1 wordfreq much 3", "1 wordfreq more 3", "1 wordfreq a 1")["1"]
    assert [w["word"] for w in r["top_words"]] == ["more", "much", "a"]


def test_partial_records(spark):
    got = build(spark, "1 sentiment polarity_score 0.5", "2 metadata title A Tale", "3 syntactic fog 1.5",
                "4 other x y", "5 wordfreq a bad", "6 wordfreq a 1")
    assert set(got) == {"1", "2", "3", "4", "5", "6"}
    assert got["1"]["sentiment"] == {"polarity_score": 0.5} and got["1"]["total_word_count"] is None
    assert got["2"]["metadata"] == {"title": "A Tale"} and got["3"]["syntactic"] == {"fog": 1.5}
    for book in ("4", "5"):
        assert got[book]["metadata"] == {} and got[book]["unique_word_count"] is None
    assert got["6"]["sentiment"] == {} and got["6"]["total_word_count"] == 1


def test_bad_values_are_left_out(spark):
    r = build(spark, "1 wordfreq barn seven", "1 wordfreq oats 50", "1 sentiment a x", "1 syntactic b 1d")["1"]
    assert r["total_word_count"] == 50 and r["unique_word_count"] == 1
    assert r["sentiment"] == {} and r["syntactic"] == {}


def test_greatest_text_wins_and_does_not_add_up(spark):
    r = build(spark, "1 sentiment a 2.0", "1 sentiment a 10.0", "1 sentiment a zz", "1 wordfreq w 9",
              "1 wordfreq w 10")["1"]
    assert r["sentiment"] == {"a": 2.0} and r["total_word_count"] == 9


def test_record_lines_round_trip(spark, tmp_path):
    facts = spark.createDataFrame([
        ("7", "metadata", "title", 'Say "hi", [ok]'), ("7", "metadata", "is_bestseller", "1"),
        ("7", "wordfreq", "mr", "8"), ("7", "wordfreq", "café", "9"), ("7", "sentiment", "polarity_score", "0.25"),
        ("8", "syntactic", "fog", "1.5")], "book_id string, component string, metric string, value string")
    records = normalize.build_records(facts)
    sinks.write_records(records, str(tmp_path / "r"), fmt="jsonl")
    parsed = {}
    for r in spark.read.text(str(tmp_path / "r")).collect():
        key, text = r.value.split("\t", 1)
        parsed[key] = json.loads(text)
    assert parsed["7"] == {
        "book_id": "7", "metadata": {"title": 'Say "hi", [ok]', "is_bestseller": "1"},
        "sentiment": {"polarity_score": 0.25}, "syntactic": {}, "total_word_count": 17,
        "unique_word_count": 2, "top_words": [["café", 9], ["mr", 8]]}
    assert parsed["8"] == {"book_id": "8", "metadata": {}, "sentiment": {}, "syntactic": {"fog": 1.5}}
    by_json = cohorts.payloads_from_lines(spark.read.text(str(tmp_path / "r"))).orderBy("book_id").collect()
    direct = cohorts.payloads_from_records(records).orderBy("book_id").collect()
    for a, b in zip(by_json, direct):
        assert a.asDict() == b.asDict()


def test_records_take_two_shuffles(spark, tmp_path):
    facts = spark.createDataFrame([("1", "wordfreq", "a", "3"), ("1", "sentiment", "p", "0.3")],
                                  "book_id string, component string, metric string, value string")
    facts.write.parquet(str(tmp_path / "facts"))
    records = normalize.build_records(spark.read.parquet(str(tmp_path / "facts")))
    records.collect()
    plan = records._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[1]
    assert plan.count("Exchange") == 2 and plan.count("Scan parquet") == 1


@pytest.mark.parametrize("salts", [1, 3, 8])
def test_records_do_not_depend_on_the_parts_of_a_book(spark, salts):
    rows = [("1", "wordfreq", f"w{i}", str(i % 40)) for i in range(200)] + [("1", "wordfreq", "w3", "n/a"), ("1", "wordfreq", "w5", "7")]
    rows += [("2", "wordfreq", "a", "x"), ("3", "metadata", "title", "T"), ("4", "wordfreq", "b", None), (None, "wordfreq", "c", "1"), ("5", "wordfreq", "d", "0")]
    rows += [("1", "sentiment", "p", v) for v in ("2.0", "10.0", "bad")]
    got = {r.book_id: r for r in normalize.build_records(spark.createDataFrame(rows, "book_id string, component string, metric string, value string"), salts).collect()}
    assert set(got) == {"1", "2", "3", "4", "5"} and got["1"].sentiment == {"p": 2.0} and got["3"].metadata == {"title": "T"}
    counts = {f"w{i}": i % 40 for i in range(200)} | {"w5": 7}  # the greater text of two counts
    best = sorted((-n, w) for w, n in counts.items())[:20]
    assert [(w.word, w["count"]) for w in got["1"].top_words] == [(w, -n) for n, w in best]
    assert (got["1"].total_word_count, got["1"].unique_word_count) == (sum(counts.values()), 200)
    assert [(got[b].total_word_count, got[b].unique_word_count, got[b].top_words) for b in ("2", "4")] == [(None, None, None)] * 2
    assert (got["5"].total_word_count, got["5"].unique_word_count) == (0, 1)
