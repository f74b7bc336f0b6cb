import json

import pytest

from prosestat.operators import cohorts as C
from prosestat.operators.report import comparison_report
from prosestat.sources import sinks
from prosestat.sources.records import scan_summary


def line(book, flag, sentiment=(0.1, 10, 5, 100), total=1000, unique=400, syntactic=None):
    names = ("polarity_score", "positive_count", "negative_count", "total_scored_words")
    record = {"book_id": book, "metadata": {"title": "T", "is_bestseller": flag},
              "sentiment": dict(zip(names, sentiment or ())), "total_word_count": total,
              "unique_word_count": unique, "top_words": [["river", 21]]}
    if syntactic:
        record["syntactic"] = syntactic
    return f"{book}\t{json.dumps(record)}"


# Three invented books, the means worked out by hand.
GOLDEN = [line("11", "1", (0.2, 12, 4, 60), 600, 240, {"avg_sentence_length": 14.0}),
          line("12", "1", (-0.1, 6, 9, 40), 400, 200), line("13", "0", (0.3, 7, 2, 30), 300, 90)]


def payloads(spark, lines):
    return C.payloads_from_lines(spark.createDataFrame([(x,) for x in lines], "value string"))


def compared(spark, lines, **kw):
    means = C.cohort_means(C.cohort_totals(payloads(spark, lines)))
    return {r.metric: r.asDict() for r in C.compare(means, **kw).collect()}


COMPARISON = [
    ("polarity_score", 0.05, 0.3, -0.25, "standard_higher"), ("positive_count", 9.0, 7.0, 2.0, "bestseller_higher"),
    ("negative_count", 6.5, 2.0, 4.5, "bestseller_higher"), ("total_scored_words", 50.0, 30.0, 20.0, "bestseller_higher"),
    ("total_word_count", 500.0, 300.0, 200.0, "bestseller_higher"),
    ("unique_word_count", 220.0, 90.0, 130.0, "bestseller_higher"),
    ("type_token_ratio", 0.45, 0.3, 0.15, "bestseller_higher"),
    ("avg_sentence_length", 14.0, None, None, None)]


def test_golden_comparison(spark):
    got = compared(spark, GOLDEN)
    near = lambda x: None if x is None else pytest.approx(x, abs=1e-9)
    for metric, best, standard, delta, direction in COMPARISON:
        r = got[metric]
        assert (r["bestseller_mean"], r["standard_mean"], r["delta"], r["direction"]) == (
            near(best), near(standard), near(delta), direction), metric


def test_two_mean_rules(spark):
    lines = [GOLDEN[0], line("12", "1", None, 400, 200), GOLDEN[2]]
    got = compared(spark, lines)
    assert got["polarity_score"]["bestseller_mean"] == pytest.approx(0.1)
    assert got["avg_sentence_length"]["bestseller_mean"] == pytest.approx(14.0)


REASONS = [
    ("", "empty_line"), (" \t ", "empty_line"), ("nosep", "no_tab_separator"), ("1\tnot json", "malformed_json"),
    ("1\t", "malformed_json"), ('1\t{"a": 1} x', "malformed_json"), ("1\t[1]", "not_a_json_object"),
    ("1\tnull", "not_a_json_object"), ('1\t{"metadata":{"title":"x"}}', "missing_or_invalid_cohort"),
    ('1\t{"metadata":{"is_bestseller":1.0}}', "missing_or_invalid_cohort"),
    ('1\t{"metadata":{"is_bestseller":true}}', "missing_or_invalid_cohort"),
    ('1\t{"metadata":{"is_bestseller":"2"}}', "missing_or_invalid_cohort"),
    ('1\t{"metadata":{"is_bestseller":1}}', None), ('1\t{"metadata":{"is_bestseller":" 0 "}}', None),
    ('1\t{"metadata":{"is_bestseller":"1"},"sentiment":{"polarity_score":NaN}}', None)]


def test_drop_reasons(spark):
    lines = [bad for bad, _ in REASONS]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").coalesce(1)
    assert list(zip(lines, [r.drop_reason for r in C.payloads_from_lines(df).collect()])) == REASONS


def test_counts_of_lines(spark):
    totals = C.cohort_totals(payloads(spark, ["bad\tnot json", GOLDEN[0], "nosep", "", GOLDEN[0]]))
    assert tuple(C.record_counts(totals).first()) == (5, 2, 3)
    assert {r.drop_reason: r.n for r in C.drop_counts(totals).collect()} == {
        "malformed_json": 1, "no_tab_separator": 1, "empty_line": 1}


def test_field_types(spark):
    raw = ('7\t{"book_id": 5.0, "metadata": {"is_bestseller": "1"}, "total_word_count": 10.0, '
           '"unique_word_count": 2.5, "sentiment": {"polarity_score": "0.5", "positive_count": true, "other": 1}, '
           '"syntactic": {"a": 1, "b": "x", "c": null, "d": 2.5}}')
    got = payloads(spark, [raw]).first()
    assert (got.book_id, got.total_word_count, got.unique_word_count, got.type_token_ratio) == ("5", 10, None, None)
    assert (got.polarity_score, got.positive_count, got.syntactic) == (None, 1.0, {"a": 1.0, "d": 2.5})
    again = payloads(spark, ['8\t{"metadata": {"is_bestseller": 0, "is_bestseller": 1, "title": "a"}, "total_word_count": 3, "total_word_count": 4}',
                             '9\t{"metadata": {"is_bestseller": 1, "title": "a"}, "metadata": {"is_bestseller": 0}}']).collect()
    assert [(r.drop_reason, r.cohort, r.title, r.total_word_count) for r in again] == [
        (None, "bestseller", "a", 4), (None, "standard", "", None)]
    ids = ['7\t{"book_id": "", "metadata": {"is_bestseller": 1}}', '7\t{"metadata": {"is_bestseller": 1}}',
           '7\t{"book_id": "5.0", "metadata": {"is_bestseller": 1}}']
    assert [r.book_id for r in payloads(spark, ids).collect()] == ["7", "7", "5.0"]


def test_numbers_that_are_not_finite_and_whole_ones_beyond_doubles(spark):
    raw = ['1\t{"metadata": {"title": "Zero, Infinity: NaN \\\\\\"x\\\"", "is_bestseller": 1}, "syntactic": {"a": -Infinity, "b": [NaN]}}',
           '2\t{"metadata": {"title": "NaN", "is_bestseller": 0}, "total_word_count": 9007199254740993, "unique_word_count": 9223372036854775808}',
           "3\tNaN"]
    a, b, c = payloads(spark, raw).collect()
    assert (a.drop_reason, a.title, a.syntactic) == (None, 'Zero, Infinity: NaN \\"x"', {})
    assert (b.title, b.total_word_count, b.unique_word_count) == ("NaN", 9007199254740993, None)
    assert c.drop_reason == "not_a_json_object"


def test_tie(spark):
    lines = [line("1", "1"), line("2", "0")]
    assert compared(spark, lines)["polarity_score"]["direction"] == "tie"
    near = [line("1", "1", (0.5, 1, 1, 2)), line("2", "0", (0.4, 1, 1, 2))]
    assert compared(spark, near, eps=0.2)["polarity_score"]["direction"] == "tie"


def test_summary_document(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_summary(C.aggregate_cohorts(payloads(spark, GOLDEN + ["x"])), path)
    text = "\n".join(r.value for r in spark.read.text(path).collect())
    doc = json.loads(text)
    assert (doc["input_lines"], doc["books_aggregated"], doc["dropped_lines"]) == (4, 3, 1)
    assert doc["dropped_by_reason"] == {"no_tab_separator": 1}
    best = doc["by_cohort"]["bestseller"]
    assert best["n_books"] == 2 and best["sums"]["total_word_count"] == 1000.0
    assert list(best["means"])[0] == "polarity_score" and list(best["sums"])[0] == "negative_count"
    assert doc["comparison"]["syntactic_mean_deltas"] == {"avg_sentence_length": {"delta": None, "direction": None}}
    back = scan_summary(spark, path).first()
    assert back.by_cohort["standard"]["means"]["type_token_ratio"] == 0.3
    assert back.comparison.direction["type_token_ratio"] == "bestseller_higher"


def test_empty_input(spark):
    doc = json.loads(sinks.summary_json(C.aggregate_cohorts(payloads(spark, ["x"]).where("false"))).first()[0])
    assert doc["input_lines"] == doc["books_aggregated"] == doc["dropped_lines"] == 0
    assert doc["by_cohort"]["standard"] == {
        "cohort": "standard", "n_books": 0, "means": {}, "syntactic_means": {}, "sums": {}}


def test_report(spark, tmp_path):
    means = C.cohort_means(C.cohort_totals(payloads(spark, GOLDEN)))
    report = comparison_report(C.compare(means), 7)
    rows = [tuple(r) for r in report.orderBy("position").collect()]
    assert [r[1] for r in rows] == ["polarity_score", "positive_count", "negative_count", "type_token_ratio",
                                    "unique_word_count", "total_word_count", "total_scored_words"]
    assert rows[3] == (4, "type_token_ratio", "0.4500", "0.3000", "0.1500", "bestseller_higher")
    assert comparison_report(C.compare(means), 0).count() == 1
    only = C.cohort_means(C.cohort_totals(payloads(spark, GOLDEN[:1])))
    assert tuple(comparison_report(C.compare(only), 1).first()) == (
        1, "polarity_score", "0.2000", "NA", "NA", "NA")
    sinks.write_report(report, str(tmp_path / "r"))
    assert spark.read.csv(str(tmp_path / "r"), header=True).first()["metric"] == "polarity_score"
