import pytest

from prosestat.functions.body import body_text
from prosestat.operators import syntactic as S

from conftest import END, OTHER_END, OTHER_START, SAMPLE, START


def books(spark, *texts):
    return spark.createDataFrame([(f"b{i}", t) for i, t in enumerate(texts)], "book_id string, text string")


def measure(spark, text):
    df = books(spark, text).withColumn("text", body_text("text", "lenient"))
    return S.readability(S.syntactic_counts(df)).first().asDict()


def test_golden_sample(spark):
    counts = S.syntactic_counts(books(spark, SAMPLE)).first()
    assert (counts.char_count, counts.syllable_count, counts.complex_word_count) == (130, 42, 1)
    got = S.rounded(S.readability(S.syntactic_counts(books(spark, SAMPLE)))).first().asDict()
    assert {k: v for k, v in got.items() if k != "book_id"} == pytest.approx({
        "word_count": 34, "sentence_count": 4, "unique_word_count": 21, "avg_sentence_length": 8.5,
        "avg_word_length": 3.8235, "type_token_ratio": 0.6176, "flesch_reading_ease": 93.7016,
        "flesch_kincaid_grade": 2.3015, "gunning_fog_index": 4.5765}, abs=1e-4)


@pytest.mark.parametrize("start,end", [(START, END), (OTHER_START, OTHER_END)])
def test_marker_lines_are_not_measured(spark, start, end):
    got = measure(spark, f"junk words here.\n{start}\n{SAMPLE}\n{end}\nmore junk.")
    assert (got["word_count"], got["sentence_count"]) == (34, 4)


def test_empty_body_gives_zeros(spark):
    got = measure(spark, f"{START}\n{END}\n")
    assert all(v == 0 for k, v in got.items() if k != "book_id")


def test_complex_words_and_fog(spark):
    counts = S.syntactic_counts(books(spark, "Beautiful animals.")).first()
    assert counts.complex_word_count == 2
    assert measure(spark, f"{START}\nBeautiful animals.")["gunning_fog_index"] == pytest.approx(40.8)


def test_sentences_are_counted_per_line(spark):
    assert measure(spark, f"{START}\none two\nthree four\n\n")["sentence_count"] == 2


def test_shards_add_up(spark):
    lines = SAMPLE.split("\n")
    shards = spark.createDataFrame([("b", line) for line in lines] + [("e", "")],
                                   "book_id string, text string")
    merged = {r.book_id: r.asDict() for r in S.merge_partials(S.syntactic_partials(shards)).collect()}
    whole = S.syntactic_counts(books(spark, SAMPLE)).first().asDict()
    assert {**whole, "book_id": "b"} == merged["b"]
    assert all(v == 0 for k, v in merged["e"].items() if k != "book_id")


def test_long_form(spark):
    long = S.syntactic_long(S.readability(S.syntactic_counts(books(spark, SAMPLE))))
    assert long.count() == 9 and long.columns == ["book_id", "metric", "value"]
