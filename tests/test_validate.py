from prosestat.operators import validate as V

METRICS = ("polarity_score", "positive_count", "negative_count", "total_scored_words")


def tables(spark):
    meta = spark.createDataFrame(
        [("1", "A", "1"), ("2", "B", "0"), ("3", "C", "1"), ("4", "D", "0")],
        "book_id string, title string, is_bestseller string").selectExpr("*", "concat(book_id, '.txt') filename")
    files = spark.createDataFrame([("1.txt", 10), ("2.txt", 30), ("9.txt", 1)], "filename string, size_kb bigint")
    return meta, files


def test_listed_and_present(spark):
    meta, files = tables(spark)
    assert [r.book_id for r in V.present_books(meta, files).orderBy("book_id").collect()] == ["1", "2"]
    assert [r.book_id for r in V.missing_books(meta, files).orderBy("book_id").collect()] == ["3", "4"]
    assert [r.book_id for r in V.book_sizes(meta, files).collect()] == ["2", "1"]
    assert tuple(V.listing_totals(meta, files).first()) == (4, 2, 2)


def test_output_checks_and_gap(spark):
    meta, _ = tables(spark)
    lines = lambda rows: spark.createDataFrame(rows, "book_id string, line string")
    wf = lines([("1", "a\t3"), ("1", "b\tx"), ("1", "c\t 4 "), ("2", "no tab"), ("3", "a\t-1")])
    good = lambda book, p: [(book, f"{m}\t{p if m == METRICS[0] else 1}") for m in METRICS]
    sent = lines(good("1", 0.5) + good("2", 0.2) + good("3", 0.9)[:3] + good("4", "bad"))
    checks = V.validate_outputs(meta, wf, sent)
    got = {r.book_id: (r.wordfreq_ok, r.unique_words, r.sentiment_ok, r.polarity) for r in checks.collect()}
    assert got == {"1": (True, 2, True, 0.5), "2": (False, 0, True, 0.2),
                   "3": (False, 0, False, 0.9), "4": (False, 0, False, 0.0)}
    assert tuple(V.validation_totals(checks).first()) == (4, 3, 2)
    gap = V.polarity_gap(checks).first()
    assert (gap.bestseller_books, gap.standard_books, round(gap.gap, 6), gap.direction) == (
        1, 1, 0.3, "more positive")
    none = V.polarity_gap(checks.where("is_bestseller = '1'")).first()
    assert (none.standard_polarity, none.gap, none.direction) == (0.0, None, None)
