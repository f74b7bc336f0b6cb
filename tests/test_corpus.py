import json

import pytest

from prosestat.operators import normalize
from prosestat.operators.body import bodies_of_lines, body_of_lines, cut_body
from prosestat.operators.sentiment import sentiment_by_book, sentiment_long
from prosestat.operators.syntactic import readability, rounded, syntactic_counts, syntactic_long
from prosestat.operators.wordfreq import word_counts_by_book
from prosestat.plans.corpus import measure_counts, run_corpus, tagged_counts
from prosestat.sources import components, sinks
from prosestat.sources.books import scan_book_lines
from prosestat.sources.lexicon import scan_lexicon
from prosestat.sources.metadata import scan_metadata

from conftest import END, OTHER_END, OTHER_START, SAMPLE, START


def shelf(tmp_path):
    books = tmp_path / "books"
    books.mkdir()
    (books / "1.txt").write_text(f"front\n{START}\n{SAMPLE}\nCheer, cheer and gloom.\n{END}\ntail cheer")
    (books / "two.txt").write_text(f"{OTHER_START}\n{SAMPLE}\n{OTHER_END}\n")
    (books / "3.txt").write_text("no markers, cheer")
    (books / "unlisted.txt").write_text(f"{START}\ncheer\n{END}")
    (tmp_path / "meta.csv").write_text(
        "book_id,title,author,is_bestseller,filename\n1,A,X,1,1.txt\n2,B,Y,0,two.txt\n3,C,Z,0,\n"
        "4,Gone,Z,1,4.txt\n5,No flag,Z,,5.txt\n")
    (tmp_path / "lex.tsv").write_text("cheer\t3\ngloom\t-3\ndawn\t1\nrain\t-2\nno\t-1\n")
    return str(books), str(tmp_path / "meta.csv"), str(tmp_path / "lex.tsv")


def plain(rows):
    return {r.book_id: json.loads(json.dumps(r.asDict(recursive=True), sort_keys=True)) for r in rows}


def test_run(spark, tmp_path):
    paths = shelf(tmp_path)
    run = run_corpus(spark, *paths, output=str(tmp_path / "out"))
    records = plain(run.records.collect())
    assert set(records) == {"1", "2", "3", "4", "5"}
    assert records["1"]["sentiment"] == {"polarity_score": 0.4, "positive_count": 3.0, "negative_count": 2.0,
                                         "total_scored_words": 5.0}
    # A book in the other spelling has syntactic metrics but no words.
    assert records["2"]["syntactic"]["word_count"] == 34.0 and records["2"]["total_word_count"] is None
    assert records["3"]["syntactic"]["word_count"] == 0.0 and records["3"]["sentiment"]["positive_count"] == 0.0
    # A listed book without a file keeps its metadata and counts in its cohort.
    assert records["4"]["sentiment"] == {} and records["4"]["metadata"]["title"] == "Gone"
    summary = run.summary.first()
    assert (summary.input_lines, summary.books_aggregated) == (5, 4)
    assert summary.dropped_by_reason == {"missing_or_invalid_cohort": 1}
    assert summary.by_cohort["bestseller"]["n_books"] == 2
    assert summary.by_cohort["bestseller"]["means"]["positive_count"] == 1.5
    for name in ("wordfreq", "sentiment", "syntactic", "records", "normalized", "summary", "report"):
        assert (tmp_path / "out" / name / "_SUCCESS").exists()


def test_records_equal_those_of_the_facts(spark, tmp_path):
    books_dir, meta_path, lex_path = shelf(tmp_path)
    run = run_corpus(spark, books_dir, meta_path, lex_path)
    ids = spark.createDataFrame([("1.txt", "1"), ("two.txt", "2"), ("3.txt", "3")], "file string, id string")
    texts = spark.read.text(books_dir, wholetext=True).selectExpr("_metadata.file_name file", "value text").join(
        ids, "file").selectExpr("id as book_id", "text")
    strict = cut_body(texts, "strict")
    sentiment = sinks.fixed_values(sentiment_long(sentiment_by_book(strict, scan_lexicon(spark, lex_path))))
    syntactic = sinks.fixed_values(syntactic_long(rounded(readability(syntactic_counts(
        cut_body(texts, "lenient"))))))
    facts = (components.wordfreq_facts(word_counts_by_book(strict))
             .unionByName(components.metric_facts(sentiment, "sentiment"))
             .unionByName(components.metric_facts(syntactic, "syntactic"))
             .unionByName(components.metadata_facts(scan_metadata(spark, meta_path))))
    assert plain(normalize.build_records(facts).collect()) == plain(run.records.collect())


def test_limit_takes_the_first_listed(spark, tmp_path):
    run = run_corpus(spark, *shelf(tmp_path), limit=2)
    assert {r.book_id for r in run.records.collect()} == {"1", "2"}
    assert {r.book_id for r in run.word_counts.select("book_id").distinct().collect()} == {"1"}


def test_books_read_by_line_give_the_same(spark, tmp_path):
    paths = shelf(tmp_path)
    # the second and the last way read some or all books by line for their size
    runs = [run_corpus(spark, *paths, **how) for how in ({"by_line": False}, {"whole_bytes": 200}, {"by_line": True}, {"whole_bytes": 0})]
    records, counts = zip(*[(plain(r.records.collect()), sorted(map(tuple, r.word_counts.collect()))) for r in runs])
    assert all(r == records[0] for r in records) and all(c == counts[0] for c in counts)


@pytest.mark.parametrize("by_line", [False, True])
def test_equal_file_names_in_two_folders(spark, tmp_path, by_line):
    books, meta, lexicon = shelf(tmp_path)
    (tmp_path / "books" / "sub folder").mkdir()
    (tmp_path / "books" / "sub folder" / "1.txt").write_text(f"{START}\nrain\n{END}\n")
    run = run_corpus(spark, books, meta, lexicon, by_line=by_line)
    one = [r for r in run.records.collect() if r.book_id == "1"]
    assert len(one) == 1 and one[0].sentiment["total_scored_words"] == 5.0  # the file in the folder is not listed
    (tmp_path / "meta.csv").write_text('book_id,title,author,is_bestseller,filename\n'
                                       ' 1 ,"A\nB",X,1,1.txt\n6,C,Y,0, sub folder/1.txt \n')
    got = {r.book_id: r for r in run_corpus(spark, books, meta, lexicon, by_line=by_line).records.collect()}
    assert set(got) == {"1", "6"} and got["1"].metadata["title"] == "A\nB"
    assert got["6"].total_word_count == 1 and got["6"].sentiment["polarity_score"] == -2.0


def test_lines_are_read_twice(spark, tmp_path):
    lines = scan_book_lines(spark, shelf(tmp_path)[0])
    for body in (body_of_lines(lines, "strict"), bodies_of_lines(lines)):
        assert body._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 2


def text_scans(df):
    """(files, bytes) of each scan of books that ran for ``df``; listing and lexicon are one file each."""
    df.collect()
    found = []

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name.startswith("Scan text"):
            found.append(tuple(node.metrics().apply(m).value() for m in ("numFiles", "filesSize")))
        for i in range(node.children().size()):
            walk(node.children().apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return [s for s in found if s[0] > 1]


def volumes(tmp_path, n):
    """``n`` books in partition folders, of which the first two are listed first."""
    for i in range(n):
        folder = tmp_path / "books" / f"century={17 + i % 4}" / f"shelf=0{i % 2}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / f"{i} a+b%.txt").write_text(f"{START}\n{SAMPLE}\ncheer {i}\n{END}")
    rows = [f"{i},T{i},A,{i % 2},century={17 + i % 4}/shelf=0{i % 2}/{i} a+b%.txt" for i in range(0, n, 4)]
    (tmp_path / "meta.csv").write_text("\n".join(["book_id,title,author,is_bestseller,filename", *rows, "x,Gone,A,1,gone.txt"]))
    (tmp_path / "lex.tsv").write_text("cheer\t3\nrain\t-2\n")
    return str(tmp_path / "books"), str(tmp_path / "meta.csv"), str(tmp_path / "lex.tsv")


@pytest.mark.parametrize("by_line", [False, True])
def test_only_listed_files_are_opened(spark, tmp_path, by_line):
    sizes = []
    for n in (8, 40):
        (tmp_path / str(n)).mkdir()
        paths = volumes(tmp_path / str(n), n)
        run = run_corpus(spark, *paths, limit=2, by_line=by_line)
        assert {r.book_id: r.total_word_count for r in run.records.collect()} == {"0": 22, "4": 22}
        scans = text_scans(run.records)
        assert scans and all(files == 2 for files, _ in scans)
        sizes.append(sum(size for _, size in scans))
    assert sizes[0] == sizes[1]


@pytest.mark.parametrize("by_line", [False, True])
def test_a_long_listing_opens_the_partition_folders_it_names(spark, tmp_path, by_line):
    paths = volumes(tmp_path, 16)
    want = plain(run_corpus(spark, *paths, by_line=by_line).records.collect())
    assert len(want) == 5 and sum(r["total_word_count"] is not None for r in want.values()) == 4
    for partitions, files in ((("century", "shelf"), 4), ((), 16)):
        run = run_corpus(spark, *paths, by_line=by_line, partitions=partitions, named=0)
        assert plain(run.records.collect()) == want
        scans = [f for f, _ in text_scans(run.records)]
        assert scans and set(scans) == {files}


def test_one_scan_of_the_texts(spark, tmp_path):
    """Whole books are read once for their records, lines twice (markers, lines) for all results of a written run."""
    paths = volumes(tmp_path, 8)
    assert len(text_scans(run_corpus(spark, *paths).records)) == 1
    run = run_corpus(spark, *paths, by_line=True, output=str(tmp_path / "out"))
    assert text_scans(run.word_counts) == []
    assert run.records.count() == 3


def test_words_of_a_book_are_ranked_in_parts(spark):
    words = [(1, f"q{chr(97 + i // 26)}{chr(97 + i % 26)}", 1 + i % 7) for i in range(300)] + [(2, "aa", 3)]
    rows = [(b, " ".join([w] * n), True, b == 1) for b, w, n in words] + [(3, "", True, True), (2, "x", False, True), (None, "lost", True, True)]
    tagged = tagged_counts(spark.createDataFrame(rows, "book_id long, text string, strict boolean, lenient boolean"))
    lexicon = spark.createDataFrame([("qab", 2), ("qac", -1), ("zz", 1)], "term string, score int")
    got = {s: {r.book_id: r for r in measure_counts(tagged, lexicon, s).collect()} for s in (1, 8)}
    assert got[1] == got[8] and set(got[8]) == {1, 2, 3}
    one = got[8][1]
    best = sorted(((-n, w) for _, w, n in words[:300]))[:20]
    assert [(w.word, w["count"]) for w in one.top_words] == [(w, -n) for n, w in best]
    assert (one.total_word_count, one.unique_word_count) == (sum(n for _, _, n in words[:300]), 300)
    assert one.sentiment.total_scored_words == 5 and one.sentiment.positive_count == 2 and one.syntactic.unique_word_count == 300
    assert (got[8][2].total_word_count, got[8][2].syntactic.word_count) == (3, 1) and got[8][3].total_word_count is None
