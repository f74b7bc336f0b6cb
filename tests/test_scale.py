"""Plans and layouts that decide how the jobs grow."""

import random
from collections import Counter

from pyspark.sql import functions as F

from prosestat.constants import ABBREVIATIONS, COMPLEX_SYLLABLES
from prosestat.functions import text
from prosestat.functions.numbers import as_int
from prosestat.functions.paths import plain_path
from prosestat.functions.text import strip
from prosestat.operators import wordfreq
from prosestat.plans import corpus
from prosestat.sources import books, components, sinks

from conftest import END, START


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lines_are_scanned_once(spark, tmp_path):
    """one scan for the rules of all components, not one each."""
    rows = [("7", "wordfreq", " a\t3 "), ("7", "wordfreq", "a\t3.5"), ("7", "wordfreq", "a b"), ("7", "sentiment", "p\t 0.5　"),
            ("7", "syntactic", "7\tx\t1e2"), ("7", "syntactic", "x\ty\tz\t1"), ("7", "syntactic", "x\tlow"), ("u", "metadata", "9,T,,1"),
            ("u", "metadata", "Book_ID,title,author,is_bestseller"), ("u", "metadata", "9,T"), ("u", "other", "a\t1"), (None, "wordfreq", "a\t1"), ("7", "wordfreq", None)]
    lines = spark.createDataFrame(rows, "book_id string, component string, line string")
    lines.write.parquet(str(tmp_path / "lines"))
    facts = components.facts_from_lines(spark.read.parquet(str(tmp_path / "lines")))
    assert plan_of(facts).count("FileScan") == 1
    assert sorted(map(tuple, facts.collect())) == [
        ("7", "sentiment", "p", "0.5"), ("7", "syntactic", "x", "1e2"), ("7", "wordfreq", "a", "3"),
        ("9", "metadata", "is_bestseller", "1"), ("9", "metadata", "title", "T")]


def test_strip_keeps_what_the_pattern_kept(spark):
    white = "".join(chr(c) for c in range(0x3100) if chr(c).isspace()) + "​᠎﻿\x00"
    texts = [c + " x" + c + "y " + c for c in white] + ["", " ", None, "\t \n", "a", "　"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pattern = F.regexp_replace("t", r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+\z", "")
    assert df.where(~strip("t").eqNullSafe(pattern)).count() == 0
    broken = spark.range(1).select(strip(F.unhex(F.lit("20FF6120")).cast("string")).alias("t"))
    assert broken.first().t == "�a"


def test_whole_numbers_as_the_cast_takes_them(spark):
    texts = ["5", "+5", "-05", " 5\t", "\x005\x1f", "5\x7f", "5.0", "", "many", "1_0", " 5", "9223372036854775808", "- 5", None, "5\n", "1e3", "\x855"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    odd = F.contains("t", F.lit("_")) | (F.octet_length("t") != F.length("t"))
    was = F.coalesce(F.col("t").try_cast("bigint"), F.when(
        odd & F.rlike(strip("t"), F.lit(r"^[+-]?[0-9]+(?:_[0-9]+)*\z")), F.replace(strip("t"), F.lit("_"), F.lit(""))).try_cast("bigint"))
    assert df.where(~as_int("t").eqNullSafe(was)).count() == 0


def test_plain_path_decodes_only_escapes(evaluate):
    assert evaluate(["file:/a+b/c", "file:/a%20b+c", None], plain_path) == ["file:/a+b/c", "file:/a b+c", None]


def test_partial_counts_add_up_in_the_range_shuffle(spark, tmp_path):
    """counting and ranging are one shuffle, over partial counts that are not grouped before."""
    books = spark.createDataFrame([(1, "stone river stone"), (2, "river"), (1, "stone"), (None, "river river"), (3, ""), (4, None)], "book_id long, text string")
    counts = wordfreq.word_counts_by_book(books, partial=True)
    assert "Exchange" not in plan_of(counts)
    path = str(tmp_path / "counts")
    for held in (False, True):
        sinks.write_word_counts(counts, path, held=held)
        got = spark.read.parquet(path)
        assert got.columns == ["book_id", "word", "n"]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            map(tuple, wordfreq.word_counts_by_book(books).collect()), key=str) == sorted(
            [(1, "stone", 3), (1, "river", 1), (2, "river", 1), (None, "river", 2)], key=str)
    assert [p.name for p in tmp_path.iterdir()] == ["counts"]


def test_texts_are_measured_once(spark, tmp_path):
    """F8: a pattern for each measure, and none once more in a filter that the optimizer infers; no sorted words for the counters."""
    spark.createDataFrame([(1, "The stone rolled. A river e.g. here.\nStone by stone!"), (2, ""), (3, None)], "book_id long, text string").write.parquet(str(tmp_path / "books"))
    lexicon = spark.createDataFrame([("stone", 2), ("river", -1)], "term string, score int")
    measured = corpus.measure_books(spark.read.parquet(str(tmp_path / "books")), lexicon, "none")
    plan = plan_of(measured)
    # words, runs, words of the metrics, sentences, vowels, silent e's, words without vowels, complex words
    assert (plan.count("regexp_extract_all"), plan.count("sort_array("), plan.count("split("), plan.count("size(concat(")) == (8, 2, 0, 0)
    got = {r.book_id: r for r in measured.collect()}
    assert [(w.word, w["count"]) for w in got[1].top_words] == [("stone", 3), ("here", 1), ("river", 1), ("rolled", 1)]
    assert (got[1].syntactic.sentence_count, got[1].syntactic.word_count, got[1].sentiment.polarity_score) == (3, 11, 1.25)
    assert (got[2].top_words, got[3].syntactic.word_count) == (None, 0)


def test_line_measures_equal_those_of_its_words(spark):
    """F8: syllables and complex words counted in a line of words, sentences between gaps, as word by word and piece by piece."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abeeit'y") for _ in range(rng.randrange(1, 9))).strip("'") or "e" for _ in range(3000)]
    lines = [words[i:i + 6] for i in range(0, 3000, 6)] + [[], ["the"], ["he"], ["e"], ["hmm", "the", "be"], ["a" * 5000, "b" * 5000] * 50]
    df = spark.createDataFrame([(line,) for line in lines], "w array<string>")
    each = F.transform("w", text.syllables)
    total = lambda value: F.aggregate(each, F.lit(0).cast("bigint"), lambda a, s: a + value(s))
    line = text.line_of(F.col("w"))
    assert df.where((text.syllables_of_line(line) != total(lambda s: s)) | (text.complex_words_of_line(line) != total(lambda s: (s >= COMPLEX_SYLLABLES).cast("int")))).count() == 0
    signs = [*"ab .!?\n\r\t", " ", "\x1c", " ", "\u0001", "é", "😀", *ABBREVIATIONS, "e.", "Mr", "U."]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(25))) for _ in range(4000)] + [". " * 100000, "\n" * 100000, "Mr. " * 1000, None]
    pieces = spark.createDataFrame([(t,) for t in texts], "t string")
    assert pieces.where(~text.sentence_count("t").eqNullSafe(F.array_size(text.sentences("t")).cast("bigint"))).count() == 0


def test_runs_and_ranks_of_repeated_words(spark):
    """F8: counts of a row's words without positions, ranks with and without enough repeated words."""
    rng = random.Random(9)
    rows = [[rng.choice(["ab", "abc", "b'c", "b", "zz"] + [f"w{chr(97 + i)}" for i in range(k)]) for _ in range(n)] for k in (0, 5, 26) for n in (0, 1, 9, 40, 400)] + [["a"] * 200000]
    df = spark.createDataFrame([(row,) for row in rows], "w array<string>").select(text.word_runs(F.col("w")).alias("r"))
    got = df.select("r", wordfreq.profile_of(F.col("r")).alias("p")).collect()
    for row, found in zip(rows, got):
        counts = Counter(row)
        assert [tuple(r) for r in found.r] == sorted(counts.items())
        top = sorted(counts.items(), key=lambda c: (-c[1], c[0]))[:20]
        assert [(t.word, t["count"]) for t in found.p.top_words or []] == top
        assert (found.p.total_word_count, found.p.unique_word_count) == ((len(row), len(counts)) if row else (None, None))


def test_words_of_lines_are_one_row_each(spark):
    """F1, records_by_line: a word has one row for both bodies, a counter one of its own; nothing but equal words is brought together."""
    rows = [(1, "The stone's stone, x1 naïve it's a", True, True), (1, "stone here. There", False, True), (1, "Stone two", True, False), (2, "", True, True), (3, "q", True, False)]
    tagged = corpus.tagged_counts(spark.createDataFrame(rows, "book_id long, text string, strict boolean, lenient boolean"))
    assert tagged.columns == ["book_id", "word", "n", "m"] and plan_of(tagged).count("Exchange") == 1
    got = {(r.book_id, r.word): (r.n, r.m) for r in tagged.collect()}
    counters = {k: v for k, v in got.items() if k[1].startswith("\0")}
    assert {w: m for (b, w), (n, m) in counters.items() if b == 1} == {"\0sentence_count": 3, "\0word_count": 8, "\0char_count": 34, "\0syllable_count": 9, "\0complex_word_count": 0}
    assert {m for (b, _), (_, m) in counters.items() if b == 2} == {0} and {m for (b, _), (_, m) in counters.items() if b == 3} == {None}
    # the letters of a word beside others are content words, but not in the vocabulary, and the other way round
    assert {k[1]: v for k, v in got.items() if k[0] == 1 and k not in counters} == {
        "stone": (3, 2), "stone's": (None, 1), "na": (1, None), "ve": (1, None), "it's": (None, 1), "here": (None, 1), "there": (None, 1), "two": (1, None)}


def test_words_of_lines_are_counted_once(spark, tmp_path):
    """F1, records_by_line: no array of words once more in a filter, nor for the two uses of the counts where they are not written."""
    text = [(b, f"Stone river {w} here", True, True) for b in range(3) for w in ("a", "cat", "dog")]
    spark.createDataFrame(text, "book_id long, text string, strict boolean, lenient boolean").write.parquet(str(tmp_path / "lines"))
    tagged = corpus.tagged_counts(spark.read.parquet(str(tmp_path / "lines")).repartition(2, "book_id"))
    assert plan_of(tagged).count("size(concat(") == 0 and plan_of(tagged).count("sort_array(") == 0
    lexicon = spark.createDataFrame([("stone", 2)], "term string, score int")
    measured = corpus.measure_counts(tagged, lexicon)
    assert [r.total_word_count for r in measured.collect()] == [11, 11, 11]
    assert plan_of(measured).split("== Initial Plan ==")[0].count("FileScan") == 1


def test_only_words_that_may_lead_are_ranked(spark):
    """F1, records_by_line: words below the count that enough words of a book reach are not sorted; ties and short books are whole."""
    rng = random.Random(1)
    names = [f"{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(600)]
    books_of = {1: {w: 1 for w in names}, 2: {w: 1 + (i < 19) for i, w in enumerate(names)}, 3: {w: 1 + (i < 20) for i, w in enumerate(names)}, 4: {w: 2 ** rng.randrange(15) for w in names},
                5: {w: rng.choice((1, 5, 6, 20000)) for w in names}, 6: {"zz": 9}}
    rows = [(b, w, n, 1) for b, words in books_of.items() for w, n in words.items()] + [(b, f"\0{c}", None, 7) for b in books_of for c in corpus.SYNTACTIC_COUNTERS]
    tagged = spark.createDataFrame(rows, "book_id long, word string, n long, m long")
    lexicon = spark.createDataFrame([("ab", 2), ("ac", -1)], "term string, score int")
    measured = corpus.measure_counts(tagged, lexicon)
    got = {r.book_id: r for r in measured.collect()}
    for b, words in books_of.items():
        best = sorted(words.items(), key=lambda c: (-c[1], c[0]))[:20]
        assert [(w.word, w["count"]) for w in got[b].top_words] == best
        assert (got[b].total_word_count, got[b].unique_word_count, got[b].syntactic.unique_word_count) == (sum(words.values()), len(words), len(words))
        assert got[b].sentiment.total_scored_words == words.get("ab", 0) + words.get("ac", 0)
    assert "reached" in plan_of(measured)


def test_books_of_many_lines_are_counted_the_same(spark, tmp_path):
    """F1, records_by_line: books of more lines than a piece, odd signs and no words, by line and whole."""
    rng = random.Random(2)
    signs = ["stone", "Stone's", "it's", "x1", "naïve", "the", "a", "q", "river,", "Mr.", "end.", "\t", "\r", "_so_", "beautiful", "e", "'"]
    (tmp_path / "books").mkdir()
    for i, n in enumerate((0, 1, 40, 3000)):
        text = "\n".join(" ".join(rng.choice(signs) for _ in range(rng.randrange(9))) for _ in range(n))
        (tmp_path / "books" / f"{i} +.txt").write_text(f"front\n{START}\n{text}\n{END}\ntail")
    (tmp_path / "books" / "empty.txt").write_text("")
    (tmp_path / "meta.csv").write_text("book_id,title,author,is_bestseller,filename\n" + "".join(f"{i},T,A,{i % 2},{i} +.txt\n" for i in range(4)) + "e,T,A,1,empty.txt\nagain,T,A,0,3 +.txt\n")
    (tmp_path / "lex.tsv").write_text("stone\t3\nriver\t-3\n")
    paths = [str(tmp_path / x) for x in ("books", "meta.csv", "lex.tsv")]
    runs = [corpus.run_corpus(spark, *paths, by_line=by_line, output=output and str(tmp_path / f"{output}-{by_line}")) for by_line in (False, True) for output in (None, "out")]
    found = [(sorted(map(repr, r.records.collect())), sorted(map(repr, r.word_counts.select("book_id", "word", "n").collect()))) for r in runs]
    assert all(f == found[0] for f in found) and len(found[0][0]) == 6
    counted = spark.read.parquet(str(tmp_path / "out-True" / "counted"))
    assert {len(r.book_id) for r in counted.collect()} == {16}


def test_folders_are_listed_by_few_tasks(spark, tmp_path):
    """F1, records_by_line: not by a task each; a number that the session names stays."""
    for i in range(60):
        (tmp_path / f"volume={i}").mkdir()
        (tmp_path / f"volume={i}" / "a.txt").write_text(f"{START}\nstone")
    status = spark.sparkContext.statusTracker()

    def tasks(group):
        spark.sparkContext.setJobGroup(group, group)
        try:
            found = books.scan_book_lines(spark, str(tmp_path))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        jobs = [status.getJobInfo(j) for j in status.getJobIdsForGroup(group)]
        assert found.count() == 120
        return sum(status.getStageInfo(s).numTasks for j in jobs for s in j.stageIds)

    assert 0 < tasks("few") <= 4 * spark.sparkContext.defaultParallelism < 60
    assert spark.conf.get(books.LISTING_TASKS, None) is None
    spark.conf.set(books.LISTING_TASKS, "50")
    try:
        assert tasks("named") == 50 and spark.conf.get(books.LISTING_TASKS) == "50"
    finally:
        spark.conf.unset(books.LISTING_TASKS)
