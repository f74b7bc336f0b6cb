"""The whole run: books, lexicon and metadata to records, summary and report."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from prosestat.constants import (
    METADATA_FIELDS, SENTIMENT_METRICS, SYNTACTIC_COUNTERS, SYNTACTIC_METRICS, TIE_EPSILON, TOP_WORDS,
)
from prosestat.functions.body import body_text
from prosestat.functions.numbers import fixed4
from prosestat.functions.paths import path_below
from prosestat.functions.text import is_content, is_vocabulary, let, letter_tokens, strip
from prosestat.operators import cohorts
from prosestat.operators.body import bodies_of_lines, cut_body
from prosestat.operators.report import comparison_report
from prosestat.operators.sentiment import (
    score_sums, score_values, sentiment_long, sentiment_metrics, term_scores,
)
from prosestat.operators.syntactic import (
    readability, rounded, syntactic_counts, syntactic_long, syntactic_partials,
)
from prosestat.operators.wordfreq import content_runs, profile_of, word_counts_by_book
from prosestat.session import shuffle_partitions
from prosestat.sources import sinks
from prosestat.sources.books import (
    NAMED_FILES, Selection, scan_book_lines, scan_books, scan_inventory, selection,
)
from prosestat.sources.lexicon import scan_lexicon
from prosestat.sources.metadata import scan_metadata


#: Bytes of a book up to which it is read as one row.
WHOLE_BYTES = 32 << 20


class CorpusRun(NamedTuple):
    """Lazy results of a run."""
    word_counts: DataFrame
    sentiment: DataFrame
    syntactic: DataFrame
    records: DataFrame
    summary: DataFrame
    report: DataFrame


def measure_books(books: DataFrame, lexicon: DataFrame, mode: str | None = None) -> DataFrame:
    """``(book_id, total_word_count, unique_word_count, top_words, sentiment, syntactic)``.

    For ``(book_id, text)`` with one row per book, which is read once: a row gives
    one row of its own measures and one for each different word. These meet the
    lexicon; of the words only hits go on, and a book's few rows are summed up.
    Bodies are cut strictly for words and leniently for the syntactic metrics
    unless one ``mode`` is given for both. Rows without an id are left out.
    """
    strict, lenient = body_text("text", mode or "strict"), body_text("text", mode or "lenient")
    words = let(content_runs(strict), lambda runs: F.struct(profile_of(runs).alias("profile"), runs.alias("runs")))
    cut = books.where("book_id is not null").select("book_id", words.alias("_w"), lenient.alias("text"))
    measured = rounded(readability(syntactic_counts(cut, "_w"), "_w"))
    own = F.struct(F.col("_w.profile").alias("profile"), F.struct(*SYNTACTIC_METRICS).alias("syntactic"))
    # No term holds a zero byte; with the id behind it, rows of measures spread over the tasks of the join.
    none = F.concat(F.lit("\0"), F.col("book_id").cast("string"))
    # The array is a column of its own, of one type in all parts, so that exploding it and the join are compiled together.
    # It is never empty: a plain explode would have the optimizer compute it once more, in a filter on its size.
    terms = F.concat(F.array(F.struct(none.alias("word"), F.lit(None).cast("bigint").alias("n"))), F.col("_w.runs")).alias("terms")
    tagged = measured.select("book_id", own.alias("own"), terms).select("book_id", "own", F.explode_outer("terms").alias("t")).select(
        "book_id", F.when(F.col("t.n").isNull(), F.col("own")).alias("own"), F.col("t.word").alias("term"), "t.n")
    rows = tagged.join(term_scores(lexicon), "term", "left").where("n is null or score is not null")
    books_of = rows.groupBy("book_id").agg(F.max("own").alias("own"), *score_sums(F.col("n")))
    return books_of.select("book_id", "own.profile.*", _sentiment_struct(), "own.syntactic")


def component_facts(books: DataFrame, lexicon: DataFrame, mode: str | None = None) -> DataFrame:
    """Facts of the three components of ``(book_id, text)`` with one row per book, from one pass over the texts.

    A row gives one row of its own metrics and one for each different word. These
    meet the lexicon; a scored word also adds to its book's sums. One shuffle then
    brings together what belongs to a fact.
    """
    strict, lenient = body_text("text", mode or "strict"), body_text("text", mode or "lenient")
    cut = books.where("book_id is not null").select("book_id", content_runs(strict).alias("runs"), lenient.alias("text"))
    measured = readability(syntactic_counts(cut, "runs"), "runs")
    doubles = [F.col(m).cast("double").alias(m) for m in SYNTACTIC_METRICS]
    none = F.concat(F.lit("\0"), F.col("book_id").cast("string"))
    tagged = measured.select("book_id", "runs", none.alias("none"), F.struct(*doubles).alias("own")).select("book_id", F.explode(F.concat(
        F.array(F.struct(F.col("none").alias("term"), F.lit(None).cast("bigint").alias("n"), "own")),
        F.transform("runs", lambda r: F.struct(r["word"].alias("term"), r["n"], F.lit(None).alias("own"))))).alias("t")).select("book_id", "t.*")
    scored = tagged.join(term_scores(lexicon), "term", "left")
    # the metric of a fact; null for what adds to the sums of the book
    is_word = F.col("own").isNull()
    goes_to = F.when(~is_word, F.array(F.lit(None).cast("string"))).when(F.col("score").isNull(), F.array("term")).otherwise(F.array(F.col("term"), F.lit(None).cast("string")))
    parts = scored.select("book_id", "n", F.when(is_word, F.col("score")).alias("score"), "own.*", F.explode(goes_to).alias("metric"))
    sums = parts.groupBy("book_id", "metric").agg(F.sum("n").alias("n"), *score_sums(F.col("n")), *[F.sum(m).alias(m) for m in SYNTACTIC_METRICS])
    fact = lambda component, metric, value: F.struct(F.lit(component).alias("component"), metric.alias("metric"), value.alias("value"))
    whole = lambda m: F.col(m).cast("bigint").cast("string") if m in SYNTACTIC_METRICS[:3] else fixed4(m)
    measures = [fact("syntactic", F.lit(m), whole(m)) for m in SYNTACTIC_METRICS]
    named = sums.select("book_id", "metric", "n", *SYNTACTIC_METRICS, *sentiment_metrics())
    found = F.when(F.col("metric").isNull(), F.array(*measures, *[fact("sentiment", F.lit(m), fixed4(m)) for m in SENTIMENT_METRICS])).otherwise(
        F.array(fact("wordfreq", F.col("metric"), F.col("n").cast("string"))))
    return named.select(F.col("book_id").cast("string").alias("book_id"), F.explode(found).alias("f")).select("book_id", "f.*")


def _sentiment_struct() -> Column:
    polarity, *rest = sentiment_metrics()
    return F.struct(F.round(polarity, 4).alias("polarity_score"), *rest).alias("sentiment")


#: What leads the names of counters among words, which hold no zero byte.
COUNTER = "\0"


def tagged_counts(rows: DataFrame) -> DataFrame:
    """``(book_id, word, n, m)`` of books of many rows, from one pass over them.

    Rows are ``(book_id, text, strict, lenient)``: a line or another piece of a
    book, with flags of the bodies it is in. For a word, ``n`` is its number among
    the content words of the strict body and ``m`` is not null if it is in the
    vocabulary of the lenient one; each is null where the word is in the other only.
    A counter is a row of its own, its sum in ``m``, its name behind a zero byte.
    What equal words sum up to in a task is all that is shuffled.
    """
    strict, lenient = F.col("strict"), F.col("lenient")
    spoken = rows.select("book_id", letter_tokens(F.when(strict, F.col("text"))).alias("said"), F.when(lenient, F.col("text")).alias("text"))
    parts = syntactic_partials(spoken, "said", distinct=False)
    none = F.array().cast("array<string>")
    said, words, counters = F.coalesce("said", none), F.coalesce("words", none), [F.lit(COUNTER + c) for c in SYNTACTIC_COUNTERS]
    # words are told apart by their place, and looked at and counted in the aggregate: structs of them, or counts in a line, take longer
    places = parts.select("book_id", *SYNTACTIC_COUNTERS, F.size(said).alias("of_said"), F.size(words).alias("of_words"), F.concat(said, words, F.array(*counters)).alias("terms"))
    # never empty, and said so: else the optimizer computes the array once more, in a filter on its size
    each = places.select("*", F.posexplode_outer("terms").alias("at", "word")).drop("terms")
    at, word = F.col("at"), F.col("word")
    is_said = at < F.col("of_said")
    is_word = ~is_said & (at < F.col("of_said") + F.col("of_words"))
    kept = each.where(F.when(is_said, is_content(word)).when(is_word, is_vocabulary(word)).otherwise(True))
    value = F.coalesce(*[F.when(word == COUNTER + c, F.col(c)) for c in SYNTACTIC_COUNTERS])
    tagged = kept.select("book_id", "word", F.when(is_said, F.lit(1).cast("bigint")).alias("n"),
                         F.when(is_word, F.lit(1).cast("bigint")).when(~is_said, value).alias("m"))
    return tagged.groupBy("book_id", "word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def word_counts_of(tagged: DataFrame) -> DataFrame:
    """``(book_id, word, n)`` of ``tagged_counts``."""
    return tagged.where("n is not null").select("book_id", "word", "n")


#: Parts that the words of a book are dealt to where they are ranked.
SALTS = 8

#: Counts of which the greatest that enough words of a book reach bounds the words that are ranked.
STEPS = (2, 3, 4, 6, 8, 12, 16, 32, 64, 256, 1024, 8192)


def measure_counts(tagged: DataFrame, lexicon: DataFrame, salts: int = SALTS) -> DataFrame:
    """The columns of ``measure_books`` from ``tagged_counts``; every book with counters gets a row.

    No book is held in one row or task, and no word is moved but those that may be
    among the first: sums are made where the words are read, and of them comes the
    count that enough words of the book reach. Words below it are not ranked; the
    others are dealt to ``salts`` parts by their hash, and each part gives its first.
    """
    is_counter = F.startswith("word", F.lit(COUNTER))
    # only words meet a term; counters are spread by their book
    term = F.when(is_counter, F.concat(F.lit(COUNTER), F.col("book_id").cast("string"))).otherwise(F.col("word"))
    known = tagged.where("book_id is not null")
    scored = known.select("*", term.alias("term")).join(term_scores(lexicon), "term", "left")
    reached = F.coalesce(*[F.when(F.col(f"_{step}") >= TOP_WORDS, step) for step in reversed(STEPS)], F.lit(1))
    sums = scored.groupBy("book_id").agg(
        F.sum("n").alias("total"), F.count("n").alias("unique"), F.count(F.when(~is_counter, F.col("m"))).alias("unique_word_count"),
        *[F.sum(F.when(F.col("word") == COUNTER + c, F.col("m"))).alias(c) for c in SYNTACTIC_COUNTERS], *score_sums(F.col("n")),
        *[F.count(F.when(F.col("n") >= step, 1)).alias(f"_{step}") for step in STEPS])
    counted = sums.where("sentence_count is not null").withColumn("reached", reached.cast("bigint"))
    # m is looked at so that this is the same aggregate as above, made once where nothing is written between
    frequent = known.where("n is not null and (m is null or m >= 0)").join(counted.select("book_id", "reached"), "book_id").where("n >= reached")
    salt = F.pmod(F.xxhash64("word"), F.lit(salts)).alias("salt")
    rank = F.row_number().over(Window.partitionBy("book_id", "salt").orderBy(F.desc("n"), "word"))
    few = frequent.select("book_id", "word", "n", salt).withColumn("rank", rank).where(F.col("rank") <= TOP_WORDS)
    first = few.groupBy("book_id").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("minus"), "word"))), 1, TOP_WORDS).alias("top"))
    some = F.col("unique") > 0
    words = counted.join(first, "book_id", "left").withColumn("words_", F.struct(
        F.when(some, F.col("total")).alias("total_word_count"), F.when(some, F.col("unique")).alias("unique_word_count"),
        F.when(some, F.transform("top", lambda w: F.struct(w["word"].alias("word"), (-w["minus"]).alias("count")))).alias("top_words"),
        _sentiment_struct()))
    metrics = rounded(readability(words, "words_"))
    return metrics.select("book_id", "words_.total_word_count", "words_.unique_word_count", "words_.top_words", "words_.sentiment",
                          F.struct(*SYNTACTIC_METRICS).alias("syntactic"))


def file_key(name: Column) -> Column:
    """A file's name as 16 bytes, for results of many rows: names are long, and begin alike."""
    return F.unhex(F.md5(name))


#: Lines of a file that may go together to a task.
PIECE_LINES = 1024


def body_rows(spark: SparkSession, books_dir: str, files: Selection = Selection()) -> DataFrame:
    """``(book_id, text, strict, lenient)`` of the body lines below a folder, and an empty row per file.

    The id is the ``file_key`` of the path below the folder. Lines are dealt out anew, neighbours
    together: measuring them is most of the work, and files may be of any size.
    """
    empty = scan_inventory(spark, books_dir, files=files).select(
        "path", F.lit("").alias("text"), F.lit(True).alias("strict"), F.lit(True).alias("lenient"))
    lines = bodies_of_lines(scan_book_lines(spark, books_dir, files=files))
    piece = F.floor(F.col("position.row") / PIECE_LINES)
    dealt = lines.repartition(shuffle_partitions(spark), "path", "position.block", piece)
    rows = dealt.select("path", "text", "strict", "lenient").unionByName(empty)
    return rows.withColumn("book_id", file_key(path_below("path", books_dir))).drop("path")


def _map_of(struct: str, names: tuple[str, ...]) -> Column:
    entries = [c for n in names for c in (F.lit(n), F.col(struct)[n].cast("double"))]
    return F.when(F.col(struct).isNotNull(), F.create_map(*entries)).otherwise(
        F.create_map().cast("map<string,double>"))


def assemble_records(measured: DataFrame, metadata: DataFrame) -> DataFrame:
    """One record per book that was measured or listed; what a book lacks is empty.

    Gives the records that ``operators.normalize.build_records`` builds from
    component outputs, without writing out and regrouping every word: a row per
    book is all that is shuffled.
    """
    joined = measured.join(metadata_by_book(metadata), "book_id", "full")
    return joined.select(
        F.col("book_id").cast("string").alias("book_id"),
        F.coalesce("metadata", F.create_map().cast("map<string,string>")).alias("metadata"),
        _map_of("sentiment", SENTIMENT_METRICS).alias("sentiment"),
        _map_of("syntactic", SYNTACTIC_METRICS).alias("syntactic"),
        "total_word_count", "unique_word_count", "top_words")


def metadata_by_book(metadata: DataFrame) -> DataFrame:
    """``(book_id, metadata)``: non-empty fields as a map, the greatest value of repeated rows."""
    rows = metadata.where(F.col("book_id").isNotNull() & (F.col("book_id").cast("string") != ""))
    cleaned = [F.nullif(strip(F.col(name).cast("string")), F.lit("")).alias(name)
               for name in METADATA_FIELDS]
    fields = rows.select("book_id", *cleaned).groupBy("book_id").agg(
        *[F.max(name).alias(name) for name in METADATA_FIELDS])
    entries = F.array(*[F.struct(F.lit(n).alias("key"), F.col(n).alias("value"))
                        for n in METADATA_FIELDS])
    present = F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))
    return fields.select("book_id", present.alias("metadata"))


def under_listed_ids(results: DataFrame, metadata: DataFrame, key: Callable[[Column], Column] = lambda name: name) -> DataFrame:
    """Results keyed by file name, or ``key`` of it, under the book ids the metadata lists for the files.

    Applied to results, not to texts: those are large and would be shuffled when
    the listing is too large to broadcast.
    """
    ids = metadata.groupBy("book_id").agg(key(F.max("filename")).alias("_file"))
    columns = [c for c in results.columns if c != "book_id"]
    return results.withColumnRenamed("book_id", "_file").join(ids, "_file").select(
        "book_id", *columns)


def run_corpus(spark: SparkSession, books_dir: str, metadata_path: str, lexicon_path: str,
               output: str | None = None, limit: int = 0, top: int = 6,
               eps: float = TIE_EPSILON, by_line: bool | None = None, partitions: tuple[str, ...] = (),
               named: int = NAMED_FILES, whole_bytes: int = WHOLE_BYTES) -> CorpusRun:
    """All stages over a directory of books; ``limit`` > 0 takes the first listed books.

    A listed file name is the path below ``books_dir``, folders included; files
    that are not listed are not measured. Up to ``named`` listed files are named in
    the plan, and no other is opened. A longer listing is joined; then files
    in folders that list none are not opened if the folders are ``key=value`` ones
    whose keys ``partitions`` tells, outermost first.

    Books of up to ``whole_bytes`` are read whole, a row each; larger ones in splits
    by line, so that no book needs to fit in a row or in the memory of a task, with
    the same results. ``by_line`` reads all books one way or the other.

    With ``output`` every result is written below it, and later stages read the
    written records, so the texts are not processed again and a lost executor
    costs no more than its own tasks. Without it the results are lazy.
    """
    metadata = scan_metadata(spark, metadata_path, limit)
    lexicon = scan_lexicon(spark, lexicon_path)
    files = selection(metadata, named, partitions)
    large, small = files, files
    if by_line is None:
        large, small = files._replace(over=whole_bytes), files._replace(up_to=whole_bytes)
        by_line_too = not scan_inventory(spark, books_dir, files=large).isEmpty()
    else:
        by_line_too = by_line
    results = []
    if by_line_too:
        tagged = tagged_counts(body_rows(spark, books_dir, large))
        if output:
            tagged.write.mode("overwrite").parquet(f"{output}/counted")
            tagged = spark.read.parquet(f"{output}/counted")
        results.append(tuple(under_listed_ids(found, metadata, file_key) for found in (word_counts_of(tagged), measure_counts(tagged, lexicon))))
    if not by_line:
        books = scan_books(spark, books_dir, files=small).select(path_below("path", books_dir).alias("book_id"), "text")
        results.append(tuple(under_listed_ids(found, metadata) for found in (
            word_counts_by_book(cut_body(books, "strict"), partial=bool(output)), measure_books(books, lexicon))))
    counts, measured = (reduce(DataFrame.unionByName, parts) for parts in zip(*results))
    sentiment = measured.select("book_id", "sentiment.*")
    syntactic = measured.select("book_id", "syntactic.*")
    records = assemble_records(measured, metadata)
    if output:
        sinks.write_records(records, f"{output}/records")
        records = spark.read.parquet(f"{output}/records")
        sentiment = _written(records, "sentiment", SENTIMENT_METRICS)
        syntactic = _written(records, "syntactic", SYNTACTIC_METRICS)
    payloads = cohorts.payloads_from_records(records)
    summary = cohorts.aggregate_cohorts(payloads, eps)
    report = comparison_report(cohorts.compare(cohorts.cohort_means(
        cohorts.cohort_totals(payloads)), eps), top)
    if output:
        # a book is one file, and a file's counts are one row per word; those of lines are in files already
        sinks.write_word_counts(counts, f"{output}/wordfreq", held=bool(by_line), summed=True)
        counts = spark.read.parquet(f"{output}/wordfreq")
        sinks.write_metrics(sinks.fixed_values(sentiment_long(sentiment)), f"{output}/sentiment")
        sinks.write_metrics(sinks.fixed_values(syntactic_long(syntactic), SYNTACTIC_METRICS[:3]),
                            f"{output}/syntactic")
        sinks.write_records(records, f"{output}/normalized", fmt="jsonl")
        sinks.write_summary(summary, f"{output}/summary")
        sinks.write_report(report, f"{output}/report")
    return CorpusRun(counts, sentiment, syntactic, records, summary, report)


def _written(records: DataFrame, column: str, names: tuple[str, ...]) -> DataFrame:
    """The metrics of the books that were measured, from written records."""
    return records.where(F.size(column) > 0).select(
        "book_id", *[F.try_element_at(column, F.lit(n)).alias(n) for n in names])
