"""Registered queries: every operator over the whole given tables.

``documents`` stand in for books (``doc_id`` = book id), ``labels`` for the
bestseller flag (``quality``), ``source`` and ``lang`` for title and author.
Texts are wrapped in marker lines where markers are what is measured; paths,
lines and files are derived from the rows. Nothing is sampled or capped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.constants import SENTIMENT_METRICS, SYNTACTIC_METRICS
from prosestat.functions.body import body_lines, body_text
from prosestat.functions.paths import path_below, path_book_id, path_component, stem_book_id
from prosestat.functions.text import is_blank, letter_tokens
from prosestat.operators import cohorts, normalize, sentiment, syntactic, validate, wordfreq
from prosestat.operators.body import body_of_lines, cut_body
from prosestat.operators.report import comparison_report, preview
from prosestat.plans.corpus import assemble_records, component_facts, measure_books, run_corpus
from prosestat.sources import components, sinks
from prosestat.sources.books import scan_book_lines, scan_books, scan_inventory
from prosestat.sources.lexicon import scan_lexicon
from prosestat.sources.metadata import scan_metadata, scan_metadata_lines
from prosestat.session import read_table, shared_folder, shuffle_partitions
from prosestat.sources.records import scan_record_lines, scan_summary

Query = Callable[[SparkSession, str], DataFrame]

# --- Fixed values: marker lines put around a text, in both spellings.
START = "*** START OF THE PROJECT GUTENBERG EBOOK X ***"
END = "*** END OF THE PROJECT GUTENBERG EBOOK X ***"
OTHER_START = "*** Start of this Project Gutenberg EBook X ***"
OTHER_END = "*** End of this Project Gutenberg EBook X ***"


# ---------------------------------------------------------------- tables as books

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def books_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(book_id, text)`` of the documents."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "text")


def metadata_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(book_id, title, author, is_bestseller, filename)``; unlabelled documents have no flag."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    flags = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return docs.join(flags, "doc_id", "left").select(
        F.col("doc_id").alias("book_id"), F.col("source").alias("title"),
        F.col("lang").alias("author"), F.col("quality").cast("string").alias("is_bestseller"),
        F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"))


def lexicon_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(term, score)``: every word of the benchmark items, scored -5..5 by its letters."""
    words = table(spark, sf_dir, "benchmark").select(F.explode(letter_tokens("text", 1)).alias("term"))
    return words.distinct().select("term", ((F.length("term") * 7 + F.ascii("term")) % 11 - 5)
                                   .cast("int").alias("score"))


def lines(*parts: str | Column) -> Column:
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def doc(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("book_id", "doc_id")


# ---------------------------------------------------------------- words

def wordfreq_corpus(spark, sf_dir):
    return wordfreq.word_counts(books_of(spark, sf_dir))


def wordfreq_by_doc(spark, sf_dir):
    return doc(wordfreq.word_counts_by_book(books_of(spark, sf_dir)))


def top20_corpus(spark, sf_dir):
    return wordfreq.top_corpus_words(wordfreq_corpus(spark, sf_dir))


def top20_by_doc(spark, sf_dir):
    """In-row ranking: no shuffle of words."""
    ranked = wordfreq.word_profiles(books_of(spark, sf_dir)).select(
        F.col("book_id").alias("doc_id"), F.posexplode_outer("top_words").alias("pos", "w"))
    return ranked.where("w is not null").select("doc_id", (F.col("pos") + 1).alias("rank"), F.col("w.word").alias("word"),
                         F.col("w.count").alias("n"))


def top20_by_source(spark, sf_dir):
    """A source is a book of many rows: counted and ranked across them."""
    shards = table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), "text")
    ranked = wordfreq.top_words_by_book(wordfreq.word_counts_by_book(shards))
    return ranked.withColumnRenamed("book_id", "source")


def word_totals_by_doc(spark, sf_dir):
    return doc(wordfreq.word_profiles(books_of(spark, sf_dir)).drop("top_words"))


# ---------------------------------------------------------------- bodies

def _body_measures(wrapped: DataFrame, mode: str) -> DataFrame:
    body = body_text("text", mode)
    return wrapped.select(F.col("book_id").alias("doc_id"),
                          F.size(body_lines("text", mode)).cast("bigint").alias("n_lines"),
                          F.length(body).cast("bigint").alias("n_chars"), F.md5(body).alias("body_md5"))


def body_strict(spark, sf_dir):
    wrapped = books_of(spark, sf_dir).withColumn(
        "text", lines("Title page", START, F.col("text"), END, "licence"))
    return _body_measures(wrapped, "strict")


def body_lenient(spark, sf_dir):
    wrapped = books_of(spark, sf_dir).withColumn(
        "text", lines("Title page", OTHER_START, F.col("text"), OTHER_END, "licence"))
    return _body_measures(wrapped, "lenient")


def body_edge_cases(spark, sf_dir):
    """Eight layouts of marker lines, spread over all documents."""
    text = F.col("text")
    layouts = (
        lines("front", text),                                # no START
        lines("front", START, text),                         # no END
        lines(END, START, text, END, "tail"),                # END above START
        lines("front", OTHER_START, text, OTHER_END),        # the other spelling
        lines("front", START, END, text),                    # nothing in between
        lines(START, text, START, text, END, text, END),     # START again in the body
        lines(START + END, text, END, "tail"),               # both on one line
        lines("front " + START, text, "x " + END + " y"),    # markers within a line
    )
    variant = F.col("book_id") % len(layouts)
    chosen = F.coalesce(*[F.when(variant == i, layout) for i, layout in enumerate(layouts)])
    wrapped = books_of(spark, sf_dir).select("book_id", variant.alias("variant"), chosen.alias("text"))
    measures = [f(mode) for mode in ("strict", "lenient") for f in (
        lambda m: F.size(body_lines("text", m)).cast("bigint").alias(f"{m}_lines"),
        lambda m: F.length(body_text("text", m)).cast("bigint").alias(f"{m}_chars"))]
    return wrapped.select(F.col("book_id").alias("doc_id"), "variant", *measures)


def body_line_numbers(spark, sf_dir):
    rows = books_of(spark, sf_dir).select("book_id", F.posexplode(body_lines("text", "none"))
                                          .alias("line_no", "line"))
    return rows.select(F.col("book_id").alias("doc_id"), F.col("line_no").cast("bigint").alias("line_no"),
                       F.length("line").cast("bigint").alias("n_chars"),
                       is_blank("line").cast("int").alias("blank"))


# ---------------------------------------------------------------- sentiment

def sentiment_by_doc(spark, sf_dir):
    return doc(sentiment.sentiment_by_book(books_of(spark, sf_dir), lexicon_of(spark, sf_dir)))


def sentiment_by_doc_large_lexicon(spark, sf_dir):
    """The same with a lexicon of all words of the corpus, which has no bound."""
    vocabulary = wordfreq.word_counts(books_of(spark, sf_dir)).select(
        F.col("word").alias("term"), ((F.length("word") * 7 + F.ascii("word")) % 11 - 5)
        .cast("int").alias("score"))
    return doc(sentiment.sentiment_by_book(books_of(spark, sf_dir), vocabulary))


def sentiment_rollup(spark, sf_dir):
    """Per-document metrics of one job added up by name."""
    rows = sentiment.sentiment_long(sentiment_by_doc(spark, sf_dir)
                                    .withColumnRenamed("doc_id", "book_id"))
    return sentiment.sum_by_metric(rows).select("metric", F.round("value", 4).alias("value"))


# ---------------------------------------------------------------- syntactic

def syntactic_counts(spark, sf_dir):
    return doc(syntactic.syntactic_counts(books_of(spark, sf_dir)))


def readability(spark, sf_dir):
    return doc(syntactic.readability(syntactic.syntactic_counts(books_of(spark, sf_dir))))


def unique_words(spark, sf_dir):
    """The distinct content words of each document."""
    partials = syntactic.syntactic_partials(books_of(spark, sf_dir))
    exploded = partials.select(F.col("book_id").alias("doc_id"), F.explode_outer("vocabulary").alias("word"))
    return exploded.where("word is not null")


def syntactic_by_source(spark, sf_dir):
    """Documents as shards of their source: counters add up, vocabularies unite."""
    shards = table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), "text")
    merged = syntactic.merge_partials(syntactic.syntactic_partials(shards))
    return syntactic.readability(merged).withColumnRenamed("book_id", "source")


def metrics_unpivot(spark, sf_dir):
    counts = syntactic.readability(syntactic.syntactic_counts(books_of(spark, sf_dir)))
    return doc(syntactic.syntactic_long(counts))


# ---------------------------------------------------------------- paths

def _paths(spark, sf_dir) -> DataFrame:
    """Output-like paths made from every document, and the url of every page."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    folders = ("/output/word-freq/", "/Output/COMP2/", "/out/syntax/", "/data/Metadata/",
               "/output/misc/", "/runs/component3/wordfreq/", "C:\\runs\\meta\\", "/out/sentiment_meta/")
    idt = F.col("doc_id").cast("string")
    names = (F.concat(idt, F.lit("/part-00000")), F.concat(idt, F.lit("_output.txt")),
             F.lit("part-output"), F.concat("source", F.lit(" of "), "lang", F.lit(".tar.txt")),
             F.concat(F.lit("."), "lang"), F.concat(F.lit("12/x/"), idt, F.lit("/a/b.txt")))
    pick = lambda options, i: F.coalesce(*[
        F.when(i == k, o if isinstance(o, Column) else F.lit(o)) for k, o in enumerate(options)])
    path = F.concat(pick(folders, F.col("doc_id") % len(folders)),
                    pick(names, F.floor(F.col("doc_id") / len(folders)) % len(names)))
    pages = table(spark, sf_dir, "pages").select(F.col("url").alias("path"))
    return docs.select(path.alias("path")).unionByName(pages)


def path_components(spark, sf_dir):
    return _paths(spark, sf_dir).select("path", path_component("path").alias("component"))


def path_book_ids(spark, sf_dir):
    return _paths(spark, sf_dir).select("path", path_book_id("path").alias("book_id"))


def stem_book_ids(spark, sf_dir):
    return _paths(spark, sf_dir).select("path", stem_book_id("path").alias("book_id"))


# ---------------------------------------------------------------- facts and records

def _facts(spark, sf_dir) -> DataFrame:
    measured = component_facts(books_of(spark, sf_dir), lexicon_of(spark, sf_dir), "none")
    return measured.unionByName(components.metadata_facts(metadata_of(spark, sf_dir)))


def facts_union(spark, sf_dir):
    return _facts(spark, sf_dir)


def _output_lines(spark, sf_dir) -> DataFrame:
    """Component output lines of every document, good and malformed."""
    counts = wordfreq.word_counts_by_book(books_of(spark, sf_dir))
    kind = F.col("book_id") % 5
    number = F.col("n").cast("string")
    # The layout of a line depends on its document and its word's length.
    layout = (F.length("word") + F.col("book_id")) % 6
    line = (F.when(layout == 0, F.concat_ws("\t", "word", F.lit("many")))
            .when(layout == 1, F.concat_ws(" ", "word", number))
            .when(layout == 2, F.concat(F.lit("  "), "word", F.lit(" \t "), number, F.lit(" ")))
            .when(layout == 3, F.concat_ws("\t", F.lit("id"), "word", number))
            .when(layout == 4, F.concat_ws("\t", "word", F.concat(number, F.lit(".5"))))
            .otherwise(F.concat_ws("\t", "word", number)))
    component = (F.when(kind == 0, "sentiment").when(kind == 1, "syntactic")
                 .when(kind == 2, "other").otherwise("wordfreq"))
    measured = counts.select(F.col("book_id").cast("string").alias("book_id"),
                             component.alias("component"), line.alias("line"))
    about = metadata_of(spark, sf_dir)
    quoted = F.concat(F.lit('"'), F.col("title"), F.lit(', ""'), F.col("author"), F.lit('"""'))
    csv = (F.when(kind == 0, F.concat_ws(",", F.col("book_id").cast("string"), quoted))
           .otherwise(F.concat(F.concat_ws(",", F.col("book_id").cast("string"), quoted, "author"),
                               F.lit(","), F.coalesce("is_bestseller", F.lit("")))))
    rows = about.select(F.lit("unknown").alias("book_id"), F.lit("metadata").alias("component"),
                        csv.alias("line"))
    return measured.unionByName(rows)


def facts_from_lines(spark, sf_dir):
    """Parse rules of the four components on well-formed and malformed lines."""
    return components.facts_from_lines(_output_lines(spark, sf_dir))


def _repeated_facts(spark, sf_dir) -> DataFrame:
    """Every fact, again with another value, and again with one that is not a number."""
    values = F.array(F.col("value"), F.concat(F.lit("1"), "value"), F.concat("value", F.lit("x")))
    return _facts(spark, sf_dir).select("book_id", "component", "metric", F.explode(values).alias("value"))


def facts_dedup(spark, sf_dir):
    return normalize.deduplicate(_repeated_facts(spark, sf_dir))


def _flat_records(records: DataFrame) -> DataFrame:
    at = lambda column, key: F.try_element_at(column, F.lit(key))
    return records.select(
        "book_id", *[at("metadata", k).alias(k) for k in ("title", "author", "is_bestseller")],
        *[at("sentiment", k).alias(k) for k in SENTIMENT_METRICS],
        *[at("syntactic", k).alias(f"syntactic_{k}") for k in SYNTACTIC_METRICS],
        F.size("syntactic").cast("bigint").alias("n_syntactic"),
        "total_word_count", "unique_word_count", F.size("top_words").cast("bigint").alias("n_top"),
        F.get("top_words", F.lit(0))["word"].alias("first_word"),
        F.array_join(F.transform("top_words", lambda w: F.concat_ws(
            ":", w["word"], w["count"].cast("string"))), " ").alias("top_words"))


def normalized_records(spark, sf_dir):
    """Records built from the tagged facts of all four sources."""
    return _flat_records(normalize.build_records(_facts(spark, sf_dir)))


def _records(spark, sf_dir) -> DataFrame:
    books = books_of(spark, sf_dir)
    measured = measure_books(books, lexicon_of(spark, sf_dir), "none")
    return assemble_records(measured, metadata_of(spark, sf_dir))


def direct_records(spark, sf_dir):
    """The same records from the texts, a row per book shuffled."""
    return _flat_records(_records(spark, sf_dir))


def record_preview(spark, sf_dir):
    """The first ten records by id: a preview is what the limit is for."""
    return _flat_records(preview(_records(spark, sf_dir), 10))


def _partial_records(spark, sf_dir) -> DataFrame:
    """Records of documents that lack sentiment, words, syntactic metrics, listing or text, in all combinations."""
    facts = _facts(spark, sf_dir)
    number, of = F.col("book_id").cast("bigint"), F.col("component")
    gone = (((of == "sentiment") & (number % 2 == 0)) | ((of == "wordfreq") & (number % 3 == 0))
            | ((of == "syntactic") & (number % 5 == 0)) | ((of == "metadata") & (number % 7 < 2))
            | ((of != "metadata") & (number % 11 == 0)))
    return normalize.build_records(facts.where(~gone))


def partial_records(spark, sf_dir):
    return _flat_records(_partial_records(spark, sf_dir))


def partial_summary(spark, sf_dir):
    """Cohort sums and means where books lack metrics."""
    return _flat_summary(cohorts.aggregate_cohorts(cohorts.payloads_from_records(_partial_records(spark, sf_dir))))


# ---------------------------------------------------------------- record lines and cohorts

def _record_lines(spark, sf_dir) -> DataFrame:
    """A record line per document, with the ways it can be bad."""
    about = metadata_of(spark, sf_dir)
    size = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("book_id"), "n_chars")
    rows = about.join(size, "book_id")
    idt, n = F.col("book_id").cast("string"), F.col("n_chars").cast("string")
    variant = F.col("book_id") % 14
    flag = F.coalesce("is_bestseller", F.lit("null"))
    json = lambda f, bid, before="", n=n: F.concat(
        F.lit('{"book_id": '), bid, F.lit(', "metadata": {"title": "' + before), "title",
        F.lit('", "is_bestseller": '), f, F.lit('}, "sentiment": {"polarity_score": 0.5, '
                                                '"positive_count": "7"}, "syntactic": {"a": '), n,
        F.lit(', "b": "x"}, "total_word_count": '), n, F.lit(', "unique_word_count": 1}'))
    quoted = F.concat(F.lit('"'), flag, F.lit('"'))
    tab = lambda body: F.concat(idt, F.lit("\t"), body)
    cases = (
        F.lit("  "), F.concat(idt, F.lit(" no tab")), tab(F.lit('{"book_id": ')), tab(F.lit("[1]")),
        tab(F.lit('{"metadata": {"title": "x"}}')),
        # keys that come again, the last value counts
        tab(F.concat(F.lit('{"total_word_count": 5, "metadata": {"is_bestseller": 2, "title": "early"}, '),
                     F.substring(json(flag, idt), 2, 2**31 - 1))),
        tab(json(F.concat(flag, F.lit(".0")), idt)), tab(json(F.lit("true"), idt)),
        tab(json(F.lit('"2"'), idt)), tab(json(F.concat(F.lit('" '), flag, F.lit('"')), F.lit('""'))),
        tab(json(quoted, F.concat(idt, F.lit(".0")))), tab(json(quoted, F.lit("null"))),
        # a whole number no double holds; a number that isn't finite beside the same words in a title
        tab(json(quoted, idt, n=F.concat(F.lit("90071992547"), F.lpad(F.col("book_id").cast("string"), 7, "1")))))
    endless = tab(F.replace(json(quoted, idt, 'Zero, NaN: -Infinity, \\\\\\"'), F.lit('"b": "x"'), F.lit('"b": -Infinity, "c": NaN')))
    line = F.coalesce(*[F.when(variant == i, c) for i, c in enumerate(cases)], endless)
    return rows.select(line.alias("value"))


def record_payloads(spark, sf_dir):
    """Every line, those left out with their reason."""
    rows = cohorts.payloads_from_lines(_record_lines(spark, sf_dir))
    return rows.select("drop_reason", "cohort", "book_id", "title", "total_word_count",
                       "unique_word_count", "type_token_ratio", "polarity_score", "positive_count",
                       F.try_element_at("syntactic", F.lit("a")).alias("a"),
                       F.coalesce(F.size("syntactic"), F.lit(0)).cast("bigint").alias("n_syntactic"))


def drop_reasons(spark, sf_dir):
    return cohorts.drop_counts(cohorts.cohort_totals(cohorts.payloads_from_lines(
        _record_lines(spark, sf_dir))))


def record_counts(spark, sf_dir):
    return cohorts.record_counts(cohorts.cohort_totals(cohorts.payloads_from_lines(
        _record_lines(spark, sf_dir))))


def _totals(spark, sf_dir) -> DataFrame:
    return cohorts.cohort_totals(cohorts.payloads_from_records(_records(spark, sf_dir)))


def _mean_columns(means: DataFrame, family: str) -> DataFrame:
    return means.where(F.col("family") == family).select(
        "cohort", "metric", "n_books", F.round("total", 3).alias("total"), F.round("mean", 3).alias("mean"))


def cohort_scalars(spark, sf_dir):
    return _mean_columns(cohorts.cohort_means(_totals(spark, sf_dir)), "scalar")


def cohort_syntactic(spark, sf_dir):
    return _mean_columns(cohorts.cohort_means(_totals(spark, sf_dir)), "syntactic")


def cohort_deltas(spark, sf_dir):
    compared = cohorts.compare(cohorts.cohort_means(_totals(spark, sf_dir)))
    return compared.select("family", "metric", *[F.round(c, 3).alias(c) for c in (
        "bestseller_mean", "standard_mean", "delta")], "direction")


def cohort_report(spark, sf_dir):
    return comparison_report(cohorts.compare(cohorts.cohort_means(_totals(spark, sf_dir))))


def cohort_summary(spark, sf_dir):
    """The nested one-row summary, flattened to (section, place, name, value, direction)."""
    one = cohorts.aggregate_cohorts(cohorts.payloads_from_records(_records(spark, sf_dir)))
    return _flat_summary(one)


def _flat_summary(one: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")

    def section(name: str, column: str | Column, value=lambda e: e["value"], direction=lambda e: none) -> Column:
        return F.transform(F.map_entries(column), lambda e, i: F.struct(
            F.lit(name).alias("section"), (i + 1).cast("bigint").alias("place"), e["key"].alias("name"),
            F.round(value(e).cast("double"), 3).alias("value"), direction(e).alias("direction")))

    cohort = lambda c, field: F.col("by_cohort")[c][field]
    heads = {"input_lines": F.col("input_lines"), "books_aggregated": F.col("books_aggregated"),
             "dropped_lines": F.col("dropped_lines"),
             "bestseller_books": cohort("bestseller", "n_books"),
             "standard_books": cohort("standard", "n_books"), "version": F.col("version")}
    turns = F.col("comparison.direction")
    parts = [section("head", F.create_map(*[x for k, v in heads.items() for x in (F.lit(k), v)])),
             section("dropped", "dropped_by_reason"),
             section("delta", "comparison.mean_deltas_bestseller_minus_standard",
                     direction=lambda e: F.try_element_at(turns, e["key"])),
             section("syntactic_delta", "comparison.syntactic_mean_deltas",
                     lambda e: e["value"]["delta"], lambda e: e["value"]["direction"])]
    parts += [section(f"{c}_{field}", cohort(c, field)) for c in ("bestseller", "standard")
              for field in ("means", "syntactic_means", "sums")]
    return one.select(F.inline_outer(F.concat(*parts)))


# ---------------------------------------------------------------- validation

def _component_lines(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Word count and sentiment output lines per document, some of them damaged."""
    books = books_of(spark, sf_dir)
    counts = wordfreq.word_counts_by_book(books)
    bad = F.col("book_id") % 7
    wf = counts.select("book_id", F.concat_ws(
        "\t", "word", F.when(bad == 0, F.lit("n/a")).otherwise(F.col("n").cast("string"))).alias("line"))
    scores = sinks.fixed_values(sentiment.sentiment_long(
        sentiment.sentiment_by_book(books, lexicon_of(spark, sf_dir))))
    value = F.when((bad == 1) & (F.col("metric") == "negative_count"), F.lit("none")).otherwise(F.col("value"))
    return wf, scores.select("book_id", F.concat_ws("\t", "metric", value).alias("line"))


def _checks(spark, sf_dir) -> DataFrame:
    wf, sent = _component_lines(spark, sf_dir)
    about = metadata_of(spark, sf_dir).select("book_id", "title", "is_bestseller")
    return validate.validate_outputs(about, wf, sent)


def output_validation(spark, sf_dir):
    return doc(_checks(spark, sf_dir).select(
        "book_id", F.col("wordfreq_ok").cast("int").alias("wordfreq_ok"), "unique_words",
        F.col("sentiment_ok").cast("int").alias("sentiment_ok"), "polarity"))


def validation_totals(spark, sf_dir):
    return validate.validation_totals(_checks(spark, sf_dir))


def polarity_gap(spark, sf_dir):
    gap = validate.polarity_gap(_checks(spark, sf_dir))
    return gap.withColumns({c: F.round(c, 5) for c in ("bestseller_polarity", "standard_polarity", "gap")})


def _inventory(spark, sf_dir) -> DataFrame:
    """File inventory rows: the labelled documents are the files that are there."""
    here = table(spark, sf_dir, "labels").select("doc_id").join(
        table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    return here.select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("filename"),
                       F.floor(F.col("n_chars") / 1024).cast("bigint").alias("size_kb"))


def present_books(spark, sf_dir):
    return doc(validate.present_books(metadata_of(spark, sf_dir), _inventory(spark, sf_dir))
               .select("book_id", "title"))


def missing_books(spark, sf_dir):
    return doc(validate.missing_books(metadata_of(spark, sf_dir), _inventory(spark, sf_dir))
               .select("book_id", "title"))


def book_sizes(spark, sf_dir):
    return doc(validate.book_sizes(metadata_of(spark, sf_dir), _inventory(spark, sf_dir))
               .select("book_id", "title", "size_kb"))


def listing_totals(spark, sf_dir):
    return validate.listing_totals(metadata_of(spark, sf_dir), _inventory(spark, sf_dir))


# ---------------------------------------------------------------- written and read back

def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder the session names, else in its warehouse; never a local one of a cluster."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written_word_counts(spark, sf_dir):
    """Counts as ``key TAB n`` lines, the key naming document and word, read back as facts."""
    path = shared_path(spark, "wordfreq")
    counts = wordfreq_by_doc(spark, sf_dir)
    sinks.write_word_counts(counts.select(F.concat_ws(
        ":", F.col("doc_id").cast("string"), "word").alias("word"), "n"), path, "tsv")
    facts = components.facts_from_lines(components.scan_lines(spark, path, "corpus"))
    return facts.select("component", "metric", F.col("value").cast("bigint").alias("n"))


def written_word_tables(spark, sf_dir):
    """Counts per document as Parquet, ranged by key, over an output that was there before."""
    path = shared_path(spark, "wordfreq")
    counts = wordfreq.word_counts_by_book(books_of(spark, sf_dir), partial=True)
    with sinks.staged(counts, path) as held:
        sinks.write_word_counts(held.withColumn("n", F.col("n") * 2), path, held=True)
        sinks.write_word_counts(held, path, held=True)
    return doc(spark.read.parquet(path))


def written_components(spark, sf_dir):
    """Outputs of two components read in one scan, told apart by path; then one of them as another component's."""
    words, scores = shared_path(spark, "wordfreq"), shared_path(spark, "sentiment")
    sinks.write_word_counts(wordfreq_corpus(spark, sf_dir), words, "tsv")
    sums = sentiment_rollup(spark, sf_dir).withColumn("book_id", F.lit("corpus"))
    sinks.fixed_values(sums).select(F.concat_ws("\t", "metric", "value").alias("value")).write.mode("overwrite").text(scores)
    both = components.facts_from_lines(components.scan_lines(spark, [words, scores], "corpus"))
    other = components.facts_from_lines(components.scan_lines(spark, words, "corpus", "sentiment"))
    return both.select("component", "metric", "value").unionByName(other.select(
        F.concat(F.lit("as "), "component").alias("component"), "metric", "value"))


def written_metrics(spark, sf_dir):
    """All syntactic metrics as three-field TSV, read back as facts."""
    path = shared_path(spark, "syntactic")
    measures = syntactic.syntactic_long(syntactic.readability(
        syntactic.syntactic_counts(books_of(spark, sf_dir))))
    sinks.write_metrics(sinks.fixed_values(measures, SYNTACTIC_METRICS[:3]), path)
    facts = components.facts_from_lines(components.scan_lines(spark, path, "corpus"))
    return facts.groupBy("component", "metric").agg(
        F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))


def written_lexicon(spark, sf_dir):
    """A lexicon as TSV lines with repeats and malformed lines, read back."""
    path = shared_path(spark, "lexicon")
    lexicon = lexicon_of(spark, sf_dir)
    text = F.concat_ws("\t", "term", F.col("score").cast("string"))
    short = F.when(F.length("term") % 4 == 0, F.col("term")).when(
        F.length("term") % 4 == 1, F.concat(text, F.lit("\tmore"))).otherwise(text)
    before = F.concat_ws("\t", "term", (F.col("score") + 20).cast("string"))
    lexicon.select(F.explode(F.array(before, short)).alias("value")).write.mode("overwrite").text(path)
    return scan_lexicon(spark, path)


def written_metadata(spark, sf_dir):
    """Metadata as CSV with quotes and commas, read by name."""
    path = shared_path(spark, "metadata")
    sinks.write_metadata(_quoted_metadata(spark, sf_dir), path)
    return scan_metadata(spark, path).select(
        "book_id", "title", "author", F.coalesce("is_bestseller", F.lit("")).alias("is_bestseller"), "filename")


def written_metadata_first(spark, sf_dir):
    """The first fifty listed books, in file order: the limit is the reader's feature."""
    path = shared_path(spark, "metadata")
    sinks.write_metadata(metadata_of(spark, sf_dir).orderBy("book_id"), path)
    return scan_metadata(spark, path, 50).select("book_id", "title", "filename")


def written_metadata_lines(spark, sf_dir):
    """The same CSV read line by line and by position."""
    path = shared_path(spark, "metadata")
    sinks.write_metadata(_quoted_metadata(spark, sf_dir), path)
    return scan_metadata_lines(spark, path)


def _quoted_metadata(spark, sf_dir) -> DataFrame:
    return metadata_of(spark, sf_dir).withColumns({
        "book_id": F.col("book_id").cast("string"),
        "title": F.concat(F.col("title"), F.lit(', "'), F.col("author"), F.lit('"')),
        "filename": F.when(F.col("book_id") % 2 == 0, F.col("filename"))})


def written_records(spark, sf_dir):
    """Records as ``book_id TAB json`` lines, read back as payloads, top words as written."""
    path = shared_path(spark, "records")
    sinks.write_records(_records(spark, sf_dir), path, fmt="jsonl")
    read = scan_record_lines(spark, path)
    rows = cohorts.payloads_from_lines(read)
    top = read.select(F.substring_index("value", "\t", 1).alias("book_id"), F.md5(F.get_json_object(
        F.get(F.split("value", "\t", 2), F.lit(1)), "$.top_words")).alias("top_md5"))
    return rows.join(top, "book_id").select("top_md5", "book_id", "drop_reason", "cohort", "title", "author", "total_word_count",
                       "unique_word_count", "type_token_ratio", *SENTIMENT_METRICS,
                       F.size("syntactic").cast("bigint").alias("n_syntactic"),
                       *[F.try_element_at("syntactic", F.lit(m)).alias(f"syntactic_{m}") for m in SYNTACTIC_METRICS])


def written_summary(spark, sf_dir):
    """The summary as a JSON document, read back and flattened."""
    path = shared_path(spark, "summary")
    sinks.write_summary(cohorts.aggregate_cohorts(
        cohorts.payloads_from_records(_records(spark, sf_dir))), path)
    return _flat_summary(scan_summary(spark, path))


def written_report(spark, sf_dir):
    path = shared_path(spark, "report")
    sinks.write_report(cohort_report(spark, sf_dir), path)
    return spark.read.csv(path, header=True)


def _written_volumes(spark, sf_dir) -> str:
    """Documents bound to volumes of a hundred, one text file each, between marker lines."""
    path = shared_path(spark, "volumes")
    docs = table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 100).alias("volume"), F.col("doc_id").alias("place"), "text")
    ends = docs.select("volume").distinct()
    edge = lambda place, text: ends.select("volume", F.lit(place).cast("bigint").alias("place"),
                                           F.lit(text).alias("text"))
    leaves = docs.unionByName(edge(-1, "front\n" + START)).unionByName(edge(2**62, END + "\ntail"))
    (leaves.repartition("volume").sortWithinPartitions("volume", "place")
     .select("volume", F.col("text").alias("value")).write.mode("overwrite")
     .partitionBy("volume").text(path))
    return path


def _volume(path: Column) -> Column:
    return F.regexp_extract(path, "volume=([0-9]+)/", 1).cast("bigint")


def written_volumes(spark, sf_dir):
    """Book files scanned whole: lines and words of each volume's body."""
    books = scan_books(spark, _written_volumes(spark, sf_dir)).select(
        _volume(F.col("path")).alias("book_id"), "text")
    body = cut_body(books, "strict")
    return body.select(F.col("book_id").alias("volume"),
                       F.size(body_lines("text", "none")).cast("bigint").alias("n_lines"),
                       F.size(letter_tokens("text")).cast("bigint").alias("n_words"))


def written_volumes_by_line(spark, sf_dir):
    """The same files scanned in splits by line, the body cut by position."""
    rows = scan_book_lines(spark, _written_volumes(spark, sf_dir))
    body = body_of_lines(rows, "strict").select(_volume(F.col("path")).alias("volume"), "text")
    return body.groupBy("volume").agg(F.count("*").alias("n_lines"),
                                      F.sum(F.size(letter_tokens("text"))).alias("n_words"))


def written_inventory(spark, sf_dir):
    """Files found per volume and their size, contents unread."""
    files = scan_inventory(spark, _written_volumes(spark, sf_dir))
    return files.groupBy(_volume(F.col("path")).alias("volume")).agg(
        F.count("*").alias("n_files"), F.sum("size_kb").alias("size_kb"))


def _corpus_run(spark, sf_dir, by_line: bool):
    """A whole run over files: twenty documents a volume, even and odd ones in two
    folders under the same file name; titles of two lines; each fourth file
    unlisted; a listed book without a file for each volume; every third without a flag.
    """
    root = shared_path(spark, "corpus")
    docs = table(spark, sf_dir, "documents").select(
        F.floor(F.col("doc_id") / 20).alias("volume"), (F.col("doc_id") % 2).alias("half"),
        F.col("doc_id").alias("place"), "text")
    ends = docs.select("volume", "half").distinct()
    edge = lambda place, text: ends.select("volume", "half", F.lit(place).cast("bigint").alias("place"),
                                           F.lit(text).alias("text"))
    leaves = docs.unionByName(edge(-1, "front\n" + START)).unionByName(edge(2**62, END + "\ntail"))
    (leaves.repartition(shuffle_partitions(spark), "volume").sortWithinPartitions("volume", "half", "place")
     .select("volume", "half", F.col("text").alias("value"))
     # a volume is one task's, and its folder is moved whole: by tasks each file would be, and each folder made once more
     .write.option("mapreduce.fileoutputcommitter.algorithm.version", "1")
     .partitionBy("volume", "half").text(f"{root}/books"))
    filename = path_below("path", f"{root}/books")
    book = _volume(filename) * 2 + F.regexp_extract(filename, "half=([0-9]+)/", 1).cast("bigint")
    files = scan_inventory(spark, f"{root}/books").select(book.alias("n"), filename.alias("filename"))
    missing = ends.select((-1 - F.col("volume")).alias("n"), F.lit("gone/").alias("filename")).distinct()
    listing = files.where("n % 4 <> 3").unionByName(missing).select(
        F.col("n").cast("string").alias("book_id"),
        F.concat(F.lit("Volume "), "n", F.lit('\n"of many", complete')).alias("title"),
        F.concat(F.lit("A"), F.abs("n") % 5).alias("author"),
        F.when(F.abs("n") % 3 < 2, (F.abs("n") % 3).cast("string")).alias("is_bestseller"),
        F.concat("filename", F.when(F.col("n") < 0, F.col("n").cast("string")).otherwise("")).alias("filename"))
    sinks.write_metadata(listing, f"{root}/listing")
    lexicon_of(spark, sf_dir).select(F.concat_ws("\t", "term", F.col("score").cast("string")).alias("value")
                                     ).write.text(f"{root}/lexicon")
    return run_corpus(spark, f"{root}/books", f"{root}/listing", f"{root}/lexicon", f"{root}/out", by_line=by_line)


def written_corpus_run(spark, sf_dir):
    """Records of a whole run over files."""
    return _flat_records(_corpus_run(spark, sf_dir, by_line=False).records)


def written_corpus_summary(spark, sf_dir):
    """Summary of a whole run over files."""
    return _flat_summary(_corpus_run(spark, sf_dir, by_line=False).summary)


def records_by_line(spark, sf_dir):
    """The same run with the files read in splits by line."""
    return _flat_records(_corpus_run(spark, sf_dir, by_line=True).records)


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    wordfreq_corpus, wordfreq_by_doc, top20_corpus, top20_by_doc, top20_by_source, word_totals_by_doc,
    body_strict, body_lenient, body_edge_cases, body_line_numbers,
    sentiment_by_doc, sentiment_by_doc_large_lexicon, sentiment_rollup,
    syntactic_counts, readability, unique_words, syntactic_by_source, metrics_unpivot,
    path_components, path_book_ids, stem_book_ids,
    facts_union, facts_from_lines, facts_dedup, normalized_records, direct_records,
    record_preview, partial_records, partial_summary,
    record_payloads, drop_reasons, record_counts,
    cohort_scalars, cohort_syntactic, cohort_deltas, cohort_report, cohort_summary,
    output_validation, validation_totals, polarity_gap,
    present_books, missing_books, book_sizes, listing_totals,
    written_word_counts, written_word_tables, written_components, written_metrics, written_lexicon, written_metadata,
    written_metadata_first, written_metadata_lines,
    written_records, written_summary, written_report,
    written_volumes, written_volumes_by_line, written_inventory,
    written_corpus_run, written_corpus_summary, records_by_line,
)}
