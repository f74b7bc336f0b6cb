"""The registered queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

from prosestat.constants import (
    ABBREVIATIONS, COMPONENT_KEYWORDS, FREQUENCY_STOPWORDS, REPORT_FIRST, SENTIMENT_METRICS,
    SYNTACTIC_METRICS, VOCABULARY_STOPWORDS,
)
from prosestat.plans.queries import END, START


def _list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


# ---------------------------------------------------------------- common table expressions

TOK = f"""tok AS (
  SELECT doc_id, source, word FROM (
    SELECT doc_id, source, unnest(regexp_extract_all(lower(text), '[a-z]+')) AS word FROM documents)
  WHERE length(word) > 1 AND word NOT IN ({_list(FREQUENCY_STOPWORDS)}))"""

WF = TOK + ", wf AS (SELECT doc_id, word, count(*) AS n FROM tok GROUP BY doc_id, word)"

_SCORE = "CAST((length({0}) * 7 + ascii({0})) % 11 - 5 AS INTEGER)"

LEX = f"""lex AS (
  SELECT DISTINCT term, {_SCORE.format('term')} AS score FROM (
    SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS term FROM benchmark))"""


def _sent(lexicon: str) -> str:
    return f"""hits AS (SELECT doc_id, score FROM tok JOIN {lexicon} ON word = term),
sent AS (
  SELECT d.doc_id,
    coalesce(sum(score), 0) AS s, count(score) AS c,
    count(*) FILTER (WHERE score > 0) AS pos, count(*) FILTER (WHERE score < 0) AS neg
  FROM documents d LEFT JOIN hits h ON d.doc_id = h.doc_id GROUP BY d.doc_id)"""


_POLARITY = "CASE WHEN c = 0 THEN 0.0 ELSE CAST(s AS DOUBLE) / CAST(c AS DOUBLE) END"
# Four decimals, ties away from zero, by whole-number arithmetic.
_POLARITY4 = ("CASE WHEN c = 0 THEN 0.0 ELSE CAST(sign(s) * ((abs(s) * 20000 + c) // (2 * c)) AS DOUBLE)"
              " / 10000.0 END")


def _ratio4(a: str, b: str) -> str:
    return (f"CASE WHEN {b} = 0 THEN 0.0 ELSE CAST(({a} * 20000 + {b}) // (2 * {b}) AS DOUBLE)"
            " / 10000.0 END")


def _sentiment_row(polarity: str) -> str:
    return (f"{polarity} AS polarity_score, CAST(pos AS DOUBLE) AS positive_count, "
            "CAST(neg AS DOUBLE) AS negative_count, CAST(c AS DOUBLE) AS total_scored_words")


# Words: runs of word characters that are not plain letters become '#'.
_WORDS = r"""list_filter(list_transform(regexp_extract_all(array_to_string(list_transform(
  regexp_extract_all(lower(text), '[\p{L}\p{N}_]+|[^\p{L}\p{N}_]+'),
  lambda x: CASE WHEN regexp_matches(x, '[\p{L}\p{N}_]') AND NOT regexp_full_match(x, '[a-z]+')
            THEN '#' ELSE x END), ''), '[a-z'']+'), lambda x: trim(x, '''')), lambda x: x <> '')"""

_GUARDED = "line"
for _short in ABBREVIATIONS:
    _GUARDED = f"replace({_GUARDED}, '{_short}', '{_short.replace('.', '<DOT>')}')"


def _c3(key: str) -> str:
    """Counters per ``key``; texts of one key add up."""
    return f"""words AS (
  SELECT {key} AS k, unnest({_WORDS}) AS w FROM documents),
spoken AS (
  SELECT k, w, greatest(1, len(regexp_extract_all(
    CASE WHEN length(w) > 2 THEN regexp_replace(w, 'e$', '') ELSE w END, '[aeiouy]+'))) AS syl FROM words),
per_word AS (
  SELECT k, count(*) AS word_count, sum(length(w)) AS char_count, sum(syl) AS syllable_count,
    count(*) FILTER (WHERE syl >= 3) AS complex_word_count,
    count(DISTINCT w) FILTER (WHERE length(w) > 1 AND w NOT IN ({_list(VOCABULARY_STOPWORDS)}))
      AS unique_word_count
  FROM spoken GROUP BY k),
per_line AS (
  SELECT k, sum(len(list_filter(regexp_split_to_array({_GUARDED}, '[.!?]+\\s+|[.!?]+$'),
    lambda x: regexp_matches(x, '\\S')))) AS sentence_count
  FROM (SELECT {key} AS k, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY k),
c3 AS (
  SELECT d.k, CAST(coalesce(sentence_count, 0) AS BIGINT) AS sentence_count,
    CAST(coalesce(word_count, 0) AS BIGINT) AS word_count,
    CAST(coalesce(char_count, 0) AS BIGINT) AS char_count,
    CAST(coalesce(syllable_count, 0) AS BIGINT) AS syllable_count,
    CAST(coalesce(complex_word_count, 0) AS BIGINT) AS complex_word_count,
    CAST(coalesce(unique_word_count, 0) AS BIGINT) AS unique_word_count
  FROM (SELECT DISTINCT {key} AS k FROM documents) d
  LEFT JOIN per_word USING (k) LEFT JOIN per_line USING (k))"""


def _div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE))"


_SCORED = "CASE WHEN word_count > 0 AND sentence_count > 0 THEN {} ELSE 0.0 END"
_FRE = f"206.835::DOUBLE - 1.015::DOUBLE * {_div('word_count', 'sentence_count')} - 84.6::DOUBLE * {_div('syllable_count', 'word_count')}"
_FKG = f"0.39::DOUBLE * {_div('word_count', 'sentence_count')} + 11.8::DOUBLE * {_div('syllable_count', 'word_count')} - 15.59::DOUBLE"
_FOG = f"0.4::DOUBLE * ({_div('word_count', 'sentence_count')} + {_div('complex_word_count * 100', 'word_count')})"


def _guard(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0.0 ELSE {_div(a, b)} END"


_READ = f"""word_count, sentence_count, unique_word_count,
  {_guard('word_count', 'sentence_count')} AS avg_sentence_length,
  {_guard('char_count', 'word_count')} AS avg_word_length,
  {_guard('unique_word_count', 'word_count')} AS type_token_ratio,
  {_SCORED.format(_FRE)} AS flesch_reading_ease,
  {_SCORED.format(_FKG)} AS flesch_kincaid_grade,
  {_SCORED.format(_FOG)} AS gunning_fog_index"""

_READ4 = f"""CAST(word_count AS DOUBLE) AS word_count, CAST(sentence_count AS DOUBLE) AS sentence_count,
  CAST(unique_word_count AS DOUBLE) AS unique_word_count,
  {_ratio4('word_count', 'sentence_count')} AS avg_sentence_length,
  {_ratio4('char_count', 'word_count')} AS avg_word_length,
  {_ratio4('unique_word_count', 'word_count')} AS type_token_ratio,
  round({_SCORED.format(_FRE)}, 4) + 0.0 AS flesch_reading_ease,
  round({_SCORED.format(_FKG)}, 4) + 0.0 AS flesch_kincaid_grade,
  round({_SCORED.format(_FOG)}, 4) + 0.0 AS gunning_fog_index"""

META = """meta AS (
  SELECT d.doc_id, source AS title, lang AS author, CAST(quality AS VARCHAR) AS is_bestseller
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

def _rec(meta: str = META, words: str = "TRUE", scored: str = "TRUE", measured: str = "TRUE") -> str:
    """One row per book in ``ids`` and what a record holds; conditions on doc_id say what a book has."""
    return f"""{WF}, {LEX}, {_sent('lex')}, {_c3('doc_id')}, {meta},
totals AS (SELECT doc_id, CAST(sum(n) AS BIGINT) AS total, count(*) AS uniq FROM wf WHERE {words} GROUP BY doc_id),
s4 AS (SELECT doc_id, {_sentiment_row(_POLARITY4)} FROM sent WHERE {scored}),
r4 AS (SELECT * FROM (SELECT k AS doc_id, {_READ4} FROM c3) WHERE {measured}),
ids AS (SELECT doc_id FROM meta UNION SELECT doc_id FROM totals UNION SELECT doc_id FROM s4
  UNION SELECT doc_id FROM r4)"""


REC = _rec()

_FACTS = f"""{REC}, facts AS (
  SELECT CAST(doc_id AS VARCHAR) AS book_id, 'wordfreq' AS component, word AS metric,
    CAST(n AS VARCHAR) AS value FROM wf
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'sentiment', metric, printf('%.4f', value)
    FROM (UNPIVOT s4 ON {', '.join(SENTIMENT_METRICS)} INTO NAME metric VALUE value)
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'syntactic', metric,
    CASE WHEN metric IN ({_list(SYNTACTIC_METRICS[:3])}) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
         ELSE printf('%.4f', value) END
    FROM (UNPIVOT r4 ON {', '.join(SYNTACTIC_METRICS)} INTO NAME metric VALUE value)
  UNION ALL SELECT CAST(doc_id AS VARCHAR), 'metadata', metric, value
    FROM (UNPIVOT meta ON title, author, is_bestseller INTO NAME metric VALUE value)
    WHERE value <> '')"""

def _flat(rec: str, before: str = "", after: str = "") -> str:
    return f"""WITH {before}{rec}, ranked AS (
  SELECT doc_id, word, n, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rk
  FROM wf WHERE doc_id IN (SELECT doc_id FROM totals)),
top AS (
  SELECT doc_id, count(*) AS n_top, max(word) FILTER (WHERE rk = 1) AS first_word,
    string_agg(word || ':' || n, ' ' ORDER BY rk) AS top_words
  FROM ranked WHERE rk <= 20 GROUP BY doc_id)
SELECT CAST(ids.doc_id AS VARCHAR) AS book_id, title, author, is_bestseller,
  {', '.join(SENTIMENT_METRICS)}, {', '.join(f'r.{m} AS syntactic_{m}' for m in SYNTACTIC_METRICS)},
  CAST(CASE WHEN r.word_count IS NULL THEN 0 ELSE 9 END AS BIGINT) AS n_syntactic,
  total AS total_word_count, uniq AS unique_word_count, n_top, first_word, top_words
FROM ids LEFT JOIN meta m USING (doc_id) LEFT JOIN s4 USING (doc_id) LEFT JOIN r4 r USING (doc_id)
LEFT JOIN totals USING (doc_id) LEFT JOIN top USING (doc_id){after}"""


_FLAT = _flat(REC)

# Cohort sums: long form of every usable record.
_SCALARS = ("polarity_score", "positive_count", "negative_count", "total_scored_words",
            "total_word_count", "unique_word_count", "type_token_ratio")
def _means(rec: str) -> str:
    return f"""{rec}, usable AS (
  SELECT CASE is_bestseller WHEN '1' THEN 'bestseller' WHEN '0' THEN 'standard' END AS cohort, doc_id
  FROM meta WHERE is_bestseller IN ('0', '1')),
sizes AS (SELECT cohort, count(*) AS n FROM usable GROUP BY cohort),
sc AS (
  SELECT cohort, {', '.join(SENTIMENT_METRICS)}, CAST(total AS DOUBLE) AS total_word_count,
    CAST(uniq AS DOUBLE) AS unique_word_count, CAST(uniq AS DOUBLE) / total AS type_token_ratio
  FROM usable LEFT JOIN s4 USING (doc_id) LEFT JOIN totals USING (doc_id)),
means AS (
  SELECT cohort, 'scalar' AS family, metric, any_value(n) AS n_books, sum(value) AS total,
    sum(value) / any_value(n) AS mean
  FROM (UNPIVOT sc ON {', '.join(_SCALARS)} INTO NAME metric VALUE value) JOIN sizes USING (cohort)
  GROUP BY cohort, metric
  UNION ALL
  SELECT cohort, 'syntactic', metric, count(value), sum(value), avg(value)
  FROM (UNPIVOT r4 ON {', '.join(SYNTACTIC_METRICS)} INTO NAME metric VALUE value) JOIN usable USING (doc_id)
  GROUP BY cohort, metric)"""

MEANS = _means(REC)


def _compared(rec: str) -> str:
    return f"""{_means(rec)}, sides AS (
  SELECT family, metric, max(mean) FILTER (WHERE cohort = 'bestseller') AS b,
    max(mean) FILTER (WHERE cohort = 'standard') AS s FROM means GROUP BY family, metric),
compared AS (
  SELECT family, metric, b, s, b - s AS d,
    CASE WHEN b - s IS NULL THEN NULL WHEN abs(b - s) < 1e-9 THEN 'tie'
         WHEN b - s > 0 THEN 'bestseller_higher' ELSE 'standard_higher' END AS direction FROM sides)"""

COMPARED = _compared(REC)

_SCALAR_PLACES = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(_SCALARS, 1))


def _summary(rec: str, before: str = "") -> str:
    """Keys are sorted by name, but for the means of scalars, which have an order of their own."""
    return f"""WITH {before}{_compared(rec)}
SELECT 'head' AS section, place, name, value, CAST(NULL AS VARCHAR) AS direction FROM (
  SELECT CAST(1 AS BIGINT) AS place, 'input_lines' AS name, CAST(count(*) AS DOUBLE) AS value FROM ids
  UNION ALL SELECT 2, 'books_aggregated', count(*) FROM usable
  UNION ALL SELECT 3, 'dropped_lines', (SELECT count(*) FROM ids) - (SELECT count(*) FROM usable)
  UNION ALL SELECT 4, 'bestseller_books', coalesce((SELECT n FROM sizes WHERE cohort = 'bestseller'), 0)
  UNION ALL SELECT 5, 'standard_books', coalesce((SELECT n FROM sizes WHERE cohort = 'standard'), 0)
  UNION ALL SELECT 6, 'version', 1)
UNION ALL SELECT 'dropped', 1, 'missing_or_invalid_cohort', CAST(count(*) AS DOUBLE), NULL
  FROM ids LEFT JOIN meta USING (doc_id) WHERE is_bestseller IS NULL HAVING count(*) > 0
UNION ALL SELECT CASE family WHEN 'scalar' THEN 'delta' ELSE 'syntactic_delta' END,
  row_number() OVER (PARTITION BY family ORDER BY metric), metric, round(d, 3), direction FROM compared
UNION ALL SELECT cohort || CASE family WHEN 'scalar' THEN '_means' ELSE '_syntactic_means' END,
  row_number() OVER (PARTITION BY cohort, family ORDER BY CASE WHEN family = 'scalar' THEN CASE metric {_SCALAR_PLACES} END END, metric),
  metric, round(mean, 3), NULL FROM means
UNION ALL SELECT cohort || '_sums', row_number() OVER (PARTITION BY cohort ORDER BY metric),
  metric, round(total, 3), NULL FROM means WHERE family = 'scalar'"""


SUMMARY = _summary(REC)

# Documents that lack some of their parts.
_PARTIAL = _rec(
    meta=META.replace("ON d.doc_id = l.doc_id", "ON d.doc_id = l.doc_id WHERE d.doc_id % 7 >= 2"),
    words="doc_id % 3 <> 0 AND doc_id % 11 <> 0", scored="doc_id % 2 <> 0 AND doc_id % 11 <> 0",
    measured="doc_id % 5 <> 0 AND doc_id % 11 <> 0")

# Files of every second document out of twenty, three of four listed, and a missing one for each twenty.
_SHELF = """shelf AS (
  SELECT book AS doc_id, 'shelf' AS source, string_agg(text, chr(10) ORDER BY place) AS text
  FROM (SELECT doc_id // 20 * 2 + doc_id % 2 AS book, doc_id AS place, text FROM documents) GROUP BY book),
"""
_LISTED = _rec(
    meta="""meta AS (
  SELECT doc_id, 'Volume ' || doc_id || chr(10) || '"of many", complete' AS title, 'A' || abs(doc_id) % 5 AS author,
    CASE WHEN abs(doc_id) % 3 < 2 THEN CAST(abs(doc_id) % 3 AS VARCHAR) END AS is_bestseller
  FROM (SELECT doc_id FROM documents WHERE doc_id % 4 <> 3
        UNION SELECT -1 - doc_id // 2 FROM documents))""",
    words="doc_id % 4 <> 3", scored="doc_id % 4 <> 3", measured="doc_id % 4 <> 3",
).replace("FROM documents", "FROM shelf")

_PLACES = " ".join(f"WHEN '{m}' THEN {i}" for i, m in enumerate(REPORT_FIRST, 1))


def _report(position: str) -> str:
    shown = lambda c: f"CASE WHEN {c} IS NULL THEN 'NA' ELSE printf('%.4f', round({c}, 4) + 0.0) END"
    return f"""WITH {COMPARED}, placed AS (
  SELECT *, row_number() OVER (ORDER BY CASE metric {_PLACES} ELSE 99 END, metric) AS position
  FROM compared WHERE family = 'scalar')
SELECT {position} metric, {shown('b')} AS bestseller_mean, {shown('s')} AS standard_mean,
  {shown('d')} AS delta, coalesce(direction, 'NA') AS direction
FROM placed WHERE position <= 6"""


PATHS = r"""paths AS (
  SELECT CASE doc_id % 8 WHEN 0 THEN '/output/word-freq/' WHEN 1 THEN '/Output/COMP2/'
      WHEN 2 THEN '/out/syntax/' WHEN 3 THEN '/data/Metadata/' WHEN 4 THEN '/output/misc/'
      WHEN 5 THEN '/runs/component3/wordfreq/' WHEN 6 THEN 'C:\runs\meta\'
      ELSE '/out/sentiment_meta/' END ||
    CASE (doc_id // 8) % 6 WHEN 0 THEN doc_id || '/part-00000' WHEN 1 THEN doc_id || '_output.txt'
      WHEN 2 THEN 'part-output' WHEN 3 THEN source || ' of ' || lang || '.tar.txt'
      WHEN 4 THEN '.' || lang ELSE '12/x/' || doc_id || '/a/b.txt' END AS path
  FROM documents
  UNION ALL SELECT url FROM pages)"""

_COMPONENT = "CASE " + " ".join(
    f"WHEN regexp_matches(lower(path), '{'|'.join(keys)}') THEN '{name}'"
    for name, keys in COMPONENT_KEYWORDS.items()) + " ELSE 'unknown' END"

_BASE = "string_split(path, '/')[-1]"

_OUTPUT_LINES = f"""{WF}, {META}, shaped AS (
  SELECT doc_id, word, n, (length(word) + doc_id) % 6 AS layout, doc_id % 5 AS kind FROM wf),
parsed AS (
  SELECT doc_id, CASE kind WHEN 0 THEN 'sentiment' WHEN 1 THEN 'syntactic' WHEN 2 THEN 'other'
                 ELSE 'wordfreq' END AS component, layout, word, n FROM shaped)"""


# What each of the twelve record lines of the derived input is worth.
LINES = """bad AS (
  SELECT d.doc_id, d.n_chars, d.source, l.quality,
    CASE d.doc_id % 14
      WHEN 0 THEN 'empty_line' WHEN 1 THEN 'no_tab_separator' WHEN 2 THEN 'malformed_json'
      WHEN 3 THEN 'not_a_json_object' WHEN 4 THEN 'missing_or_invalid_cohort'
      WHEN 6 THEN CASE WHEN l.quality IS NULL THEN 'malformed_json' ELSE 'missing_or_invalid_cohort' END
      WHEN 7 THEN 'missing_or_invalid_cohort' WHEN 8 THEN 'missing_or_invalid_cohort'
      ELSE CASE WHEN l.quality IN (0, 1) THEN NULL ELSE 'missing_or_invalid_cohort' END
    END AS drop_reason
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

CHECKS = f"""{WF}, {LEX}, {_sent('lex')}, {META},
checks AS (
  SELECT m.doc_id, m.is_bestseller,
    CASE WHEN w.n IS NOT NULL AND m.doc_id % 7 <> 0 THEN 1 ELSE 0 END AS wordfreq_ok,
    CASE WHEN m.doc_id % 7 = 0 THEN 0 ELSE coalesce(w.n, 0) END AS unique_words,
    CASE WHEN m.doc_id % 7 = 1 THEN 0 ELSE 1 END AS sentiment_ok,
    {_POLARITY4} AS polarity
  FROM meta m JOIN sent USING (doc_id)
  LEFT JOIN (SELECT doc_id, count(*) AS n FROM wf GROUP BY doc_id) w USING (doc_id))"""

VOLUMES = """SELECT doc_id // 100 AS volume,
  CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS n_lines,
  CAST(sum(len(list_filter(regexp_extract_all(lower(text), '[a-z]+'), lambda w: length(w) > 1))) AS BIGINT)
    AS n_words
FROM documents GROUP BY doc_id // 100"""

_BODY = """SELECT doc_id, CAST(len(string_split(text, chr(10))) AS BIGINT) AS n_lines,
  CAST(length(text) + 1 AS BIGINT) AS n_chars, md5(text || chr(10)) AS body_md5 FROM documents"""

_N = "len(string_split(text, chr(10)))"

ORACLES: dict[str, str] = {
    "wordfreq_corpus": f"WITH {TOK} SELECT word, count(*) AS n FROM tok GROUP BY word",
    "wordfreq_by_doc": f"WITH {WF} SELECT doc_id, word, n FROM wf",
    "top20_corpus": f"WITH {TOK} SELECT word, count(*) AS n FROM tok GROUP BY word "
                    "ORDER BY n DESC, word DESC LIMIT 20",
    "top20_by_doc": f"""WITH {WF} SELECT doc_id, CAST(rk AS INTEGER) AS rank, word, n FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rk FROM wf) WHERE rk <= 20""",
    "top20_by_source": f"""WITH {TOK}, c AS (
  SELECT source, word, count(*) AS n FROM tok GROUP BY source, word)
SELECT source, CAST(rk AS INTEGER) AS rank, word, n FROM (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS rk FROM c) WHERE rk <= 20""",
    "word_totals_by_doc": f"""WITH {WF} SELECT d.doc_id, CAST(sum(n) AS BIGINT) AS total_word_count,
  nullif(count(n), 0) AS unique_word_count
FROM documents d LEFT JOIN wf ON d.doc_id = wf.doc_id GROUP BY d.doc_id""",
    "body_strict": _BODY,
    "body_lenient": _BODY,
    "body_edge_cases": f"""SELECT doc_id, doc_id % 8 AS variant,
  CAST(CASE doc_id % 8 WHEN 1 THEN {_N} - (text = '' OR text LIKE '%' || chr(10))::INT WHEN 2 THEN {_N}
    WHEN 5 THEN 2 * {_N} + 1 WHEN 6 THEN {_N} WHEN 7 THEN {_N} ELSE 0 END AS BIGINT) AS strict_lines,
  CAST(CASE doc_id % 8 WHEN 1 THEN length(text) WHEN 2 THEN length(text) + 1
    WHEN 5 THEN 2 * (length(text) + 1) + {len(START) + 1} WHEN 6 THEN length(text) + 1
    WHEN 7 THEN length(text) + 1 ELSE 0 END AS BIGINT) AS strict_chars,
  CAST(CASE doc_id % 8 WHEN 1 THEN {_N} - (text = '' OR text LIKE '%' || chr(10))::INT WHEN 2 THEN {_N}
    WHEN 3 THEN {_N} WHEN 5 THEN 2 * {_N} + 1 WHEN 6 THEN {_N} WHEN 7 THEN {_N} ELSE 0 END AS BIGINT) AS lenient_lines,
  CAST(CASE doc_id % 8 WHEN 1 THEN length(text) WHEN 2 THEN length(text) + 1
    WHEN 3 THEN length(text) + 1 WHEN 5 THEN 2 * (length(text) + 1) + {len(START) + 1}
    WHEN 6 THEN length(text) + 1 WHEN 7 THEN length(text) + 1 ELSE 0 END AS BIGINT) AS lenient_chars
FROM documents""",
    "body_line_numbers": r"""SELECT doc_id, i - 1 AS line_no, CAST(length(line) AS BIGINT) AS n_chars,
  CASE WHEN regexp_matches(line, '\S') THEN 0 ELSE 1 END AS blank
FROM (SELECT doc_id, unnest(lines) AS line, unnest(generate_series(1, len(lines))) AS i FROM (
  SELECT doc_id, string_split(regexp_replace(text, '\n\z', ''), chr(10)) AS lines FROM documents WHERE text <> ''))""",
    "sentiment_by_doc": f"WITH {TOK}, {LEX}, {_sent('lex')} SELECT doc_id, {_sentiment_row(_POLARITY)} FROM sent",
    "sentiment_by_doc_large_lexicon": f"""WITH {TOK}, vocab AS (
  SELECT DISTINCT word AS term, {_SCORE.format('word')} AS score FROM tok), {_sent('vocab')}
SELECT doc_id, {_sentiment_row(_POLARITY)} FROM sent""",
    "sentiment_rollup": f"""WITH {TOK}, {LEX}, {_sent('lex')}, wide AS (
  SELECT {_sentiment_row(_POLARITY)} FROM sent)
SELECT metric, round(sum(value), 4) AS value
FROM (UNPIVOT wide ON {', '.join(SENTIMENT_METRICS)} INTO NAME metric VALUE value) GROUP BY metric""",
    "syntactic_counts": f"""WITH {_c3('doc_id')} SELECT k AS doc_id, sentence_count, word_count, char_count,
  syllable_count, complex_word_count, unique_word_count FROM c3""",
    "readability": f"WITH {_c3('doc_id')} SELECT k AS doc_id, {_READ} FROM c3",
    "unique_words": f"""SELECT DISTINCT doc_id, w AS word FROM (
  SELECT doc_id, unnest({_WORDS}) AS w FROM documents)
WHERE length(w) > 1 AND w NOT IN ({_list(VOCABULARY_STOPWORDS)})""",
    "syntactic_by_source": f"WITH {_c3('source')} SELECT k AS source, {_READ} FROM c3",
    "metrics_unpivot": f"""WITH {_c3('doc_id')}, wide AS (
  SELECT k AS doc_id, {_READ.replace('word_count, sentence_count, unique_word_count,',
         'CAST(word_count AS DOUBLE) AS word_count, CAST(sentence_count AS DOUBLE) AS sentence_count, '
         'CAST(unique_word_count AS DOUBLE) AS unique_word_count,', 1)} FROM c3)
SELECT doc_id, metric, value
FROM (UNPIVOT wide ON {', '.join(SYNTACTIC_METRICS)} INTO NAME metric VALUE value)""",
    "path_components": f"WITH {PATHS} SELECT path, {_COMPONENT} AS component FROM paths",
    "path_book_ids": rf"""WITH {PATHS} SELECT path, coalesce(
  list_filter(regexp_split_to_array(path, '[/\\]'), lambda s: regexp_full_match(s, '[0-9]+'))[-1],
  nullif(regexp_extract({_BASE}, '[0-9]+'), ''), 'unknown') AS book_id FROM paths""",
    "stem_book_ids": rf"""WITH {PATHS} SELECT path, coalesce(nullif(regexp_replace(trim(
  CASE WHEN regexp_matches(ltrim({_BASE}, '.'), '\.') THEN regexp_replace({_BASE}, '\.[^.]*$', '')
       ELSE {_BASE} END), '\s+', '_', 'g'), ''), 'unknown') AS book_id FROM paths""",
    "facts_union": f"WITH {_FACTS} SELECT * FROM facts",
    "facts_from_lines": f"""WITH {_OUTPUT_LINES}
SELECT CAST(doc_id AS VARCHAR) AS book_id, component, word AS metric,
  CASE WHEN layout = 4 THEN n || '.5' ELSE CAST(n AS VARCHAR) END AS value
FROM parsed WHERE (component = 'wordfreq' AND layout IN (2, 5))
  OR (component = 'sentiment' AND layout IN (2, 4, 5))
UNION ALL
-- two or three fields, the last one a number; blanks around the tab stay in the name
SELECT CAST(doc_id AS VARCHAR), component, CASE WHEN layout = 2 THEN word || ' ' ELSE word END,
  CASE layout WHEN 4 THEN n || '.5' WHEN 2 THEN ' ' || n ELSE CAST(n AS VARCHAR) END
FROM parsed WHERE component = 'syntactic' AND layout IN (2, 3, 4, 5)
UNION ALL
SELECT CAST(doc_id AS VARCHAR), 'metadata', metric, value FROM (
  UNPIVOT (SELECT doc_id, title || ', "' || author || '"' AS title, author, is_bestseller
           FROM meta WHERE doc_id % 5 <> 0) ON title, author, is_bestseller INTO NAME metric VALUE value)""",
    "facts_dedup": f"""WITH {_FACTS}, every AS (
  SELECT * FROM facts UNION ALL SELECT book_id, component, metric, '1' || value FROM facts
  UNION ALL SELECT book_id, component, metric, value || 'x' FROM facts)
SELECT book_id, component, metric, max(value) AS value FROM every
WHERE component = 'metadata' OR regexp_full_match(value, '-?[0-9]+(\\.[0-9]+)?') GROUP BY book_id, component, metric""",
    "normalized_records": _FLAT,
    "direct_records": _FLAT,
    "record_preview": _flat(REC, after=" ORDER BY book_id LIMIT 10"),
    "partial_records": _flat(_PARTIAL),
    "partial_summary": _summary(_PARTIAL),
    "record_payloads": f"""WITH {LINES}
SELECT drop_reason,
  CASE WHEN drop_reason IS NULL THEN CASE quality WHEN 1 THEN 'bestseller' ELSE 'standard' END END AS cohort,
  CASE doc_id % 14 WHEN 0 THEN '' WHEN 1 THEN doc_id || ' no tab' ELSE CAST(doc_id AS VARCHAR) END AS book_id,
  CASE WHEN parsed THEN CASE WHEN doc_id % 14 = 13 THEN 'Zero, NaN: -Infinity, \\"' ELSE '' END || source
       WHEN doc_id % 14 = 4 THEN 'x' ELSE '' END AS title,
  CASE WHEN parsed THEN total END AS total_word_count,
  CASE WHEN parsed THEN CAST(1 AS BIGINT) END AS unique_word_count,
  CASE WHEN parsed AND total > 0 THEN 1.0::DOUBLE / total END AS type_token_ratio,
  CASE WHEN parsed THEN CAST(0.5 AS DOUBLE) END AS polarity_score, CAST(NULL AS DOUBLE) AS positive_count,
  CASE WHEN parsed THEN CAST(total AS DOUBLE) END AS a,
  CAST(CASE WHEN parsed THEN 1 ELSE 0 END AS BIGINT) AS n_syntactic
FROM (SELECT *, doc_id % 14 >= 5 AND NOT (doc_id % 14 = 6 AND quality IS NULL) AS parsed,
  CASE WHEN doc_id % 14 = 12 THEN CAST('90071992547' || lpad(CAST(doc_id AS VARCHAR), 7, '1') AS BIGINT)
       ELSE n_chars END AS total FROM bad)""",
    "drop_reasons": f"""WITH {LINES} SELECT drop_reason, count(*) AS n FROM bad
WHERE drop_reason IS NOT NULL GROUP BY drop_reason""",
    "record_counts": f"""WITH {LINES} SELECT count(*) AS input_lines,
  count(*) FILTER (WHERE drop_reason IS NULL) AS books_aggregated,
  count(*) FILTER (WHERE drop_reason IS NOT NULL) AS dropped_lines FROM bad""",
    "cohort_scalars": f"""WITH {MEANS} SELECT cohort, metric, n_books, round(total, 3) AS total,
  round(mean, 3) AS mean FROM means WHERE family = 'scalar'""",
    "cohort_syntactic": f"""WITH {MEANS} SELECT cohort, metric, n_books, round(total, 3) AS total,
  round(mean, 3) AS mean FROM means WHERE family = 'syntactic'""",
    "cohort_deltas": f"""WITH {COMPARED} SELECT family, metric, round(b, 3) AS bestseller_mean,
  round(s, 3) AS standard_mean, round(d, 3) AS delta, direction FROM compared""",
    "cohort_report": _report("position,"),
    "cohort_summary": SUMMARY,
    "output_validation": f"""WITH {CHECKS} SELECT doc_id, wordfreq_ok, unique_words, sentiment_ok, polarity
FROM checks""",
    "validation_totals": f"""WITH {CHECKS} SELECT count(*) AS books_tested,
  count(*) FILTER (WHERE wordfreq_ok = 0) AS wordfreq_errors,
  count(*) FILTER (WHERE sentiment_ok = 0) AS sentiment_errors FROM checks""",
    "polarity_gap": f"""WITH {CHECKS}, g AS (
  SELECT count(*) FILTER (WHERE is_bestseller = '1' AND sentiment_ok = 1) AS bn,
    avg(polarity) FILTER (WHERE is_bestseller = '1' AND sentiment_ok = 1) AS b,
    count(*) FILTER (WHERE is_bestseller = '0' AND sentiment_ok = 1) AS sn,
    avg(polarity) FILTER (WHERE is_bestseller = '0' AND sentiment_ok = 1) AS s FROM checks)
SELECT bn AS bestseller_books, round(coalesce(b, 0.0), 5) AS bestseller_polarity, sn AS standard_books,
  round(coalesce(s, 0.0), 5) AS standard_polarity, round(b - s, 5) AS gap,
  CASE WHEN b - s > 0 THEN 'more positive' WHEN b - s IS NOT NULL THEN 'more negative' END AS direction
FROM g""",
    "present_books": "SELECT doc_id, source AS title FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)",
    "missing_books": "SELECT doc_id, source AS title FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "book_sizes": """SELECT d.doc_id, source AS title, n_chars // 1024 AS size_kb
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
    "listing_totals": """SELECT count(*) AS books_listed, count(l.doc_id) AS books_present,
  count(*) - count(l.doc_id) AS books_missing
FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
    "written_word_counts": f"""WITH {WF} SELECT 'wordfreq' AS component, doc_id || ':' || word AS metric, n FROM wf""",
    "written_word_tables": f"WITH {WF} SELECT doc_id, word, n FROM wf",
    "written_components": f"""WITH {TOK}, {LEX}, {_sent('lex')}, wide AS (
  SELECT {_sentiment_row(_POLARITY)} FROM sent), counts AS (SELECT word, CAST(count(*) AS VARCHAR) AS n FROM tok GROUP BY word)
SELECT 'wordfreq' AS component, word AS metric, n AS value FROM counts
UNION ALL SELECT 'as sentiment', word, n FROM counts
UNION ALL SELECT 'sentiment', metric, printf('%.4f', round(sum(value), 4))
FROM (UNPIVOT wide ON {', '.join(SENTIMENT_METRICS)} INTO NAME metric VALUE value) GROUP BY metric""",
    "written_metrics": f"""WITH {_c3('doc_id')}, r4 AS (SELECT {_READ4} FROM c3)
SELECT 'syntactic' AS component, metric, count(*) AS n, CAST(sum(CAST(printf('%.4f', value) AS DECIMAL(18, 4))) AS DOUBLE) AS total
FROM (UNPIVOT r4 ON {', '.join(SYNTACTIC_METRICS)} INTO NAME metric VALUE value) GROUP BY metric""",
    "written_lexicon": f"""WITH {LEX}
SELECT term, CAST(CASE WHEN length(term) % 4 IN (0, 1) THEN score + 20 ELSE score END AS INTEGER) AS score FROM lex""",
    "written_metadata_first": """SELECT CAST(doc_id AS VARCHAR) AS book_id, source AS title, doc_id || '.txt' AS filename
FROM documents ORDER BY documents.doc_id LIMIT 50""",
    "written_metadata": f"""WITH {META} SELECT CAST(doc_id AS VARCHAR) AS book_id,
  title || ', "' || author || '"' AS title, author, coalesce(is_bestseller, '') AS is_bestseller,
  doc_id || '.txt' AS filename FROM meta""",
    "written_metadata_lines": f"""WITH {META} SELECT CAST(doc_id AS VARCHAR) AS book_id,
  title || ', "' || author || '"' AS title, author, coalesce(is_bestseller, '') AS is_bestseller FROM meta""",
    "written_records": f"""WITH {REC}, tops AS (
  SELECT doc_id, '[' || string_agg('["' || word || '",' || n || ']', ',' ORDER BY n DESC, word) || ']' AS top FROM (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, word) AS rk FROM wf) WHERE rk <= 20 GROUP BY doc_id)
SELECT md5(top) AS top_md5, CAST(m.doc_id AS VARCHAR) AS book_id,
  CASE WHEN is_bestseller IS NULL THEN 'missing_or_invalid_cohort' END AS drop_reason,
  CASE is_bestseller WHEN '1' THEN 'bestseller' WHEN '0' THEN 'standard' END AS cohort, title, author,
  total AS total_word_count, uniq AS unique_word_count,
  CASE WHEN total > 0 THEN CAST(uniq AS DOUBLE) / total END AS type_token_ratio,
  {', '.join(SENTIMENT_METRICS)}, CAST(9 AS BIGINT) AS n_syntactic,
  {', '.join(f'r.{m} AS syntactic_{m}' for m in SYNTACTIC_METRICS)}
FROM meta m JOIN s4 USING (doc_id) JOIN r4 r USING (doc_id) LEFT JOIN totals USING (doc_id) LEFT JOIN tops USING (doc_id)""",
    "written_summary": SUMMARY,
    "written_report": _report(""),
    "written_volumes": VOLUMES,
    "written_volumes_by_line": VOLUMES,
    "written_inventory": f"""SELECT doc_id // 100 AS volume, CAST(1 AS BIGINT) AS n_files,
  CAST((sum(strlen(text) + 1) + {len(f'front {START} {END} tail ')}) // 1024 AS BIGINT) AS size_kb
FROM documents GROUP BY doc_id // 100""",
    "written_corpus_run": _flat(_LISTED, _SHELF),
    "written_corpus_summary": _summary(_LISTED, _SHELF),
    "records_by_line": _flat(_LISTED, _SHELF),
}
