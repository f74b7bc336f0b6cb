"""SQL of the training-data queries that SQL can express (DuckDB)."""

from __future__ import annotations

from prosestat.llm import chat, quality
from prosestat.llm.queries import DOMAIN_WEIGHTS, EPOCHS, LANG_WEIGHTS, MIX_PERCENT, MIX_SEED, TOP_PHRASES


def _cases(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"


def _budgets(levels: tuple[str, ...]) -> str:
    """One pair of table expressions per level: nodes in filling order, and what each gets."""
    out = []
    for depth, level in enumerate(levels):
        path, above = ", ".join(levels[: depth + 1]), ", ".join(levels[:depth])
        family = f"PARTITION BY {above}" if depth else ""
        source = f"(SELECT s.*, b.got AS t FROM supply s JOIN got{depth} b USING ({above}))" if depth else "(SELECT *, wanted AS t FROM supply)"
        out.append(f"""
        nodes{depth} AS (SELECT {path}, max(w_{level}) AS w, sum(capacity) AS c, max(t) AS t FROM {source} GROUP BY {path}),
        filled{depth} AS (SELECT *, coalesce(sum(c) OVER before, 0) AS c_before,
            sum(w) OVER ({family}) - coalesce(sum(w) OVER before, 0) AS w_left FROM nodes{depth}
            WINDOW before AS ({family} ORDER BY c::DOUBLE / nullif(w, 0) NULLS LAST, {level} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        opened{depth} AS (SELECT *, max(CASE WHEN w > 0 AND c::HUGEINT * w_left <= w::HUGEINT * greatest(t - c_before, 0) THEN 0 ELSE 1 END)
            OVER ({family} ORDER BY c::DOUBLE / nullif(w, 0) NULLS LAST, {level} ROWS UNBOUNDED PRECEDING) AS open FROM filled{depth}),
        shared{depth} AS (SELECT *, t - sum(CASE WHEN open = 0 THEN c ELSE 0 END) OVER ({family}) AS rest,
            sum(CASE WHEN open = 1 THEN w ELSE 0 END) OVER ({family}) AS w_open,
            sum(CASE WHEN open = 1 THEN w ELSE 0 END) OVER ({family} ORDER BY {level} ROWS UNBOUNDED PRECEDING) AS w_to FROM opened{depth}),
        got{depth + 1} AS (SELECT {path}, least(c, CASE WHEN open = 0 THEN c ELSE coalesce(rest::HUGEINT * w_to // nullif(w_open, 0)
            - rest::HUGEINT * (w_to - w) // nullif(w_open, 0), 0) END) AS got FROM shared{depth})""")
    return ",".join(out)


LEVELS = ("domain", "lang", "source")
MIXING = f"""
WITH docs AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, (strlen(coalesce(text, '')) + 3) // 4 AS tokens FROM documents),
placed AS (SELECT *, CASE WHEN d < '4' THEN 'web' WHEN d < '8' THEN 'books' WHEN d < 'c' THEN 'forum' ELSE 'code' END AS domain
    FROM (SELECT *, substr(md5(source), 1, 1) AS d FROM docs)),
summed AS (SELECT domain, lang, source, sum(tokens)::HUGEINT AS supply, {_cases('domain', DOMAIN_WEIGHTS)} AS w_domain, {_cases('lang', LANG_WEIGHTS)} AS w_lang,
    1 AS w_source FROM placed GROUP BY domain, lang, source),
supply AS (SELECT *, supply * {EPOCHS} AS capacity, least(sum(supply) OVER () * {MIX_PERCENT} // 100, sum(supply) OVER () * {EPOCHS}) AS wanted FROM summed),
{_budgets(LEVELS)},
leaves AS (SELECT *, CASE WHEN supply > 0 THEN got // supply ELSE 0 END AS epochs, CASE WHEN supply > 0 THEN got % supply ELSE 0 END AS rest
    FROM supply JOIN got3 USING (domain, lang, source)),
ordered AS (SELECT p.*, l.epochs, l.rest, md5(concat_ws(':', '{MIX_SEED}', l.epochs::VARCHAR, coalesce(p.doc_id::VARCHAR, 'null'))) AS place
    FROM placed p JOIN leaves l USING (domain, lang, source)),
running AS (SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY place) AS upto FROM ordered)
SELECT doc_id, domain, lang, source, tokens::BIGINT AS tokens, (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::INTEGER AS copies FROM running
"""

_WHITE = r"[\x20\x09-\x0D]+"
_TRIES = " UNION ALL ".join(
    f"SELECT *, '{rule}' AS rule, {cut} AS cutoff, {part} * {scale} > {cut} * {per} AS out FROM used"
    for rule, ((part, scale, per), ladder) in quality.RULES.items() for cut in ladder)
_LIMITS = ", ".join(f"max(cutoff) FILTER (rule = '{r}') AS {r}" for r in quality.RULES)
_OUT = " OR ".join(f"coalesce({part} * {scale} > l.{rule} * {per}, FALSE)" for rule, ((part, scale, per), _) in quality.RULES.items())
_RULES = ", ".join(quality.RULES)
_LEVELS = ", ".join(f"({i}, {ppm})" for i, ppm in enumerate(quality.tolerances(quality.RISK)))
_TUNED = ", ".join(f"count(*) FILTER ({which} AND NOT held{also}) AS {name}{end}" for name, which in (("good", "good"), ("bad", "NOT good"))
                   for end, also in (("_n", ""), ("_out", " AND out")))
_FAILED = "(n_words < 50 OR 100 * n_repeat_words > 50 * n_words)"
QUALITY = rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '{_WHITE}'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
numbered AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times FROM numbered),
covered AS (SELECT doc_id, sum(least(3, coalesce(i - before, 3))) AS n FROM
    (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM windows WHERE times > 1) GROUP BY doc_id),
measured AS MATERIALIZED (SELECT doc_id, stratum, len(words)::BIGINT AS n_words,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines, len(list_filter(words, lambda w: ends_with(w, '!!')))::BIGINT AS n_shouts,
    coalesce(length(list_aggregate(words, 'string_agg', '')), 0)::BIGINT AS word_chars FROM docs LEFT JOIN covered c USING (doc_id)),
used AS (SELECT m.*, quality = 1 AS good, substr(md5(doc_id::VARCHAR), 1, 1) >= '8' AS held FROM measured m JOIN labels USING (doc_id)
    WHERE quality IS NOT NULL AND NOT {_FAILED}),
counted AS (SELECT stratum, rule, cutoff, {_TUNED} FROM ({_TRIES}) GROUP BY ALL),
levels AS (SELECT * FROM (VALUES {_LEVELS}) AS x(level, ppm)),
picked AS (SELECT stratum, level, rule, arg_max(cutoff, (bad_out * good_n - good_out * bad_n) * 100000 + cutoff) AS cutoff FROM counted, levels
    WHERE bad_out * good_n - good_out * bad_n > 0 AND good_out * 1000000 <= good_n * ppm GROUP BY ALL),
proposed AS (SELECT stratum, level, {_LIMITS} FROM picked GROUP BY stratum, level),
tried AS (SELECT u.*, level, {_RULES}, {_OUT} AS out FROM used u JOIN proposed l USING (stratum)),
tested AS (SELECT stratum, level, {_RULES}, count(*) FILTER (good AND held) AS n, count(*) FILTER (good AND held AND out) AS k, {_TUNED} FROM tried GROUP BY ALL),
judged AS (SELECT *, count(*) OVER () AS tests, CASE WHEN k > n * {quality.RISK} THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
    lambda i: exp(lgamma(n + 1) - (CASE WHEN i > 0 THEN lgamma(i + 1) ELSE 0 END) - (CASE WHEN n > i THEN lgamma(n - i + 1) ELSE 0 END)
        + i * ln({quality.RISK}) + (n - i) * ln(1 - {quality.RISK})))) END AS p FROM tested),
limits AS (SELECT * FROM judged WHERE p <= {quality.ERROR} / tests AND bad_out * good_n - good_out * bad_n > 0
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY bad_out * good_n - good_out * bad_n DESC, level DESC) = 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {_FAILED} AS base_failed, NOT ({_FAILED} OR {_OUT}) AS kept
FROM measured LEFT JOIN limits l USING (stratum)
"""

_ESCAPED = r"""regexp_replace(regexp_replace(replace({0}, '\', '\b'), '(<)(/?s>)', '\1\\e\2', 'g'), '(\[)(/?(?:SYS|INST|OUT|ROLE))', '\1\\e\2', 'g')"""


def _template_length() -> str:
    """Characters of the marks around a turn; other roles carry their name."""
    other = sum(map(len, chat.OTHER))
    named = " ".join(f"WHEN '{r}' THEN {len(a) + len(b)}" for r, (a, b) in chat.TEMPLATE.items())
    role = _ESCAPED.format("role")
    return f"CASE role {named} ELSE {other} + length(replace({role}, ']', '\\r')) END"


CHAT = f"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
sized AS (SELECT *, row_number() OVER w AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    sum(length({_ESCAPED.format('text')}) + {_template_length()}) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS upto
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
    sum(upto) FILTER (role = 'assistant' OR i = n)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

PASSAGES = rf"""
WITH docs AS MATERIALIZED (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '{_WHITE}'), lambda x: x <> '') AS words FROM documents),
places AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM docs),
windows AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(words[i : i + 49], ' ')) AS w FROM places),
gone AS (SELECT DISTINCT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS first FROM windows) WHERE first < doc_id),
cut AS (SELECT doc_id, list(DISTINCT i + d) AS places FROM (SELECT doc_id, i, unnest(range(0, 50)) AS d FROM gone) GROUP BY doc_id),
kept AS (SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed, CASE WHEN places IS NULL THEN words ELSE list_select(words,
    list_sort(list_filter(range(1, len(words) + 1), lambda j: NOT list_contains(places, j)))) END AS left_words FROM docs LEFT JOIN cut USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed, sha256(array_to_string(left_words, ' ')) AS kept_sha256 FROM kept
"""

PHRASES = rf"""
WITH pieces AS (SELECT lang, row_number() OVER () AS piece, p FROM (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
split AS (SELECT lang, piece, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
placed AS MATERIALIZED (SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split)),
f AS MATERIALIZED (SELECT lang, 1 AS size, w1 AS phrase, count(*) AS n FROM placed GROUP BY ALL
    UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM placed WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM placed WHERE w3 IS NOT NULL GROUP BY ALL),
words AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
candidates AS MATERIALIZED (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND n >= 10),
cuts AS (SELECT *, array_to_string(w[1 : k], ' ') AS first, array_to_string(w[k + 1 : size], ' ') AS rest FROM
    (SELECT *, unnest(range(1, size)) AS k FROM candidates)),
scored AS (SELECT c.lang, c.size, c.phrase, a, k, x.n AS l, y.n AS r, ((1000000::HUGEINT * a * a) // (x.n::HUGEINT * y.n))::BIGINT AS score
    FROM cuts c JOIN f x ON c.lang = x.lang AND c.first = x.phrase JOIN f y ON c.lang = y.lang AND c.rest = y.phrase),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, phrase, max(a) AS around FROM (SELECT lang, unnest([array_to_string(w[1 : 2], ' '), array_to_string(w[2 : 3], ' ')]) AS phrase, a
    FROM candidates WHERE size = 3) GROUP BY ALL),
kept AS (SELECT b.lang, b.phrase, a, l, r, words.n, score FROM best b JOIN words USING (lang) LEFT JOIN around o ON o.lang = b.lang AND o.phrase = b.phrase
    WHERE b.size = 3 OR coalesce(100 * around < 50 * a, TRUE))
SELECT lang, (row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase))::INTEGER AS rank, phrase, a, l, r, n, score FROM kept
QUALIFY rank <= {TOP_PHRASES}
"""

NEGATIVES = """
WITH rows AS MATERIALIZED (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (SELECT a.id AS anchor_id, r.id, r.label = a.label AS same, list_dot_product(a.v, r.v)::BIGINT AS score
    FROM rows a JOIN rows r ON a.id % 100 = 0 AND a.id <> r.id AND len(a.v) = len(r.v)),
positives AS (SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, (row_number() OVER w)::INTEGER AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) QUALIFY rank <= 5
"""

ORACLES = {"op2_mixing": MIXING, "op4_quality": QUALITY, "op7_chat": CHAT, "op11_phrases": PHRASES, "op12_negatives": NEGATIVES, "op13_passages": PASSAGES}
