"""The training-data operators against plain versions, round trips and edge cases."""

import hashlib
import random
import re
from math import comb

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from prosestat.llm import bpe, chat, language, mixing, neighbours, pages, quality, secrets, sharding, simhash
from prosestat.llm.queries import TOKENIZER
from prosestat.llm.shared import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ODD = [None, "", " \n\t ", "a", "one two three four one two three four", "x" * 50_000, "é😀<|endoftext|> it's\x85\x1c 12\n\n b"]


def docs_of(spark, texts, extra=False):
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s2", None][i % 3], len(t or "")) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, DOCS)
    clash = {"ids": F.lit("x"), "text_": F.lit("y"), "stratum": F.lit(1), "tokens": F.lit(2), "bits": F.lit(3), "size": F.lit(4)}
    return df.withColumns(clash) if extra else df


def words_of(seed, n, words=("alpha", "beta", "gamma", "delta", "eps", "zeta", "eta", "theta", "iota", "kappa")):
    rng = random.Random(seed)
    return " ".join(rng.choice(words) for _ in range(n))


def test_bpe_equals_the_library_and_decodes_back(spark):
    from tokenizers import Tokenizer
    reference = Tokenizer.from_file(TOKENIZER)
    rng = random.Random(3)
    texts = ODD + ["".join(rng.choice(list("ab  \n\t'sé7!😀") + ["<|endoftext|>", "'ll"]) for _ in range(30)) for _ in range(200)]
    got = bpe.decode(bpe.encode(docs_of(spark, texts, extra=True), TOKENIZER), TOKENIZER).collect()
    for r in got:
        want = reference.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.n_tokens == len(want)
        assert r.decoded == reference.decode(want, skip_special_tokens=False) == (texts[r.doc_id] or "")
    assert len(got) == len(texts)
    once = bpe.encode(docs_of(spark, texts, extra=True), TOKENIZER, decoded=True).collect()
    assert sorted(map(tuple, once)) == sorted(map(tuple, got))


def plain_groups(prints):
    ids = sorted(prints)
    root = {i: i for i in ids}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 2:
                x, y = sorted((top(a), top(b)))
                root[y] = x
    return {i: top(i) for i in ids}


def plain_print(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("cap", [64, 2])
def test_simhash_groups_equal_all_pairs(spark, cap):
    base = words_of(1, 400)
    texts = ODD + [words_of(i, 30) for i in range(20)] + [base] * 5 + [base + f" x{i}" for i in range(30)] + [base.upper()]
    got = simhash.near_groups(docs_of(spark, texts, extra=True), posting_cap=cap).collect()
    prints = {i: plain_print(t) for i, t in enumerate(texts)}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == plain_groups(prints)


def test_simhash_rows_without_an_id(spark):
    same, lone = words_of(1, 40), words_of(2, 40)
    df = spark.createDataFrame([(7, same), (None, same), (3, same), (None, lone)], "doc_id long, text string")
    got = sorted(map(tuple, simhash.near_groups(df).select(F.col("doc_id").isNull(), "doc_id", "component_id").collect()), key=str)
    assert got == sorted([(False, 7, 3), (True, None, 3), (False, 3, 3), (True, None, None)], key=str)


def test_simhash_links_planted_fingerprints_also_in_hot_postings(spark):
    rng = random.Random(5)
    planted = {rng.getrandbits(64) for _ in range(20)}
    planted |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for p in list(planted) for _ in range(6)}
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in planted]
    for cap in (1, 4, 1000):
        links = {(r.a, r.b) for r in simhash.links(spark.createDataFrame(signed, "bits long"), cap).collect()}
        root = {s: s for (s,) in signed}

        def top(i):
            while root[i] != i:
                i = root[i]
            return i
        for a, b in links:
            x, y = sorted((top(a), top(b)))
            root[y] = x
        parts = plain_groups({s: s & (1 << 64) - 1 for (s,) in signed})
        assert {s: top(s) for (s,) in signed} == parts


def test_simhash_one_row_of_each_group(spark):
    one, two, lone = words_of(1, 40), words_of(2, 40), words_of(3, 40)
    rows = [(7, one, 1), (7, one, 2), (9, one, 3), (None, one, 4), (None, two, 5), (None, two, 6), (4, lone, 7), (None, lone, 8), (5, None, 9), (6, " ", 9), (3, "", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long").withColumns({"bits": F.lit(1), "copy": F.lit("c")})
    got = simhash.one_of_each(df).collect()
    assert sorted([(r.doc_id, r.text) for r in got], key=str) == sorted([(7, one), (None, two), (4, lone), (3, "")], key=str)
    assert all((r.bits, r.copy) == (1, "c") for r in got) and simhash.one_of_each(df.limit(0)).count() == 0
    texts = ODD + [words_of(i % 12, 200) + (" x" if i > 20 else "") for i in range(40)]
    kept = {r.doc_id for r in simhash.one_of_each(docs_of(spark, texts, extra=True)).collect()}
    assert kept == set(plain_groups({i: plain_print(t) for i, t in enumerate(texts)}).values())


def test_secrets(spark):
    key = "AKIA" + "ABCDEFGH12345678"
    texts = ODD + ['Token = "abcdefabcdef1234" end', f"x {key} y", "ſecret=abcdefghijklmnop", "token: secret: abcdefghijkl", "f" * 15 + " " + "0a" * 8,
                   "use q7Rk2VxP9mLd4TzWb8NcYh3J now", "an ordinarylongwordwithoutanydigits here and/another/path/of/words2"]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in secrets.find(docs_of(spark, texts, extra=True)).collect()}
    n = len(ODD)
    assert all(not got[i] for i in range(n) if i != 5)
    assert got[n] == [("assign", 0, 25), ("hex", 9, 25)]
    assert got[n + 1] == [("access", 2, 22)] and not got[n + 2] and not got[n + 3] and got[n + 4] == [("hex", 16, 32)]
    assert got[n + 5] == [("random", 4, 28)] and not got[n + 6]
    clean = {r.doc_id: r for r in secrets.redact(docs_of(spark, texts)).collect()}
    assert clean[n + 1].text == "x [SECRET] y" and clean[n + 1].n_chars == 12 and clean[0].text is None and clean[3].text == "a"


@pytest.mark.parametrize("signs", ["0123456789abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyz234567", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"])
def test_secrets_of_one_case(signs):
    rng = random.Random(8)
    keys = ["".join(rng.choice(signs) for _ in range(40)) for _ in range(200)]
    found = [secrets.spans(f"use {k} now") for k in keys]
    assert sum(f == [(4, 44, "random")] for f in found) > 90
    assert not secrets.spans("in chapter12ofthebookaboutrivers and electroencephalographically")


def test_secrets_candidates_beside_base_spans():
    rng, key = random.Random(9), "q7Rk2VxP9mLd4TzWb8NcYh3J"
    for _ in range(50):
        parts = [rng.choice([key, "f0" * 10, "AKIA" + "ABCDEFGH12345678", "token=" + key, "word", key + "AKIA" + "0123456789ABCDEF"]) for _ in range(12)]
        text = " ".join(parts)
        got = secrets.spans(text)
        base = [s for s in got if s[2] != "random"]
        want = [m.span() for m in secrets.CANDIDATE.finditer(text) if not any(s < m.end() and m.start() < e for s, e, _ in base)]
        assert [s[:2] for s in got if s[2] == "random"] == want


def test_quality_measures_and_bound(spark):
    texts = ODD + ["a b c\na b c\n\nd # <", words_of(2, 60), "go go go go go go"]

    def plain(t):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit)
    labels = spark.createDataFrame([(0, None), (5, 1), (999, 0)], "doc_id long, quality int")
    got = quality.assess(docs_of(spark, texts, extra=True), labels).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got} == {i: plain(t) for i, t in enumerate(texts)}
    assert all(r.kept == (not r.base_failed) == (r.n_words >= 50 and 2 * r.n_repeat_words <= r.n_words) for r in got)
    tails = spark.createDataFrame([(k, n) for n in (0, 1, 40, 700) for k in (0, 1, 5) if k <= n], "k long, n long")
    for r in tails.withColumn("p", quality.binomial_tail(F.col("k"), F.col("n"), 0.02)).collect():
        exact = sum(comb(r.n, i) * 0.02 ** i * 0.98 ** (r.n - i) for i in range(r.k + 1)) if r.k <= r.n * 0.02 else 1.0
        assert r.p == pytest.approx(exact, rel=1e-9)


def test_quality_cutoffs_reject_bad_and_keep_good(spark):
    good = [words_of(i, 80, [f"w{j}" for j in range(400)]) for i in range(1200)]
    bad = [" ".join(w + "%%%" for w in words_of(i, 80, [f"w{j}" for j in range(400)]).split()) for i in range(200)]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + bad)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i < 1200)) for i in range(1400)], "doc_id long, quality int")
    kept = {r.doc_id for r in quality.passing(df, labels).collect()}
    assert kept == set(range(1200)) == {r.doc_id for r in quality.assess(df, labels).where("kept").collect()}
    clash = df.withColumns({"own_0": F.lit(1), "stratum": F.lit("x"), "m_": F.lit(2), "n_words": F.lit(3)})
    again = quality.passing(clash, labels).collect()
    assert {r.doc_id for r in again} == kept and {(r.own_0, r.stratum, r.m_, r.n_words) for r in again} == {(1, "x", 2, 3)}
    twice = quality.passing(df.where("doc_id < 3").unionByName(df.where("doc_id = 1")).withColumn("lang", F.lit(None).cast("string")), labels)
    assert sorted(r.doc_id for r in twice.collect()) == [0, 1, 1, 2]


FAULTS = {"signs_per_char": lambda w: [x + "%%%" for x in w], "repeats_per_word": lambda w: w[:40] + ["a", "b", "c"] * 12, "shouts_per_word": lambda w: [x + "!!" for x in w],
          "copied_lines_per_line": lambda w: w[:60] + ["\nsame1\nsame1\nsame1\nsame1\n"]}


def labelled(seed, strata=("en", "de"), n=1500):
    """Documents of two languages; bad ones have one fault each, a few good ones too."""
    rng, rows, labels = random.Random(seed), [], []
    for lang in strata:
        for i in range(n):
            good, words = i >= n // 5, [f"w{rng.randrange(4000)}" for _ in range(70)]
            if not good or rng.random() < 0.003:
                words = FAULTS[list(FAULTS)[i % 4]](words)
            rows.append((len(rows), " ".join(words), lang))
            labels.append((len(labels), int(good)))
    return rows, labels


def test_quality_with_cutoffs_of_every_rule_equals_sql(spark, tmp_path):
    import duckdb
    from prosestat.llm.oracles import QUALITY
    rows, labels = labelled(6)
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, known = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    limits = {r.stratum: r for r in quality.cutoffs(quality.assess(docs, known).join(docs.select("doc_id", F.col("lang").alias("stratum")), "doc_id"), known).collect()}
    assert set(limits) == {"en", "de"} and all(r[rule] is not None for r in limits.values() for rule in quality.RULES)
    got = quality.assess(docs, known).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    with duckdb.connect() as db:
        for t in ("documents", "labels"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        assert sorted(map(tuple, got)) == sorted(db.execute(QUALITY).fetchall())
    assert sum(not r.kept for r in got) > 500


def test_quality_bound_holds_for_all_rules_together(spark):
    """Each rule would reject a quarter of ``share`` of the good: what is admitted together rejects at most the risk."""
    def table(seed, share):
        rng, rows = random.Random(seed), []
        for stratum in range(6):
            for i in range(2400):
                good = i % 4 > 0
                rule = rng.randrange(4) if not good or rng.random() < share else None
                n = [1000 if rule == j else 0 for j in range(4)]
                rows.append((len(rows), f"{seed}-{stratum}", 100, 1000, n[0], n[2] // 100, n[1] // 25, 10, n[3] // 20, int(good)))
        return rows
    names = "doc_id long, stratum string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_shouts long, quality int"
    for share, least in ((0.05, 0), (0.03, 0), (0.003, 8)):
        df = spark.createDataFrame(table(1, share) + [(r[0] + 100_000, *r[1:]) for r in table(2, share)], names)
        admitted = [sum(r[rule] is not None for rule in quality.RULES) for r in quality.cutoffs(df, df.select("doc_id", "quality")).collect()]
        assert sum(n > 0 for n in admitted) >= least and all(n * share / 4 <= quality.RISK for n in admitted), (share, admitted)


def test_shards_are_a_sort_with_near_equal_bytes(spark):
    rng = random.Random(7)
    rows = [(i, "same" if i % 3 == 0 else words_of(i, rng.randrange(1, 60))) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.histogram_shards(df, F.col("text"), F.col("doc_id"), F.octet_length("text") + 8, 24, keep=("doc_id",)).collect()
    text = dict(rows)

    def key(i):
        return hashlib.md5(text[i].encode()).hexdigest()[:16] + hashlib.md5(str(i).encode()).hexdigest()[:16]
    in_order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.doc_id for r in in_order] == sorted(text, key=key)
    total = sum(len(t) + 8 for t in text.values())
    for s in range(24):
        own = [r for r in in_order if r.shard == s]
        assert [r.slot for r in own] == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / 24) < 800
    empty = sharding.histogram_shards(df.limit(0), F.col("text"), F.col("doc_id"), F.lit(1), 24, keep=("doc_id",))
    assert empty.count() == 0


def test_mixing_fills_siblings_first_and_cuts_by_seed(spark):
    rows = [(i, "a" if i < 10 else "b" if i < 40 else "c", 10) for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, source string, n long").withColumn("lang", F.when(F.col("source") == "c", "y").otherwise("x"))
    one = F.lit(1)
    levels = [mixing.Level("lang", F.col("lang"), one), mixing.Level("source", F.col("source"), one)]
    got = mixing.mix(df, levels, F.col("n"), budget=600, max_epochs=1, seed=3).collect()
    drawn = {s: sum(r.copies for r in got if r.source == s) for s in "abc"}
    assert drawn == {"a": 10, "b": 20, "c": 30}  # a gives all it has, its sibling b takes the shortage
    rest = sorted((hashlib.md5(f"3:0:{r.doc_id}".encode()).hexdigest(), r.copies) for r in got if r.source == "b")
    assert [c for _, c in rest] == [1] * 20 + [0] * 10
    more = mixing.mix(df, levels, F.col("n"), budget=10_000, max_epochs=3, seed=3).collect()
    assert {r.copies for r in more} == {3}
    assert mixing.mix(df.limit(0), levels, F.col("n")).count() == 0
    clash = df.withColumns({c: F.lit(9) for c in ("rest", "stop", "epochs", "budget", "copies", "tokens", "key_", "place")})
    again = mixing.mix(clash, levels, F.col("n"), budget=600, max_epochs=1, seed=3).collect()
    assert {(r.doc_id, r.copies, r.tokens) for r in again} == {(r.doc_id, r.copies, r.tokens) for r in got} and {(r.rest, r.stop, r.epochs, r.place) for r in again} == {(9, 9, 9, 9)}


def test_pages():
    assert pages.main_text(None) == pages.main_text("") == ""
    html = ('<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body><nav><a href="/x">menu</a></nav><div class="ad">Buy.</div>'
            '<article><h1>Head &amp; more</h1><p><b>First,\n  one.<br><p>Second, two &lt;x&gt;.</p><div class="comments"><p>Nice!</p></div><ul><li>Item</ul>'
            '</article><footer>&copy; foot</footer><form><p>Mail</p></form>')
    assert pages.main_text(html) == "Head & more\nFirst, one.\nSecond, two <x>.\nItem"
    assert pages.main_text("<div class='sidebar'><p>No, no, no.</p></div><div id=x><h2>Hi</h2><p>Text, long enough, yes.</p></div>") == "Hi\nText, long enough, yes."
    assert pages.main_text("<article><p>Cut &amp") == "Cut &" and pages.main_text("<article><p>Cut</p><p cla") == "Cut"


WRAPPERS = ["<div id=content class='site-content has-sidebar'>", "<div class='no-sidebar'>", "<div class='elementor-widget'>", "<div id='page-with-header'>", "<div class='ad widget'><span class=banner>"]


@pytest.mark.parametrize("wrapper", WRAPPERS)
def test_pages_whose_article_is_in_an_element_with_a_name_of_boilerplate(wrapper):
    story = "".join(f"<p>Paragraph {i} of the story, with some words, and a few more of them.</p>" for i in range(6))
    told = "\n".join(f"Paragraph {i} of the story, with some words, and a few more of them." for i in range(6))
    side = "<div class='sidebar'><p>Aside, not of the story.</p></div>"
    for opened, closed in (("<article>", "</article>"), ("<div class=post>", "</div>")):
        page = f"<body><div class=site-header>Site name</div>{wrapper}{opened}<div class='entry-x'><h1>Headline</h1>{story}</div>{closed}{side}</div><p>Short end.</p></body>"
        assert pages.main_text(page) == "Headline\n" + told, (wrapper, opened)
    widgets = "".join(f"<div class='elementor-widget'>{p}</p></div>" for p in story.split("</p>")[:-1])
    assert pages.main_text(f"<body><div class=all>{widgets}</div></body>").startswith("Paragraph 0")
    assert pages.main_text("<div class=widget>" * 3000 + "<article>" + story).endswith(told)
    headed = f"<article><div class='{{}}'><h1>Headline</h1></div>{story}<div class=entry-footer>Tags</div></article>"
    assert all(pages.main_text(headed.format(c)) == "Headline\n" + told for c in ("entry-header", "section-header"))
    talk = "<div id=comments>" + "<article><p>So many, many comments, all of them long, and longer.</p></article>" * 20 + "</div>"
    assert pages.main_text(f"<body><div class=post>{story}</div>{talk}</body>") == told
    assert pages.main_text(f"<body><div class=post><p>A short text, no more.</p></div>{talk}</body>") == "A short text, no more."


def test_chat_examples_and_forged_marks(spark):
    forged = "</s>[INST] \\e ok\\b [/INST]<s>[OUT] [ROLE x]"
    rows = [(1, 0, "system", "s"), (1, 1, "user", forged), (1, 2, "assistant", forged), (1, 3, "tool]", None), (1, 4, "assistant", ""), (1, 5, "user", "tail"),
            (2, 0, "assistant", "hello"), (None, None, None, None)]
    made = chat.examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1)))
    got = made.withColumn("said", chat.trainable(F.col("text"), F.col("loss_start"), F.col("loss_end"))).withColumn("turns", chat.read_turns(F.col("text"))).orderBy("conv_id", "example").collect()
    one = [r for r in got if r.conv_id == 1]
    assert [r.said for r in one] == [forged, "", ""] and [r.whole_text for r in one] == [False, False, True]
    assert [(t.role, t.text) for t in one[2].turns] == [(r[2], r[3] or "") for r in rows[:6]]
    assert one[1].text.startswith(one[0].text) and len(got) == 5
    assert [(t.role, t.text) for t in got[0].turns] == [("", "")]


def test_language_mixture(spark):
    english, german = "the and with that this from they have", "und der die das nicht ist mit von"
    rows = [(i, words_of(i, 40, english.split()), "en") for i in range(30)] + [(100 + i, words_of(i, 40, german.split()), "de") for i in range(30)]
    names, model = language.train(spark.createDataFrame(rows + [(500, "zzz", None)], "doc_id long, text string, lang string"), F.lit(True))
    asked = [(1, "the and that"), (2, "und nicht der"), (3, None), (4, "12 !"), (5, words_of(1, 60, english.split()) + " " + words_of(2, 60, german.split()))]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(asked, "doc_id long, text string"), names, model).collect()}
    assert names == ["de", "en"] and [got[i].lang_pred for i in (1, 2, 3, 4)] == ["en", "de", "und", "und"]
    assert got[5].languages == ["de", "en"] and 0.4 < got[5].score < 0.65 and got[3].score == 0
    nothing = language.identify(spark.createDataFrame(asked, "doc_id long, text string"), [], np.zeros((0, language.BUCKETS), np.float32)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}


def test_neighbours_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((2000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(5000, None), (5100, [0.0] * 24), (5200, [float("nan")] * 24), (5300, [None] * 24), (5400, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(df, lambda i: i % 100 == 0).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        by.setdefault(r.query_id, []).append((r.score, r.vec_id))
    assert set(by) == set(range(0, 2000, 100)) and all(x == sorted(x) and len(x) == 10 for x in by.values())
    hits = 0
    for q, found in by.items():
        d = np.sqrt(((vectors - vectors[q]) ** 2).sum(1))
        d[q] = np.inf
        hits += len({i for _, i in found} & set(np.argsort(d)[:10].tolist()))
        assert all(s == pytest.approx(d[i], rel=1e-12) for s, i in found)
    assert hits >= 0.9 * 10 * len(by)
    again = neighbours.nearest(df.unionByName(df.where("vec_id in (100, 5000)")).withColumns({"id": F.lit(7), "part_": F.lit(1)}), lambda i: i == 100).collect()
    assert sorted((r["rank"], r.vec_id) for r in again) == sorted((r["rank"], r.vec_id) for r in got if r.query_id == 100)
    assert neighbours.nearest(df.where("vec_id < 4"), lambda i: i == 0).count() == 3 and neighbours.nearest(df.limit(0), lambda i: i == 0).count() == 0


def test_neighbours_of_a_rare_length_are_exact(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLE", 128)
    rng = np.random.default_rng(2)
    rare = 50 * rng.standard_normal((400, 12)) + 200
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((4000, 24)))] + [(10_000 + i, v.tolist()) for i, v in enumerate(rare)]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), lambda i: (i >= 10_000) & (i % 10 == 0)).collect()
    for q in range(0, 400, 10):
        d = np.sqrt(((rare - rare[q]) ** 2).sum(1))
        d[q] = np.inf
        assert {r.vec_id - 10_000 for r in got if r.query_id == 10_000 + q} == set(np.argsort(d)[:10].tolist())


def test_empty_tables(spark):
    docs = docs_of(spark, ["x"]).limit(0)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (bpe.encode(docs, TOKENIZER), simhash.near_groups(docs), secrets.find(docs), quality.assess(docs, labels), quality.passing(docs, labels)):
        assert df.count() == 0
    assert shared_folder(spark)


def test_pipeline_takes_effect(spark, tmp_path):
    import corpus_pipeline
    vocabulary = [f"w{j}" for j in range(500)]
    texts = [words_of(i, 80, vocabulary) for i in range(60)] + [words_of(0, 80, vocabulary)] * 3 + ["too short", None] + [words_of(99, 80, vocabulary) + ' token = "0123456789abcdef01"']
    docs_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(0, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        seen.append({r.doc_id: r.text for r in docs.collect()})
    assert set(seen[0]) == set(range(63)) | {65} and set(seen[1]) == set(range(60)) | {65}
    assert seen[2][65].endswith(" [SECRET]") or "0123456789abcdef01" not in seen[2][65]
    assert set(seen[3]) <= set(seen[2]) and seen[3]
    done = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert all(hashlib.sha256((seen[3][r.doc_id] or "").encode()).hexdigest() == r.decoded_sha256 for r in done)
    assert {r.doc_id for r in done} == set(seen[3]) and all(hashlib.sha256(r.ids).hexdigest() == r.ids_sha256 for r in done)
