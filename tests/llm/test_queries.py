"""The registered queries without SQL, on the smallest tables, against plain versions or what their results promise."""

import hashlib
import re
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from prosestat.llm import pages, secrets
from prosestat.llm.queries import QUERIES, TOKENIZER

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs():
    return {r["doc_id"]: r for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()}


def rows_of(spark, name):
    return QUERIES[name](spark, SF).collect()


def test_op1_bpe(spark, docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(TOKENIZER)
    library.no_truncation()
    library.no_padding()
    got = rows_of(spark, "op1_bpe")
    assert len(got) == len(docs)
    for r in got:
        ids = library.encode(docs[r.doc_id]["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_op3_sharding(spark, docs):
    got = rows_of(spark, "op3_sharding")
    size = {i: len((d["text"] or "").encode()) + 8 for i, d in docs.items()}
    assert {r.doc_id: (r.size, r.text_crc32) for r in got} == {i: (size[i], zlib.crc32((d["text"] or "").encode()) if d["text"] is not None else None) for i, d in docs.items()}
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    sums = [0] * 24
    for s in range(24):
        own = sorted(r.slot for r in got if r.shard == s)
        assert own == list(range(len(own)))
        sums[s] = sum(r.size for r in got if r.shard == s)
    assert max(sums) - min(sums) <= 2 * max(size.values())


def plain_base(text):
    """Base secrets by a reading of the contract, kind by kind."""
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", low) if m.end(2) - m.start(2) >= 12]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if m.end() - m.start() >= 16]
    return sorted(out)


def test_op5_secrets(spark, docs):
    names = ("assign", "access", "hex")
    got = {r.doc_id: r for r in rows_of(spark, "op5_secrets")}
    assert set(got) == set(docs)
    for i, d in docs.items():
        base = plain_base(d["text"] or "")
        r = got[i]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == n for _, k, _ in base) for n in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(f"{names[k]}:{s}:{e}" for s, k, e in base).encode()).hexdigest()
        assert r.spans == ",".join(f"{k}:{s}:{e}" for s, e, k in secrets.spans(d["text"] or ""))
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got.values()) > 0


def test_op6_html(spark):
    table = {r["page_id"]: r for r in pq.read_table(f"{SF}/pages.parquet").to_pylist()}
    got = rows_of(spark, "op6_html")
    assert {r.page_id: (r.url, r.text, r.n_chars) for r in got} == {
        i: (p["url"], (t := pages.main_text(p["html"])), len(t)) for i, p in table.items()}
    for r in got:
        assert not re.search(r"[^\S\n ]|  |^ | $|\n\n", r.text) and sum(map(len, r.text.split("\n"))) > 0


def test_op6_extract_of_odd_tables(spark):
    html = "<article><p>One, two.</p></article>"
    rows = [(1, "u", html, 5), (1, "u", html, 6), (2, None, None, 7), (None, "v", "", 8)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text long")
    got = sorted(map(tuple, pages.extract(df).collect()), key=str)
    assert got == sorted([(1, "u", "One, two.", 9)] * 2 + [(2, None, "", 0), (None, "v", "", 0)], key=str)
    assert pages.extract(df.limit(0)).collect() == []


def test_op8_language(spark, docs):
    got = rows_of(spark, "op8_language")
    assert {r.doc_id: r.held_out for r in got} == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in docs}
    known = {d["lang"] for d in docs.values() if d["lang"]}
    assert all(0 <= r.score <= 1 and r.lang_pred in known | {"und"} for r in got)
    held = [r.lang_pred == docs[r.doc_id]["lang"] for r in got if r.held_out and docs[r.doc_id]["lang"]]
    assert sum(held) >= 0.95 * len(held)


def test_op9_neighbours(spark):
    table = pq.read_table(f"{SF}/embeddings.parquet")
    ids, vectors = table["vec_id"].to_numpy(), np.array(table["embedding"].to_pylist(), float)
    got, hits, wanted = rows_of(spark, "op9_neighbours"), 0, 0
    for q in ids[ids % 100 == 0]:
        d = np.sqrt(((vectors - vectors[ids == q][0]) ** 2).sum(1))
        order = [i for i in np.lexsort((ids, d)) if ids[i] != q][:10]
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == q)
        assert [r[0] for r in own] == list(range(1, 11)) and all(s == pytest.approx(d[ids == v][0], rel=1e-12) for _, v, s in own)
        hits += len({v for _, v, _ in own} & {ids[i] for i in order})
        wanted += 10
    assert hits >= 0.9 * wanted


def test_op10_simhash(spark, docs):
    from test_operators import plain_groups, plain_print
    got = rows_of(spark, "op10_simhash")
    prints = {i: plain_print(d["text"]) for i, d in docs.items()}
    assert {r.doc_id: r.fingerprint for r in got} == {i: f"{p:016x}" for i, p in prints.items()}
    assert {r.doc_id: r.component_id for r in got} == plain_groups(prints)


STORY = "".join(f"<p>Paragraph {i} of the story, with some words, and a few more of them.</p>" for i in range(6))
TOLD = "\n".join(f"Paragraph {i} of the story, with some words, and a few more of them." for i in range(6))
MENU = "<ul>" + "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(9)) + "</ul>"
TEASER = "<div class=card><h3><a href=/a>Another story here</a></h3><p><a href=/a>Read on about it</a></p></div>"


@pytest.mark.parametrize("page,want", [
    (f"<main>{MENU}<div>{STORY}</div></main>", TOLD),
    (f"<main>{MENU}{STORY}</main>", TOLD),
    (f"<main><article>{STORY}</article>{TEASER * 3}</main>", TOLD),
    (f"<article>{STORY}<ul><li><a href=/s>Source one</a><li><a href=/t>Source two</a></ul></article>", TOLD + "\nSource one\nSource two"),
    (f"<div><div><p>A short introduction.</p></div><div>{STORY}</div></div>", "A short introduction.\n" + TOLD),
    (f"<div class=hero><h1>Headline</h1></div><div class=body><div>{STORY}</div></div>", "Headline\n" + TOLD),
    (f"<div><div>{STORY}</div><ul><li>First thing</li><li>Second thing</li></ul></div>", TOLD + "\nFirst thing\nSecond thing"),
    (f"<main><div>{STORY}</div><section><h2>Sources</h2><p>Notes of the time</p></section></main>", TOLD + "\nSources\nNotes of the time"),
])
def test_op6_what_stands_beside_the_story(page, want):
    assert pages.main_text(f"<body>{page}<div class=x><p><a href=/z>More of this site</a></p></div></body>") == want
