"""The pipeline's rows against a plain version of its five stages, with cutoffs in force."""

import hashlib
import random

import numpy as np


from prosestat.llm import secrets
from prosestat.llm.oracles import MIXING, QUALITY
from prosestat.llm.queries import MIX_PERCENT, TOKENIZER

from test_operators import labelled, plain_groups, plain_print


def table(seed):
    """Documents of two languages with faults, copies and secrets, and their labels."""
    rng = random.Random(seed)
    rows, labels = labelled(seed, n=1100)
    rows = [(i, t, lang, f"s{i % 5}") for i, t, lang in rows]
    texts = [t for _, t, _, _ in rows]
    for i in range(40):
        at = rng.randrange(len(texts))
        rows.append((len(rows), texts[at], "en", "copied"))
    rows += [(len(rows) + i, f'{texts[5 * i + 300]} token = "{hashlib.md5(str(i).encode()).hexdigest()}" end', "de", "s1") for i in range(30)]
    rows += [(90_000, None, "en", None), (90_001, "", None, "s1"), (90_002, "too short", "en", "s2")]
    return [(i, t, lang, s, len(t or "")) for i, t, lang, s in rows], labels


def test_run_equals_the_plain_stages(spark, tmp_path):
    import duckdb
    from tokenizers import Tokenizer
    import corpus_pipeline

    rows, labels = table(6)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    with duckdb.connect() as db:
        for t in ("documents", "labels"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
        judged = {r[0]: (r[-2], r[-1]) for r in db.execute(QUALITY).fetchall()}
        assert sum(not kept and not failed for failed, kept in judged.values()) > 100  # cutoffs are in force
        docs = {i: [t, lang, source, n] for i, t, lang, source, n in rows if judged[i][1]}
        groups = plain_groups({i: plain_print(d[0]) for i, d in docs.items()})
        assert sum(i != g for i, g in groups.items()) > 20
        docs = {i: d for i, d in docs.items() if groups[i] == i}
        for d in docs.values():
            d[0] = secrets.mask(d[0], secrets.spans(d[0]), "[SECRET]")
        assert sum("[SECRET]" in d[0] for d in docs.values()) >= 20
        db.execute("DROP VIEW documents")
        db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
        db.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", [(i, *d[:3]) for i, d in docs.items()])
        percent = f"* {MIX_PERCENT} // 100"
        assert percent in MIXING
        drawn = {r[0]: r[-1] for r in db.execute(MIXING.replace(percent, f"* {corpus_pipeline.PERCENT} // 100")).fetchall()}
    library, want = Tokenizer.from_file(TOKENIZER), []
    for i, times in drawn.items():
        ids = library.encode(docs[i][0], add_special_tokens=False).ids
        want += [(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(docs[i][0].encode()).hexdigest())] * times
    got = corpus_pipeline.run(spark, str(tmp_path)).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 500


def test_run_over_empty_tables(spark, tmp_path):
    import corpus_pipeline
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
