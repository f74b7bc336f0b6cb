"""Registered queries against their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from prosestat.plans.oracles import ORACLES
from prosestat.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"

# One query per operator family; tools/check_oracles.py runs all of them.
CHECKED = ("wordfreq_by_doc", "top20_corpus", "top20_by_doc", "body_edge_cases", "sentiment_by_doc_large_lexicon",
           "syntactic_by_source", "readability", "path_book_ids", "facts_from_lines", "direct_records",
           "drop_reasons", "cohort_deltas", "written_metadata_lines", "written_volumes_by_line", "record_payloads",
           "partial_records", "partial_summary", "written_corpus_run", "records_by_line", "written_metrics")


def rows(table):
    names = sorted(table.column_names)
    return sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES) <= set(queries()) and set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", CHECKED)
def test_against_sql(spark, con, name):
    assert rows(queries()[name](spark, SF).toArrow()) == rows(con.sql(oracle_sql()[name]).to_arrow_table())


def test_entry(spark, con):
    assert entry(spark).count() == 200


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark, con):
    features = plan(queries()["readability"](spark, SF))
    assert "Exchange" not in features
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in features
    assert "WindowGroupLimit" in plan(queries()["top20_by_source"](spark, SF))
    assert "BroadcastHashJoin" in plan(queries()["sentiment_by_doc"](spark, SF))
    assert "TakeOrderedAndProject" in plan(queries()["top20_corpus"](spark, SF))
    for name in ("direct_records", "cohort_summary", "normalized_records", "polarity_gap", "listing_totals"):
        text = plan(queries()[name](spark, SF))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
