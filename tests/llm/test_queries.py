"""The registered queries: against SQL where it can say them, and as a whole."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.llm import brute
from tillcheck.compare import compare, connect
from tillwise.llm import queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


@pytest.mark.parametrize("name", queries.SQL)
def test_against_sql(spark, name):
    ok, note = compare(queries.QUERIES[name](spark, SF), connect(SF), queries.SQL[name])
    assert ok, note


def test_all_are_registered():
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def test_rules_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op9_quality_rules(spark, SF).collect():
        want = brute.measures(texts[r.doc_id])
        assert all(r[c] == want[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert r.base_failed == brute.base_failed(want) and not (r.base_failed and r.kept)


@pytest.mark.parametrize("name, key", [("op2_sharding", "doc_id"), ("op5_secrets", "doc_id"), ("op10_sentencepiece", "doc_id"), ("op11_licenses", "doc_id"), ("op12_resampling", "doc_id")])
def test_one_row_per_document(spark, name, key):
    got = [r[key] for r in queries.QUERIES[name](spark, SF).select(key).collect()]
    assert sorted(got) == sorted(r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
