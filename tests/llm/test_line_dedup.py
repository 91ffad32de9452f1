from __future__ import annotations

from collections import Counter

import pytest

from tests.llm import brute, rows
from tillwise.llm.line_dedup import dedup_lines, dropped_bitmaps


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("min_docs", [1, 10])
def test_against_brute_force(spark, keep, min_docs):
    data = rows.awkward()
    expected = brute.line_dedup(rows.dicts(data), min_docs, keep)
    got = dedup_lines(rows.frame(spark, data), min_docs, keep).collect()
    assert len(got) == len(data)
    if keep == "first":  # two texts under one id tie by a hash, so only ids of their own compare
        shared = {i for i, n in Counter(i for i, _ in expected).items() if n > 1}
        got = [r for r in got if r.row.doc_id not in shared]
    for r in got:
        want = expected[r.row.doc_id, r.row.text or ""]
        if keep == "first" and min_docs == 1:
            assert r.n_lines == want[0]
        else:
            assert (r.n_lines, r.n_dropped, r.kept_text) == want


def test_first_occurrence_stays_once(spark):
    data = [(i, "same\nown %d\nsame" % i, "en", "s", 1, "", 0, "") for i in range(12)]
    got = {r.row.doc_id: r.kept_text for r in dedup_lines(rows.frame(spark, data), 2, "first").collect()}
    assert got[0] == "same\nown 0" and all(got[i] == f"own {i}" for i in range(1, 12))


def test_input_columns_survive(spark):
    df = rows.frame(spark, rows.awkward())
    out = dedup_lines(df)
    assert out.select("row.*").schema == df.schema
    assert Counter(out.select("row.*").collect()) == Counter(df.collect())


def test_bitmaps_are_sparse(spark):
    text = "\n".join(["x%d" % i for i in range(1000)] + ["last"])
    data = [(i, text.replace("x", f"{i}x"), "en", "s", 1, "", 0, "") for i in range(10)]
    for r in dropped_bitmaps(rows.frame(spark, data), 10, "none").collect():
        assert [(w.word, w.bits) for w in r.words] == [(15, 1 << 40)]


def test_empty(spark):
    assert dedup_lines(rows.frame(spark, [])).collect() == []
