from __future__ import annotations

import random
from collections import Counter

import pytest

from tests.llm import brute, rows
from tillwise.llm import mixing
from tillwise.llm.mixing import allocate, mixed


@pytest.mark.parametrize("budget, epochs", [(None, 3), (500, 2), (100_000, 2), (0, 1)])
def test_against_brute_force(spark, budget, epochs):
    data = rows.awkward(150)
    got = allocate(rows.frame(spark, data), epochs, "s", budget=budget).collect()
    want = brute.mixing_copies(rows.dicts(data), mixing.DOMAINS, mixing.WEIGHTS, epochs, "s", budget)
    assert Counter((r.doc_id, r.source, r.copies) for r in got) == Counter(
        (d[0], d[3] or "", c) for d, c in zip(data, want, strict=True)
    )


def test_shortage_goes_to_siblings_first(spark):
    data = []
    for source, n in [("a", 10), ("b", 100), ("c", 100)]:  # a and b are siblings
        lang = "x" if source in "ab" else "y"
        data += [(len(data) + i, "w " * 10, lang, source, 1, "", 0, "") for i in range(n)]
    got = allocate(rows.frame(spark, data), 1, "s", budget=1000, weights={}, domains={}).collect()
    target = {r.source: r.target for r in got}
    assert target == {"a": 100, "b": 400, "c": 500}
    got = allocate(rows.frame(spark, data), 1, "s", budget=1800, weights={}, domains={}).collect()
    assert {r.source: r.target for r in got} == {"a": 100, "b": 800, "c": 900}


def test_mixed_rows(spark):
    data = rows.awkward(80)
    df = rows.frame(spark, data)
    copies = brute.mixing_copies(rows.dicts(data), mixing.DOMAINS, mixing.WEIGHTS, 3, mixing.SEED)
    want = Counter()
    for d, c in zip(data, copies, strict=True):
        want[d] += c
    out = mixed(df)
    assert out.schema == df.schema
    assert Counter(tuple(r) for r in out.collect()) == +want


def test_many_leaves(spark):
    rng = random.Random(2)
    data = [(i, "w " * rng.randint(0, 50), f"l{i % 7}", f"s{rng.randrange(40)}", 1, "", 0, "") for i in range(600)]
    got = allocate(rows.frame(spark, data), 2, "q", budget=9000, weights={"other/l1": 9, "other/l2": 0}).collect()
    want = brute.mixing_copies(
        rows.dicts(data), mixing.DOMAINS, {"other/l1": 9, "other/l2": 0}, 2, "q", 9000
    )
    assert Counter((r.doc_id, r.copies) for r in got) == Counter((d[0], c) for d, c in zip(data, want))


@pytest.mark.parametrize("digits", [3, 1])
def test_edge_is_cut_again(spark, monkeypatch, digits):
    """Ranges are cut until few places are left; equal rows, also under no id, are one place."""
    monkeypatch.setattr(mixing, "EDGE_ROWS", 2)
    monkeypatch.setattr(mixing, "_DIGITS", digits)
    rng = random.Random(7)
    data = [(i, "w " * rng.randint(0, 9), "l", "s", 1, "", 0, "") for i in range(800)]
    data += [(5, "a b c", "l", "s", 1, "", 0, "")] * 30 + [(None, "d e", "l", "t", 1, "", 0, "")] * 30
    data += [(i, "w w", "l", "t", 1, "", 0, "") for i in range(100)]
    got = allocate(rows.frame(spark, data), 2, "q", budget=3000).collect()
    want = brute.mixing_copies(rows.dicts(data), mixing.DOMAINS, mixing.WEIGHTS, 2, "q", 3000)
    assert Counter((r.doc_id, r.n_tokens, r.copies) for r in got) == Counter(
        (d[0], len(d[1].split()), c) for d, c in zip(data, want, strict=True)
    )


def test_empty(spark):
    assert allocate(rows.frame(spark, [])).collect() == [] and mixed(rows.frame(spark, [])).collect() == []
