from __future__ import annotations

import math
import random
from collections import Counter

import pytest

from tests.llm import brute, rows
from tillwise.llm.quality_rules import (
    N_CUTOFFS, RULES, apply_rules, certified_cutoffs, judge, learn, learn_cutoffs, least_clean, measured, pooled_cutoffs,
    rejection_bound,
)

LABELS = "doc_id long, quality int, toxic int"


def share(rule, m):
    top, bottom = RULES[rule].split(" / ")
    return m[top] / max(m[bottom.split("(")[1].split(",")[0]], 1)


def test_measures_and_base(spark):
    data = rows.awkward()
    data += [(200, "a b c d e f g h " * 6, "en", "s", 1, "", 0, ""), (201, "#a *b $%& | <x>\nx\nx\n\n\n y\n y", "en", "s", 1, "", 0, "")]
    got = apply_rules(rows.frame(spark, data), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == len(data)
    for r in got:
        want = brute.measures(r.row.text)
        assert r.m.asDict() == want
        assert r.base_failed == brute.base_failed(want) and r.kept == (not r.base_failed)


def test_bound_is_exact():
    for k, n, alpha in [(0, 50, 0.05), (3, 100, 0.01), (40, 1000, 1e-3)]:
        p = rejection_bound(k, n, alpha)
        tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert tail == pytest.approx(alpha, rel=1e-6)
    assert rejection_bound(5, 5, 0.05) == 1.0 and rejection_bound(0, 0, 0.05) == 1.0


def test_cutoffs_stop_at_the_first_failure():
    rule = "upper_share"
    histogram = {("en", rule): Counter({0: 5000, 10: 3, 50: 2}), ("fr", rule): Counter({0: 20})}
    cut = certified_cutoffs(histogram, 0.02, 0.05, 2)
    assert cut["en", rule] == 0.0 and ("fr", rule) not in cut
    histogram["en", rule][30] = 200
    assert certified_cutoffs(histogram, 0.02, 0.05, 2)["en", rule] == pytest.approx(0.15)


def test_small_strata_are_pooled():
    assert least_clean(0.02, 0.05, 4) == 1495 and least_clean(0.02, 0.05, 100) == 2298
    rule = "upper_share"
    histogram = {("en", rule): {0: 5000, 40: 3}, ("fr", rule): {0: 1000, 10: 2}, ("de", rule): {0: 900}}
    assert {s for s, _ in certified_cutoffs(histogram, 0.02, 0.05, 3)} == {"en"}
    cut = pooled_cutoffs(histogram, 0.02, 0.05)
    assert cut["fr", rule] == cut["de", rule]
    # the pool is one stratum more: its bound holds at a fourth of the confidence
    own = certified_cutoffs({("pool", rule): {0: 1900, 10: 2}, ("en", rule): histogram["en", rule]}, 0.02, 0.05, 4)
    assert cut["fr", rule] == own["pool", rule] and cut["en", rule] == own["en", rule]
    assert not {s for s, _ in pooled_cutoffs({("fr", rule): {0: 20}, ("de", rule): {0: 20}}, 0.02, 0.05)}
    enough = {("en", rule): {0: 5000}, ("fr", rule): {0: 4000, 9: 1}}
    assert pooled_cutoffs(enough, 0.02, 0.05) == certified_cutoffs(enough, 0.02, 0.05, 2)


def test_junk_of_small_languages_is_caught(spark):
    plain = "some plain words of a text that is long enough to pass number {} and then goes on a bit more here"
    langs = ("aa", "bb", "cc")
    data = [(i, plain.format(i), langs[i % 3], "s", 1, "", 0, "") for i in range(2700)]
    data += [(5000 + i, plain.format(i).replace(" ", "## "), langs[i % 3], "s", 1, "", 0, "") for i in range(30)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2700)], LABELS)
    got = {r.row.doc_id: r.kept for r in apply_rules(rows.frame(spark, data), labels).collect()}
    assert sum(got[i] for i in range(2700)) >= 2646
    assert not any(got[5000 + i] for i in range(30))


def test_few_clean_rejected_and_junk_caught(spark):
    plain = "some plain words of a text that is long enough to pass number {} and then goes on a bit more here"
    data = [(i, plain.format(i), "en", "s", 1, "", 0, "") for i in range(2500)]
    data += [(5000 + i, plain.format(i).replace(" ", "## "), "en", "s", 1, "", 0, "") for i in range(20)]
    data += [(6000 + i, plain.format(i).replace(" ", "## "), "xx", "s", 1, "", 0, "") for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(2500)], LABELS)
    got = {r.row.doc_id: r.kept for r in apply_rules(rows.frame(spark, data), labels).collect()}
    assert sum(got[i] for i in range(2500)) >= 2450
    assert not any(got[5000 + i] for i in range(20))
    assert all(got[6000 + i] for i in range(20))  # no clean document of that stratum proves a cutoff


def shares(m):
    return {rule: share(rule, m) for rule in RULES}


@pytest.mark.parametrize("sizes", [{"en": 2000, "fr": 1800}, {"en": 2200, "fr": 900, "de": 900, None: 30}, {"en": 40, "xx": 0}])
def test_learnt_cutoffs_against_plain_version(spark, sizes):
    """From rows and labels to cutoffs, verdicts and the bound that each row is told."""
    rng = random.Random(len(sizes))
    plain = "some plain words of a text that is long enough to pass number {} and then goes on a bit more here"
    data, labels = [], []
    for lang, n in sizes.items():
        for _ in range(n + 20):
            i = len(data)
            text = plain.format(i) + " #" * rng.choice([0] * 300 + [1, 3, 9]) + " LOUD" * rng.choice([0] * 200 + [1, 6])
            data.append((i, text, lang, "s", 1, "", 0, ""))
            labels.append((i, int(len(labels) % (n + 20) < n), 0))
    labels += [(0, 0, 0), (None, 1, 0), (10**6, 1, 0)]
    cutoffs, held = brute.learnt_cutoffs(rows.dicts(data), labels, shares, 0.02, 0.05, N_CUTOFFS)
    frame, marked = rows.frame(spark, data), spark.createDataFrame(labels, LABELS)
    got, bound = learn(measured(frame), marked)
    assert got == pytest.approx(cutoffs) and bound == held
    assert learn_cutoffs(measured(frame), marked) == got
    for judged in (apply_rules(frame, marked), judge(frame, marked)):
        for r in judged.collect():
            d = data[r.row.doc_id]
            m, lang = brute.measures(d[1]), d[2] or ""
            above = [
                (lang, rule) in cutoffs and math.ceil(s * N_CUTOFFS - 1e-12) > round(cutoffs[lang, rule] * N_CUTOFFS)
                for rule, s in shares(m).items()
            ]
            assert r.kept == (not brute.base_failed(m) and not any(above))
            assert r.bound == held.get(lang, "none")


def test_empty(spark):
    assert apply_rules(rows.frame(spark, []), spark.createDataFrame([], LABELS)).collect() == []
