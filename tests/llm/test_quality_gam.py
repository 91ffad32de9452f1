from __future__ import annotations

import os

import numpy as np
import pytest

from tests.llm import brute, rows
from tillwise.llm import quality_gam
from tillwise.llm.quality_gam import classify, fit
from tillwise.llm.queries import op6_quality

SF = "/root/testdata/sf0.01"


def auc(score, y):
    order = np.argsort(np.argsort(score))
    return (order[y == 1].mean() - (y == 1).sum() / 2 + 0.5) / (y == 0).sum()


def test_lookup_tables_learn_sums_and_pairs():
    rng = np.random.default_rng(1)
    x = rng.random((6000, len(quality_gam.FEATURES)))
    odds = 3 * np.sin(6 * x[:, 0]) + 4 * ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.5)) - 2
    y = (rng.random(6000) < 1 / (1 + np.exp(-odds))).astype(float)
    model = fit(x[:4000], y[:4000])
    assert (1, 2) in model.pairs
    held = model.scores(x[4000:])
    assert auc(held, y[4000:]) > 0.85 and abs(held.mean() - y[4000:].mean()) < 0.03


def test_one_kind_of_label_or_none():
    x = np.random.default_rng(2).random((50, len(quality_gam.FEATURES)))
    assert fit(x, np.ones(50)).scores(x).min() > 0.9
    assert fit(x[:0], np.zeros(0)).scores(x) == pytest.approx(0.5)


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_held_out_accuracy(spark):
    scored = op6_quality(spark, SF).filter("held_out")
    both = scored.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    y = both["quality"].to_numpy()
    assert len(both) > 60
    assert auc(both["score"].to_numpy(), y) > 0.95
    assert (both["predicted"].to_numpy() == y).mean() > 0.93


def test_awkward_rows(spark):
    df = rows.frame(spark, rows.awkward())
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(50)] + [(1, 0, 0), (None, 1, 0), (2, None, 0)],
                                   "doc_id long, quality int, toxic int")
    got = classify(df, labels).collect()
    assert len(got) == df.count() and all(0 <= r.score <= 1 for r in got)
    again = {r.row.doc_id: r.score for r in classify(df.select("doc_id", "text"), labels).collect()}
    assert all(again[r.row.doc_id] == r.score for r in got if r.row.doc_id != 9)
    assert classify(df.limit(0), labels).collect() == []
    assert {r.score for r in classify(df, labels.limit(0)).collect()} == {0.5}


def test_features_and_scores_against_plain_version(spark):
    data = rows.awkward()
    data += [(300, "x|y| |z !? 12 (a) [b] {c} \"q\" `r` aa aa AA ~^ ünï 日本 \n\n x|y|\n", "en", "s", 1, "", 0, "")]
    data += [(301, "w" * 21 + " " + "w" * 20 + " " + "é" * 11, "en", "s", 1, "", 0, ""), (302, "a b c d e f g h " * 4, "en", "s", 1, "", 0, "")]
    vectors = quality_gam.featured(rows.frame(spark, data)).collect()
    assert len(vectors) == len(data)
    for r in vectors:
        want = brute.quality_features(r.row.text)
        assert dict(zip(quality_gam.FEATURES, r.x)) == pytest.approx(want, abs=1e-12), r.row.text
    rng = np.random.default_rng(5)
    x = np.array([r.x for r in vectors])
    model = fit(np.repeat(x, 20, axis=0), rng.integers(0, 2, 20 * len(x)).astype(float), rounds=6)
    assert model.pairs
    df = quality_gam.featured(rows.frame(spark, data))
    for r in quality_gam.score_vectors(df, model).collect():
        assert r.score == pytest.approx(brute.additive_score(model, r.x), abs=1e-12)
