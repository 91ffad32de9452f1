from __future__ import annotations

import os
import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import brute, rows
from tillwise.llm import near_dup
from tillwise.llm.blocks import blocks
from tillwise.llm.components import connected
from tillwise.llm.near_dup import keep_one, near_classes, prob_minhash, probability_jaccard, shingles

SF = "/root/testdata/sf0.001"


def partition(keys, classes):
    groups = defaultdict(list)
    for key, c in zip(keys, classes, strict=True):
        groups[c].append(key)
    return sorted(sorted(g, key=str) for g in groups.values())


def test_exact_similarity():
    rng = random.Random(4)
    for _ in range(200):
        a = {rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(1, 10))}
        b = {rng.randrange(12): rng.randint(1, 4) for _ in range(rng.randint(1, 10))}
        arrays = [np.array(x) for x in (list(a), list(map(float, a.values())), list(b), list(map(float, b.values())))]
        assert probability_jaccard(*arrays) == pytest.approx(brute.probability_jaccard(a, b))


def test_signatures_estimate_the_similarity():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [" ".join(base), " ".join(base[:100] + rng.choices(words, k=20)), "one two", "one two", "one two three", ""]
    texts += [" ".join(["a"] * 50), " ".join(["a"] * 40 + ["b"])]
    _, block = next(blocks(pa.array(texts)))
    signature = prob_minhash(*shingles(block), block.n, 1024)
    for i, j in [(0, 1), (2, 3), (2, 4), (6, 7)]:
        exact = brute.probability_jaccard(brute.shingle_weights(texts[i]), brute.shingle_weights(texts[j]))
        assert abs((signature[i] == signature[j]).mean() - exact) < 0.06


def test_shingle_weights():
    texts = ["a b c d e a b c d e", "a b", "", " \n", "x " * 9, "a b c d", "a b c d e"]
    _, block = next(blocks(pa.array(texts)))
    doc, element, weight = shingles(block)
    for i, text in enumerate(texts):
        assert sorted(weight[doc == i]) == sorted(brute.shingle_weights(text).values())
        assert len(set(element[doc == i])) == (doc == i).sum()


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10**6)}"
    return out


def test_classes_against_brute_force(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" for i in range(500)]
    passage = rng.choices(vocabulary, k=60)
    data = rows.awkward(40)[:-1]  # without the id that two texts share
    for group in range(12):
        base = rng.choices(vocabulary, k=rng.choice([30, 80, 200]))
        for i in range(8):
            text = " ".join(edited(rng, base, rng.choice([0, 1, 1, 2, 3, 5])))
            data.append((1000 + 100 * group + i, text, "en", "src0", 1, "", 0, ""))
    for i in range(40):  # one passage in many texts of their own
        text = " ".join(passage + rng.choices(vocabulary, k=25))
        data.append((5000 + i, text, "en", "src0", 1, "", 0, ""))
    for i in range(60):  # a large group of near copies
        data.append((6000 + i, " ".join(edited(rng, passage * 3, 1)), "en", "src0", 1, "", 0, ""))
    got = near_classes(rows.frame(spark, data)).collect()
    docs = rows.dicts(data)
    keys = [f"{d['doc_id']}" for d in docs]
    assert partition([f"{r.doc_id}" for r in got], [(r.class_id, r.class_size) for r in got]) == partition(
        keys, brute.near_classes(docs)
    )


def test_mixed_buckets_find_links_hubs_miss(spark, monkeypatch):
    """With one wide band every text meets, and only the rare-shingle pass can part them."""
    monkeypatch.setattr(near_dup, "ROWS", 1)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    common = rng.choices(vocabulary, k=100)
    data = []
    for group in range(10):
        own = rng.choices(vocabulary, k=40)
        data += [(group * 10 + i, " ".join(common + edited(rng, own, 2)), "en", "s", 1, "", 0, "") for i in range(4)]
    got = near_classes(rows.frame(spark, data)).collect()
    assert partition([r.doc_id for r in got], [r.class_id for r in got]) == partition(
        [d[0] for d in data], brute.near_classes(rows.dicts(data))
    )


@pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")
def test_benchmark_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    local = [r.asDict() for r in docs.collect()]
    got = near_classes(docs).collect()
    assert partition([r.doc_id for r in got], [r.class_id for r in got]) == partition(
        [d["doc_id"] for d in local], brute.near_classes(local)
    )
    assert sorted(r.doc_id for r in keep_one(docs).collect()) == sorted({r.class_id for r in got})


def test_hub_texts_travel_once_a_run(spark, monkeypatch):
    """Pairs of hubs in several runs, pairs of members and an empty set of pairs, against the plain similarity."""
    monkeypatch.setattr(near_dup, "HUB_PAIRS", 16)
    rng = random.Random(10)
    base = [f"w{rng.randrange(90)}" for _ in range(80)]
    texts = {i: " ".join(edited(rng, base, i % 4)) for i in range(120)}
    pairs = [(i, 7) if i % 3 else (7, i) for i in range(120) if i != 7] + [(i, i + 1) for i in range(20, 60)]
    nodes = spark.createDataFrame(list(texts.items()), "node long, text string")
    got = near_dup.verified(spark.createDataFrame(pairs, "x long, y long"), nodes)
    weights = {i: brute.shingle_weights(t) for i, t in texts.items()}
    near = {frozenset(p) for p in pairs if brute.probability_jaccard(weights[p[0]], weights[p[1]]) >= 0.8}
    rows_ = [frozenset(r) for r in got.collect()]
    assert set(rows_) == near and 0 < len(rows_) == len(near) < len(pairs)
    assert near_dup.verified(spark.createDataFrame([], "x long, y long"), nodes).collect() == []


def test_keep_one_of_equal_rows(spark):
    data = rows.awkward()
    df = rows.frame(spark, data)
    kept = keep_one(df)
    assert kept.schema == df.schema
    assert kept.count() == len(set(brute.near_classes(rows.dicts(data))))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7), (200, 150)]
    got = {(r.a, r.b) for r in connected(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(101, 100), (200, 150)}


def test_empty(spark):
    assert near_classes(rows.frame(spark, [])).collect() == []
    assert keep_one(rows.frame(spark, [])).collect() == []


def test_pairs_inside_a_component_are_not_compared(spark, monkeypatch):
    """Two dense groups whose members are candidates of each other: only pairs across them are all compared."""
    pairs = [(x, y, 5 if (x + y) % 2 == 0 else 1) for y in range(40) for x in range(y)]
    compared = []

    def by_parity(some, texts, threshold):
        compared.append(some.count())
        return some.filter("(x + y) % 2 = 0")

    monkeypatch.setattr(near_dup, "verified", by_parity)
    none = spark.createDataFrame([], "a long, b long")
    got = near_dup._linked(spark.createDataFrame(pairs, "x long, y long, met long"), none, None, 0.8)
    assert {(r.a, r.b) for r in got.collect()} == {(i, i % 2) for i in range(2, 40)}
    across = sum((x + y) % 2 for x, y, _ in pairs)
    assert across <= sum(compared) < across + 2 * 40 * near_dup.PAIR_TURNS < len(pairs)
