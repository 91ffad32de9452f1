from __future__ import annotations

import random
import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from tests.llm import rows
from tillwise.llm import filter_audit


def failing(docs):
    firsts = defaultdict(list)
    for d in docs:
        if d[0] is not None:
            firsts[d[1] or ""].append(d[0])
    out = []
    for d in docs:
        t = d[1] or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = set()
        if len(w) < 200:
            fails.add("A")
        if 100 * len(set(w)) < 50 * len(w):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", t)) > 2 * len(t):
            fails.add("C")
        if re.search(r"[#$%&*|]", t):
            fails.add("D")
        if d[0] is not None and d[0] > min(firsts[t]):
            fails.add("E")
        out.append(fails)
    return out


def plain(docs, good, toxic):
    """Every order applied step by step, document by document."""
    fails = failing(docs)
    parts = {d[3] or "" for d in docs}
    out, shapley = {}, defaultdict(int)
    for part in parts:
        mine = [(d, f) for d, f in zip(docs, fails) if (d[3] or "") == part]
        for order in map("".join, permutations("ABCDE")):
            alive = list(range(len(mine)))
            for step, x in enumerate(order, 1):
                gone = [i for i in alive if x in mine[i][1]]
                alive = [i for i in alive if x not in mine[i][1]]
                every = sum(x in f for _, f in mine)
                out[part, order, step] = [
                    len(alive), len(gone), every - len(gone), sum(f == {x} for _, f in mine),
                    sum(mine[i][0][0] in good for i in gone), sum(mine[i][0][0] in toxic for i in gone),
                ]
                shapley[part, x] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 17, 1000, 4096])
def test_carry_save_counts(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, dtype=np.uint32)
    want = [int(((words >> b) & 1).sum()) for b in range(32)]
    assert filter_audit.positional_counts(words).tolist() == want


def test_survival_words():
    for mask, word in enumerate(filter_audit.survival_words(5)):
        assert [int(word) >> s & 1 for s in range(32)] == [int(not mask & s) for s in range(32)]


def test_against_plain_version(spark, partitions):
    partitions(5)
    rng = random.Random(2)
    data = rows.awkward(150)
    for i, row in enumerate(data):
        if row[1] is not None and i % 3 == 0:
            long = " ".join(rng.choices(["Big", "wörd", "a", "b#", "c", *map(str, range(300))], k=rng.choice([150, 250, 400])))
            data[i] = (*row[:1], long, *row[2:])
    data += [(1000 + i, data[i][1], *data[i][2:]) for i in range(0, 60, 4)]
    data += [(None, data[0][1], *data[0][2:]), (data[0][0], data[0][1], *data[0][2:])]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 1020, 2)]
    labels += [(0, 1, 0), (0, 0, 1), (None, 1, 1)]
    frame = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    got = filter_audit.audit(rows.frame(spark, data), frame).collect()
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == plain(data, good, toxic)
    assert len(got) == 600 * len({d[3] or "" for d in data})


def test_many_parts_are_handed_on(spark):
    data = [(i, f"text {i % 40}", "en", f"s{i % 90}", 1, "", 0, "") for i in range(400)]
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    failed = filter_audit.failures(rows.frame(spark, data), labels)
    few = filter_audit.survivors(failed, most_parts=1).collect()
    many = filter_audit.survivors(failed).collect()
    assert sorted(map(str, few)) == sorted(map(str, many)) and len(many) == 90
    assert sum(r.kept[0] for r in many) == 400 and sum(r.kept[16] for r in many) == 40


def test_empty(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(rows.frame(spark, []), labels).collect() == []
