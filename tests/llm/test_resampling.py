from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tests.llm import rows
from tillwise.llm import resampling


def words(text):
    lowered = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def runs(text, max_n):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]


def plain(docs, target, buckets, max_n, seed, percent, least):
    """[(doc_id, text, n_features, weight, score)] and the drawn ones in order, by the definition."""

    def bucket(run):
        return zlib.crc32(run.encode()) % buckets

    def counted(texts):
        return Counter(bucket(run) for text in texts for run in runs(text, max_n))

    s, t = counted(d[1] for d in docs), counted(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    }
    out = []
    for doc in docs:
        found = runs(doc[1], max_n)
        weight = sum(gain[bucket(run)] for run in found)
        name = "" if doc[0] is None else str(doc[0])
        h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc[0], doc[1], len(found), weight, score))
    able = sorted(
        (r for r in out if len(words(r[1])) >= least), key=lambda r: (-r[4], r[0] is not None, r[0] or 0)
    )
    return out, able[: percent * len(able) // 100]


@pytest.mark.parametrize("max_n, size", [(1, 1 << 20), (3, 1 << 20), (3, 7), (2, 1)])
def test_chained_checksums(max_n, size):
    text = "One, two; THREE été four\x00five\nsix  seven_eight 9"
    new, found = zip(*resampling.features(text.encode(), max_n, size))
    assert sum(new) == len(words(text))
    assert Counter(x for part in found for x in part) == Counter(zlib.crc32(r.encode()) for r in runs(text, max_n))


@pytest.mark.parametrize("max_n, buckets", [(1, 10_000), (2, 97)])
def test_against_plain_version(spark, partitions, max_n, buckets):
    partitions(5)
    data = rows.awkward(120)
    target = [d[1] for d in data[10:30]] + ["one long line", None, ""]
    docs = rows.frame(spark, data)
    bench = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    got = resampling.resample(docs, bench, buckets, max_n, 5, 40, 12).collect()
    want, drawn = plain(data, target, buckets, max_n, 5, 40, 12)
    none = lambda r: tuple(-1 if x is None else x for x in r)
    assert sorted(none((r.doc_id, r.n_features, r.weight, r.score)) for r in got) == sorted(
        none((d, n, w, s)) for d, _, n, w, s in want
    )
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [r["rank"] for r in ranked] == list(range(1, len(drawn) + 1))
    assert [(r.doc_id, r.score) for r in ranked] == [(d[0], d[4]) for d in drawn]


def test_draw_gives_whole_rows(spark):
    data = rows.awkward(60)
    docs = rows.frame(spark, data)
    bench = spark.createDataFrame([("ba r odd lines",)], "text string")
    got = resampling.draw(docs, bench, percent=50, least_words=5).collect()
    same = resampling.resample(docs, bench, percent=50, least_words=5).filter("rank IS NOT NULL").collect()
    assert sorted(r["rank"] for r in got) == list(range(1, len(same) + 1))
    assert sorted((r["rank"], r.score) for r in got) == sorted((r["rank"], r.score) for r in same)
    assert {tuple(r.row) for r in got} <= {tuple(d) for d in data}


def test_one_id_on_a_third_of_the_rows(spark):
    data = [(7 if i % 3 else i, f"some words here {i % 5} " * 6, "en", "s", 1, "", 0, "") for i in range(300)]
    bench = spark.createDataFrame([("some words",)], "text string")
    got = resampling.resample(rows.frame(spark, data), bench).collect()
    want, drawn = plain(data, ["some words"], 10_000, 1, 2024, 10, 20)
    ranked = sorted((r for r in got if r["rank"] is not None), key=lambda r: r["rank"])
    assert [(r.doc_id, r.score) for r in ranked] == [(d[0], d[4]) for d in drawn]


def test_empty(spark):
    docs, bench = rows.frame(spark, []), spark.createDataFrame([], "text string")
    assert resampling.resample(docs, bench).collect() == []
    assert resampling.resample(rows.frame(spark, rows.awkward(12)), bench).count() > 0
