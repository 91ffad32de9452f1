from __future__ import annotations

import math
import random
import struct

import duckdb
import pytest
from pyspark.sql import functions as F

from tillcheck.compare import compare
from tillwise.llm import queries, topk

SCHEMA = "vec_id long, embedding array<float>, cell int, id string"


def brute(data, k, every):
    kept = {}
    for i, v, *_ in data:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(64 * x) for x in v]
        kept[i] = min(kept.get(i, q), q)
    out = set()
    for i, q in kept.items():
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, c)), j) for j, c in kept.items() if j != i)
            out |= {(i, r + 1, j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


def as_floats(vector):
    return list(struct.unpack(f"{len(vector)}f", struct.pack(f"{len(vector)}f", *vector)))


def vectors(n, dims, seed, copies=0):
    rng = random.Random(seed)
    out = [(i, as_floats([rng.gauss(0, 0.3) for _ in range(dims)]), 7, "x") for i in range(n)]
    hot = out[-1][1]
    return out + [(n + i, hot, 7, "y") for i in range(copies)]


@pytest.mark.parametrize("n, dims, copies", [(700, 16, 0), (300, 8, 400), (30, 3, 0), (1, 4, 0), (2, 1, 0)])
def test_against_brute_force(spark, monkeypatch, n, dims, copies):
    monkeypatch.setattr(topk, "CELL_ROWS", (40, 40))
    monkeypatch.setattr(topk, "DIRECTIONS", 6)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    data = vectors(n, dims, n, copies)
    got = topk.top_k(spark.createDataFrame(data, SCHEMA))
    assert {tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()} == brute(data, 20, 20)
    assert dict(got.dtypes)["score"] == "bigint" and dict(got.dtypes)["rank"] == "int"


def test_awkward_rows(spark):
    data = vectors(50, 4, 1)
    data += [data[3], (None, [1.0] * 4, 0, ""), (60, None, 0, ""), (80, [1.0, None, 1.0, 1.0], 0, "")]
    data += [(100, [float("nan")] * 4, 0, ""), (120, [float("inf")] * 4, 0, ""), (140, [0.5, 0.25], 0, "")]
    data += [(160, [0.0] * 4, 0, ""), (180, [-1.0] * 4, 0, "")]
    got = topk.top_k(spark.createDataFrame(data, SCHEMA), 5)
    assert {tuple(r) for r in got.collect()} == brute(
        [(i, None if v is None else v + [0.0] * (4 - len(v)) if len(v) < 4 else v) for i, v, *_ in data], 5, 20
    )


def test_repeated_ids_against_sql(spark, monkeypatch, tmp_path):
    """Other vectors under one id are candidates, a query's own id never is, and queries of one id rank together."""
    monkeypatch.setattr(topk, "CELL_ROWS", (40, 40))
    monkeypatch.setattr(topk, "DIRECTIONS", 6)
    monkeypatch.setattr(topk, "QUERY_ROWS", 16)
    data = [(i // 3 if i < 300 else i - 200, v) for i, v, *_ in vectors(500, 8, 9)] + [(40, [0.5] * 8)] * 150
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    ok, note = compare(queries.op3_topk(spark, str(tmp_path)), con, queries.OP3_SQL)
    assert ok, note
    assert not compare(topk.top_k(df), con, queries.OP3_SQL)[0]


@pytest.mark.parametrize("spread, most", [(0.02, 0.2), (0.3, 1.0)])
def test_cutoff_spares_products(spark, monkeypatch, spread, most):
    """Vectors around 12 directions meet a small part of the table; without directions nothing is met twice."""
    monkeypatch.setattr(topk, "CELL_ROWS", (40, 40))
    rng = random.Random(3)
    centres = [[rng.gauss(0, 0.3) for _ in range(16)] for _ in range(12)]
    data = [(i, [x + rng.gauss(0, spread) for x in centres[i % 12]], 7, "x") for i in range(1200)]
    frame = spark.createDataFrame(data, SCHEMA).select(
        F.col("vec_id").alias("rid"), F.col("vec_id").alias("id"), topk.quantised(F.col("embedding"), 64).alias("vector")
    )
    _, visits = topk.search(frame, 20, 20)
    met, pairs, different = visits.agg(F.sum("n"), F.count("rid"), F.countDistinct("rid", "block")).first()
    assert met <= most * 1200 * 60 and pairs == different
    got = topk.top_k(spark.createDataFrame(data, SCHEMA))
    assert {tuple(r) for r in got.collect()} == brute([(d[0], as_floats(d[1])) for d in data], 20, 20)


def test_wide_blocks_of_copies(spark, monkeypatch):
    """A vector that most rows share fills several cells of one block, and its queries several parts."""
    monkeypatch.setattr(topk, "CELL_ROWS", (20, 20))
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    data = vectors(60, 5, 2, copies=500)
    got = topk.top_k(spark.createDataFrame(data, SCHEMA))
    assert {tuple(r) for r in got.collect()} == brute(data, 20, 20)


def test_empty(spark):
    assert topk.top_k(spark.createDataFrame([], SCHEMA)).collect() == []
