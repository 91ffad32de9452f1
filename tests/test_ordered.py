"""Sliced order statistics against a plain computation, ties and hot values included."""

from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.session import local_session
from tillwise.plans.ordered import global_rank, global_running_sum, with_order_stats


def expected(rows):
    """(group, value, key) -> (rank, row_number, running sum) by value desc, key."""
    out = {}
    groups = {}
    for g, v, k in rows:
        groups.setdefault(g, []).append((v, k))
    for g, members in groups.items():
        # NULL sorts lowest, so last in descending order.
        members.sort(key=lambda m: (m[0] is None, -(m[0] or 0), m[1]))
        total, seen, rank = None, 0, 0
        previous = object()
        for v, k in members:
            seen += 1
            if v != previous:
                rank, previous = seen, v
            total = total if v is None else (total or 0) + v
            out[(g, k)] = (rank, seen, total)
    return out


def run(spark, rows):
    df = spark.createDataFrame(rows, "g string, v long, k long")
    got = with_order_stats(
        df, ["-v"], ["k"], within=["g"], rank="r", row_number="n", running={"s": "v"}
    ).collect()
    assert len(got) == len(rows)
    return {(x.g, x.k): (x.r, x.n, x.s) for x in got}


@pytest.mark.parametrize("slices", [1, 3, 16])
@pytest.mark.parametrize("distinct", [1, 2, 5, 1000])
def test_groups_ties_and_slices(spark, partitions, slices, distinct):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partitions(slices)
        rng = random.Random(slices * 1000 + distinct)
        rows = [
            (rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(distinct)]), k)
            for k in range(400)
        ]
        assert run(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@settings(max_examples=8, deadline=None)
@given(
    st.lists(
        st.tuples(st.sampled_from(["a", "b"]), st.integers(-3, 3)), min_size=1, max_size=60
    )
)
def test_random_rows(pairs):
    spark = local_session()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(g, v, k) for k, (g, v) in enumerate(pairs)]
        assert run(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("slices", [1, 3, 16])
@pytest.mark.parametrize("distinct", [1, 2, 5, 1000])
def test_ranks_without_windows(spark, partitions, slices, distinct):
    """Ranks and row numbers counted along the slices, alone and per group, rows shuffled once."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partitions(slices)
        rng = random.Random(slices * 999 + distinct)
        rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, *range(distinct)]), k) for k in range(400)]
        df = spark.createDataFrame(rows, "g string, v long, k long")
        want = expected(rows)
        grouped = with_order_stats(df, ["-v"], ["k"], within=["g"], rank="r", row_number="n", total={"t": "v"})
        assert {(x.g, x.k): (x.r, x.n) for x in grouped.collect()} == {k: x[:2] for k, x in want.items()}
        assert {x.t for x in grouped.collect()} == {sum(v or 0 for _, v, _ in rows)}
        alone = {k: x for (_, k), x in expected([(0, v, k) for _, v, k in rows]).items()}
        got = global_rank(df, ["-v"], ["k"], "r")
        assert {x.k: x.r for x in got.collect()} == {k: x[0] for k, x in alone.items()}
        assert got.columns == ["g", "v", "k", "r"]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Exchange (hash|range)partitioning\([^)]*\bk\b", plan)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_one_hot_value_spreads_over_slices(spark, partitions):
    """Most rows share one value; they must still land in several slices."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        partitions(8)
        rows = [("a", 7 if k % 10 else k, k) for k in range(2000)]
        df = spark.createDataFrame(rows, "g string, v long, k long")
        sliced = df.repartitionByRange(df.v.desc(), df.k.asc()).rdd.glom().map(len).collect()
        assert max(sliced) < 1000
        assert run(spark, rows) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_totals_and_shortcuts(spark):
    df = spark.createDataFrame([(3, 1), (2, 2), (2, 3)], "v long, k long")
    total = with_order_stats(df, ["-v"], ["k"], rank="r", total={"t": "v"}).collect()
    assert {x.t for x in total} == {7}
    assert [x.r for x in global_rank(df, ["-v"], ["k"], "r").orderBy("k").collect()] == [1, 2, 2]
    running = global_running_sum(df, ["v"], "v", ["k"], "s").orderBy("k").collect()
    assert [x.s for x in running] == [7, 2, 4]


def test_empty_input(spark):
    df = spark.createDataFrame([], "g string, v long, k long")
    assert with_order_stats(df, ["-v"], ["k"], rank="r", running={"s": "v"}).count() == 0


@pytest.mark.parametrize("slices", [1, 5])
def test_row_numbers_alone(spark, partitions, slices):
    partitions(slices)
    rng = random.Random(slices)
    rows = [("a", rng.choice([None, 1, 2, 3]), k) for k in range(300)]
    df = spark.createDataFrame(rows, "g string, v long, k long")
    numbered = with_order_stats(df, ["-v"], ["k"], row_number="n", total={"whole": "v"})
    want = expected(rows)
    got = numbered.collect()
    assert {(r.g, r.k): r.n for r in got} == {key: x[1] for key, x in want.items()}
    assert {r.whole for r in got} == {sum(v or 0 for _, v, _ in rows)}
    assert "Window" not in numbered.select("k", "v").distinct()._jdf.queryExecution().optimizedPlan().toString()
