"""Bitmap distinct counts: exact for every id, one scan for all of them."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.small_star import tiny_star
from tillwise.functions.numeric import money_sum
from tillwise.model import RetailTables
from tillwise.operators import frames, stores
from tillwise.plans import measures
from tillwise.plans.distinct import distinct_and_sums
from tillwise.plans.measures import measure_by

ORDERS = [
    "ORD000001", "ORD0000001", "ORD00001", "ORD000064", "ORD000065", "ORD1000000", "ORD01000000", "ord000001", "ORD", "",
    "ORD-00001", "ORD00000x", "ORD9223372036854775807", "ORD99999999999999999999", "ORD999999999999999999", " ORD000001",
    "ORD+000001", None, "é", "XORD000001", "ORD000001 ", "ORD1e5000",
]


def data(n=3000, seed=3):
    rng = random.Random(seed)
    ids = ORDERS + [f"ORD{i:06d}" for i in rng.sample(range(100_000), 200)]
    return [
        (rng.choice(["a", "b", None]), rng.choice(ids), rng.choice([None, -5, -1, 0, 63, 64, 1 << 40, *range(100)]),
         Decimal(rng.randint(-500, 500)) / 100, rng.randint(0, 9))
        for _ in range(n)
    ]


SCHEMA = "g string, order_id string, store_id long, amount decimal(12,2), units long"


@pytest.mark.parametrize("by", [["g"], []])
def test_against_sets(spark, by):
    rows = data()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = distinct_and_sums(
        df, by,
        {"orders": ("order_id", F.lit(True)), "big": ("order_id", F.col("units") > 4), "stores": ("store_id", F.lit(True))},
        {"amount": lambda own: money_sum(own(F.col("amount"))), "units": lambda own: F.sum(own(F.col("units")))},
    ).collect()
    groups = {r[0] for r in rows} if by else {0}
    assert len(got) == len(groups)
    for r in got:
        mine = [x for x in rows if not by or x[0] == r.g]
        ids = lambda at, keep=lambda x: True: len({x[at] for x in mine if keep(x) and x[at] is not None})
        assert (r.orders, r.big, r.stores) == (ids(1), ids(1, lambda x: x[4] > 4), ids(2))
        assert (r.amount, r.units) == (sum(x[3] for x in mine), sum(x[4] for x in mine))


def test_counts_alone_and_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    ids = {"orders": ("order_id", F.lit(True)), "stores": ("store_id", F.lit(True))}
    assert [tuple(r) for r in distinct_and_sums(df, [], ids).collect()] == [(0, 0)]
    assert distinct_and_sums(df, ["g"], ids).collect() == []
    nothing = spark.createDataFrame([("a", None, None, None, None)], SCHEMA)
    assert [tuple(r) for r in distinct_and_sums(nothing, ["g"], ids).collect()] == [("a", 0, 0)]


def test_sales_are_read_once(spark):
    star = tiny_star(spark)
    kpis = star.replace(inventory=star.inventory.limit(0), returns=star.returns.limit(0))
    lines = star.sales.select("order_id", "customer_id", "store_id", "net_revenue", "profit", "cost", "quantity", "order_date", "product_id")
    path = f"{spark.conf.get('spark.checkpoint.dir')}/once"
    lines.write.mode("overwrite").parquet(path)
    kpis = kpis.replace(sales=spark.read.parquet(path))
    for df in (
        frames.executive_kpis(kpis), stores.province_performance(kpis),
        measure_by(kpis, ["orders", "customers", "total_revenue", "units_sold"], ["province"]),
        measure_by(kpis, ["orders", "customers", "total_revenue"]),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert sum("FileScan" in line and "order_id" in line for line in plan.split("\n")) == 1
        assert plan.count("SortAggregate") == 0


def test_repeat_customers_are_counted_after_lines_are_dealt(spark, partitions):
    """No task that reads lines holds their orders; a NULL order is none, and several lines of one order are one."""
    partitions(7)
    rows = [(1, 5), (1, 5), (2, 5), (3, 6), (3, 6), (None, 6), (4, None), (5, None), (6, 0), (7, 0), (8, 9), (9, 9), (9, 9)]
    sales = spark.createDataFrame(rows, "order_id long, customer_id long")
    t = RetailTables(unknown_customer=0, sales=sales)
    found = measures._repeat_customers(t, [], "n")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_NUM") == 2 and plan.rstrip().rfind("HashAggregate") < plan.rfind("Exchange hashpartitioning")
    assert found.first().n == 2
    by = measures._repeat_customers(t, ["customer_id"], "n").collect()
    assert {r.customer_id: r.n for r in by} == {5: 1, 6: 0, 9: 1}
