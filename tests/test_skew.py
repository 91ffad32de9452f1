"""A third of all rows on one key: whole results, and no plan that gathers them."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tillcheck.registry import all_queries, suspect_star
from tests.small_star import tiny_star
from tillwise import model
from tillwise.model import RetailTables
from tillwise.operators import cleaning, customers, products, returns, stores, validation
from tillwise.sources.staging import stage
from tillwise.sources.star import benchmark_star

N = 3000


@pytest.fixture(scope="module")
def hot(spark):
    """One customer, store and product hold a third of the sales; one sale line many returns."""
    third = F.col("id") % 3 == 0
    pick = lambda p, n: F.when(third, F.lit(f"{p}0")).otherwise(
        F.concat(F.lit(p), (F.col("id") % n + 1).cast("string"))
    )
    sales = spark.range(N).select(
        F.concat(F.lit("O"), (F.col("id") / 2).cast("long").cast("string")).alias("order_id"),
        F.expr("date_add(date '2023-01-01', cast(id % 400 as int))").alias("order_date"),
        pick("C", 40).alias("customer_id"),
        pick("S", 5).alias("store_id"),
        F.concat(F.lit("P"), F.when(third, F.lit(0)).otherwise(F.col("id") % 30 + 1).cast("string")).alias("product_id"),
        F.lit(2).cast("long").alias("quantity"),
        F.lit("10.00").cast(model.PRICE).alias("unit_price"),
        F.lit("0").cast(model.RATE).alias("discount_pct"),
        F.lit("4.00").cast(model.PRICE).alias("unit_cost"),
    )
    sales = cleaning.derive_measures(sales).dropDuplicates(["order_id", "product_id"])
    base = tiny_star(spark)
    products_ = spark.range(31).selectExpr(
        "concat('P', id) product_id", "concat('n', id) product_name", "if(id = 0, 'Home', 'Office') category",
        "'s' subcategory", "cast(4 as decimal(12,2)) unit_cost", "cast(10 as decimal(12,2)) unit_price", "'x' supplier",
    )
    customers_ = spark.range(41).selectExpr(
        "concat('C', id) customer_id", "'n' customer_name", "'c' city", "'p' province", "date '2020-01-01' signup_date", "'New' customer_segment"
    )
    stores_ = spark.range(6).selectExpr(
        "concat('S', id) store_id", "concat('n', id) store_name", "'c' city", "'p' province", "'Urban' store_type", "date '2020-01-01' opening_date"
    )
    line = sales.filter("product_id = 'P0'").orderBy("order_id").limit(1)
    returned = line.select("order_id", "product_id", F.explode(F.sequence(F.lit(1), F.lit(500))).alias("n")).selectExpr(
        "concat('R', n) return_id", "order_id", "product_id", "date '2025-01-01' return_date", "1L quantity_returned", "'Damaged' return_reason"
    )
    return RetailTables(
        customers=customers_, products=products_, stores=stores_, sales=sales, inventory=base.inventory, returns=returned
    )


def test_hot_keys_give_whole_results(hot):
    lines = hot.sales.collect()
    by = lambda key: {k: sum(r.quantity for r in lines if r[key] == k) for k in {r[key] for r in lines}}
    units = {r.store_id: r.units_sold for r in stores.store_scorecard(hot).collect()}
    assert units == by("store_id")
    value = {r.customer_id: r.total_spend for r in customers.customer_frequency_value(hot).collect()}
    assert value == {k: 10.0 * u for k, u in by("customer_id").items()}
    assert {r.product_id: r.units_sold for r in products.top_products_by_revenue(hot, 100).collect()} == by("product_id")
    assert returns.overall_return_rate(hot).first().units_returned == 500
    assert sum(r.units_returned for r in returns.store_return_rate(hot).collect()) == 500
    orders = {(r.customer_id, r.order_id) for r in lines}
    got = customers.new_vs_repeat_orders(hot).collect()
    assert sum(r.new_customer_orders + r.repeat_customer_orders for r in got) == len(orders)
    assert sum(r.new_customer_orders for r in got) == len({c for c, _ in orders})


def test_hot_foreign_key_counts_every_row(hot):
    lost = hot.replace(customers=hot.customers.filter("customer_id <> 'C0'"))
    report = validation.check_foreign_key(lost, "sales", ("customer_id",), "customers").first()
    assert report.violations == hot.sales.filter("customer_id = 'C0'").count()


def test_joins_stay_whole_without_broadcast(spark, hot):
    """The same rows when every join has to shuffle."""
    picks = (products.category_performance, stores.province_performance, returns.store_return_rate, customers.rfm_segments)
    small = [sorted(map(tuple, op(hot).collect()), key=str) for op in picks]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert [sorted(map(tuple, op(hot).collect()), key=str) for op in picks] == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


# Single-task windows that see only a bounded number of rows: one per month, or top n.
BOUNDED_WINDOWS = {
    "month_over_month", "month_over_month_calendar", "running_revenue", "year_over_year",
    "year_over_year_calendar", "frame_monthly", "high_demand",
}


@pytest.mark.parametrize("name", [n for n in all_queries() if n != "run_suite"])  # its members are checked here
def test_no_plan_crosses_or_gathers(spark, name):
    """No cross join, no Python worker, and single-task windows only where bounded."""
    try:
        for broadcast in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
            query = all_queries()[name](spark, "/root/testdata/sf0.001")
            plan = query._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "NestedLoop" not in plan
            assert not re.search(r"Python|Pandas|InArrow", plan)
            gathered = re.findall(r"Window \[([^\n]*)\n[^\n]*Sort [^\n]*\n[^\n]*Exchange SinglePartition", plan)
            # Offsets of ordered slices are summed over one row per slice.
            gathered = [w for w in gathered if "__slice" not in w]
            assert not gathered or name in BOUNDED_WINDOWS
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_suspect_star_is_lazy(spark):
    t = suspect_star(benchmark_star(spark, "/root/testdata/sf0.001"))
    assert t.names() == list(model.TABLES)


def _final_plan(df):
    """Run ``df`` and return the plan adaptive execution ended with."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture
def eager_skew_handling(spark):
    """Thresholds low enough for test data, and no broadcast."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_unknown_customers_do_not_pile_up(spark, eager_skew_handling, partitions):
    """A third of the sales have no customer; the join on the dimension is split."""
    partitions(8)
    sales = spark.range(200_000).selectExpr(
        "id", "if(id % 3 = 0, null, concat('C', id % 500)) customer_id", "uuid() payload"
    )
    sales = stage(sales.repartition(8), "hot_sales")
    dim = spark.range(400).selectExpr("concat('C', id) customer_id")
    mapped = cleaning.map_unknown_member(sales, dim, "customer_id", "none", keep=stage)
    plan = _final_plan(mapped)
    assert "SortMergeJoin(skew=true)" in plan
    assert mapped.count() == 200_000
    expected = sales.filter("customer_id is null or cast(substr(customer_id, 2) as int) >= 400").count()
    assert mapped.filter("customer_id = 'none'").count() == expected


def test_many_returns_of_one_sale_line_are_split(spark, eager_skew_handling, partitions):
    partitions(8)
    returned = spark.range(150_000).selectExpr(
        "uuid() return_id",
        "if(id % 3 = 0, 'O0', concat('O', id % 2000)) order_id",
        "'P' product_id",
        "date_add(date '2024-01-01', cast(id % 50 as int)) return_date",
        "1.0D quantity_returned",
    )
    returned = stage(returned.repartition(8), "hot_returns")
    sales = stage(
        spark.range(2000).selectExpr(
            "concat('O', id) order_id", "'P' product_id", "date '2024-01-11' order_date", "1L quantity"
        ),
        "sales",
    )
    matched = cleaning.match_returns(returned, sales)
    assert "SortMergeJoin(skew=true)" in _final_plan(matched)
    assert matched.count() == returned.filter("return_date >= date '2024-01-11'").count()


def test_staging_by_a_hot_month_uses_several_writers(spark, partitions):
    partitions(8)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(60_000).selectExpr("id", "uuid() payload", "if(id % 3 = 0, '2024-01', concat('2023-', id % 12)) month")
        staged = stage(rows.repartition(8), "by_month", ["month"])
        hot = [f for f in staged.inputFiles() if "month=2024-01" in f]
        assert len(hot) > 1
        assert staged.count() == 60_000
        empty = stage(rows.limit(0), "by_month", ["month"])
        assert empty.count() == 0 and empty.columns == rows.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
