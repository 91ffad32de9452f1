"""The star's sale lines: first line per key, and how often lines are shuffled."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from tillwise.sources import star

DAY = datetime.datetime(1997, 1, 5)


def test_lines_meet_their_orders_without_a_second_shuffle(spark):
    line = lambda order, part, number: (order, part, 1, number, 2.0, 20.0, DAY, 0.05, 0.0, "R", "O")
    tables = {
        "lineitem": spark.createDataFrame(
            [line(1, 7, 2), line(1, 7, 1), line(1, 7, 1), line(1, 8, 3), line(2, 7, 1), line(3, 7, 1), line(None, 7, 1)],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
            " l_shipdate timestamp, l_discount double, l_tax double, l_returnflag string, l_linestatus string",
        ),
        "orders": spark.createDataFrame(
            [(1, 5, DAY), (2, 6, DAY)], "o_orderkey long, o_custkey long, o_orderdate timestamp"
        ),
        "part": spark.createDataFrame(
            [(7, "a", "t", "b", 10.0, 3), (8, "c", "t", "b", 12.0, 4)],
            "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double, p_size int",
        ),
    }
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = star._sale_lines(tables.__getitem__)
        plan = lines._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning(l_orderkey") == 1
        got = sorted((r.order_id, r.product_id, r.line_number, r.customer_id) for r in lines.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == [(1, 7, 1, 5), (1, 8, 3, 5), (2, 7, 1, 6)]


def test_columns_derived_from_a_row_are_not_shuffled_by_month(spark, tmp_path):
    """Money and stock columns are added as rows are written; the staged facts hold them, months last."""
    spark.createDataFrame([(1, DAY, 5, 9, 7, 3, "10.00", "0.10", "4.00", "1997-01")],
        "order_id long, order_date timestamp, customer_id long, store_id long, product_id long, quantity long,"
        " unit_price string, discount_pct string, unit_cost string, month string").createOrReplaceTempView("bare")
    bare = spark.sql(
        "SELECT order_id, CAST(order_date AS DATE) order_date, customer_id, store_id, product_id, quantity,"
        " CAST(unit_price AS DECIMAL(10,2)) unit_price, CAST(discount_pct AS DECIMAL(4,2)) discount_pct,"
        " CAST(unit_cost AS DECIMAL(10,2)) unit_cost, month FROM bare"
    )
    lines = star.stage(bare, "lines", ["month"], star._with_money)
    assert "gross_revenue" not in bare.columns and lines.columns[-5:] == ["gross_revenue", "net_revenue", "cost", "profit", "month"]
    assert [str(v) for v in lines.first()[-5:]] == ["30.00", "27.00", "12.00", "15.00", "1997-01"]
    sold = star._units_sold(lines)
    assert sold.columns == ["date", "store_id", "product_id", "units_sold", "month"]
    stock = star.stage(sold, "stock", ["month"], star._inventory).first()
    assert stock["closing_stock"] == stock["opening_stock"] + stock["units_received"] - 3 and stock["month"] == "1997-01"


def test_stock_is_written_by_month_where_it_was_summed(spark, partitions):
    """Each task sums a range of dates, so no month needs to be gathered for its file."""
    partitions(4)
    lines = spark.range(4000).selectExpr(
        "date_add(date '1997-01-01', cast(id % 360 as int)) order_date", "id % 7 store_id", "id % 40 product_id", "1L quantity"
    )
    sold = star._units_sold(lines)
    stock = star.stage(sold, "stock", ["month"], star._inventory, rebalance=False)
    assert sold._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert "rangepartitioning(date" in sold._jdf.queryExecution().executedPlan().toString()
    months = sold.select("month", F.spark_partition_id().alias("task")).distinct().groupBy("task").count()
    assert max(r["count"] for r in months.collect()) <= 6  # 12 months in 4 ranges; dealt by hash a task had all 12
    assert stock.agg(F.sum("units_sold")).first()[0] == 4000
    assert stock.select("month").distinct().count() == 12


def test_stock_is_summed_after_lines_are_dealt(spark):
    """Sums are close to a row per line, so no task that reads lines holds sums of them."""
    lines = spark.createDataFrame([(DAY, 1, 7, 2), (DAY, 1, 7, 3), (DAY, None, 7, 4)], "order_date timestamp, store_id long, product_id long, quantity long")
    sold = star._units_sold(lines)
    plan = sold._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and plan.count("Exchange") == 1
    assert plan.rfind("HashAggregate") < plan.find("Exchange")
    end = datetime.date(1997, 1, 31)
    got = {(r.date, r.store_id, r.product_id, r.units_sold, r.month) for r in sold.collect()}
    assert got == {(end, 1, 7, 5, "1997-01"), (end, None, 7, 4, "1997-01")}
