"""Store and province analyses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import with_month
from tillwise.functions.numeric import dbl, growth_pct, money_sum, pct, ratio, round2
from tillwise.functions.relations import dealt
from tillwise.model import RetailTables
from tillwise.plans.distinct import distinct_and_sums
from tillwise.plans.ordered import global_rank


def _monthly_store(t: RetailTables) -> DataFrame:
    return (
        with_month(t.sales, "order_date")
        .groupBy("month", "store_id")
        .agg(money_sum("net_revenue").alias("revenue"))
    )


def store_scorecard(t: RetailTables) -> DataFrame:
    """Margin, average order value and revenue rank of every store.

    A store and order are close to a row per line, so orders are counted apart: sums would travel
    with every such row.
    """
    per_store = t.sales.groupBy("store_id").agg(
        money_sum("net_revenue").alias("revenue"),
        money_sum("profit").alias("profit"),
        F.sum("quantity").alias("units_sold"),
    )
    pairs = dealt(t.sales.select("store_id", "order_id"), "store_id", "order_id").distinct()
    orders = pairs.groupBy("store_id").agg(F.count("order_id").alias("orders"))
    described = per_store.join(orders, "store_id").join(t.stores.drop("opening_date"), "store_id")
    return (
        global_rank(described, ["-revenue"], ["store_id"], "revenue_rank")
        .orderBy("revenue_rank", "store_id")
        .select(
            "store_id",
            "store_name",
            "city",
            "province",
            "store_type",
            dbl("revenue").alias("revenue"),
            dbl("profit").alias("profit"),
            pct("profit", "revenue").alias("profit_margin_pct"),
            "orders",
            round2(ratio("revenue", "orders")).alias("average_order_value"),
            "units_sold",
            "revenue_rank",
        )
    )


def province_performance(t: RetailTables) -> DataFrame:
    """Selling stores, revenue, profit and distinct orders per province, in one scan of the sales."""
    lines = t.sales.select("store_id", "order_id", "net_revenue", "profit")
    return (
        distinct_and_sums(
            lines.join(t.stores.select("store_id", "province"), "store_id"),
            ["province"],
            {"stores": ("store_id", F.lit(True)), "orders": ("order_id", F.lit(True))},
            {c: lambda own, c=c: money_sum(own(F.col(c))) for c in ("net_revenue", "profit")},
        )
        .select("province", "stores", dbl("net_revenue").alias("revenue"), dbl("profit").alias("profit"), "orders")
        .orderBy(F.desc("revenue"), "province")
    )


def monthly_store_rank(t: RetailTables) -> DataFrame:
    """Revenue rank of each store within its month."""
    named = _monthly_store(t).join(t.stores.select("store_id", "store_name"), "store_id")
    return (
        global_rank(named, ["-revenue"], ["store_id"], "monthly_revenue_rank", within=["month"])
        .orderBy("month", "monthly_revenue_rank", "store_id")
        .select(
            "month",
            "store_id",
            "store_name",
            dbl("revenue").alias("revenue"),
            "monthly_revenue_rank",
        )
    )


def below_margin_stores(t: RetailTables) -> DataFrame:
    """Stores whose margin is under the company's."""
    per_store = t.sales.groupBy("store_id").agg(
        money_sum("net_revenue").alias("revenue"), money_sum("profit").alias("profit")
    )
    company = per_store.agg(ratio(F.sum("profit"), F.sum("revenue"))).scalar()
    return (
        per_store.withColumns({"margin": ratio("profit", "revenue"), "company": company})
        .filter(F.col("margin") < F.col("company"))
        .join(t.stores.select("store_id", "store_name"), "store_id")
        .orderBy("margin", "store_name")
        .select(
            "store_name",
            dbl("revenue").alias("revenue"),
            round2(F.col("margin") * 100).alias("store_margin_pct"),
            round2(F.col("company") * 100).alias("company_margin_pct"),
        )
    )


def monthly_store_change(t: RetailTables) -> DataFrame:
    """Store revenue by month, growth on the store's previous month, rank in the month."""
    # A store has at most one row per month, so this partition is bounded by the calendar.
    by_month = Window.partitionBy("store_id").orderBy("month")
    lagged = _monthly_store(t).withColumn("previous", F.lag("revenue").over(by_month))
    named = lagged.join(t.stores.select("store_id", "store_name"), "store_id")
    return (
        global_rank(named, ["-revenue"], ["store_id"], "store_rank", within=["month"])
        .orderBy("month", "store_rank", "store_id")
        .select(
            "month",
            "store_name",
            dbl("revenue").alias("revenue"),
            dbl("previous").alias("previous_month_revenue"),
            growth_pct("revenue", "previous").alias("growth_pct"),
            "store_rank",
        )
    )
