"""Customer value, frequency, segments and repeat behaviour.

Every analysis excludes the unknown member. Facts are reduced to customer (or
customer-order) grain before anything is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import month_key
from tillwise.functions.numeric import dbl, lng, mean, money_mean, money_sum, pct, ratio, round2
from tillwise.model import RetailTables
from tillwise.sources.staging import stage


def known_sales(t: RetailTables) -> DataFrame:
    return t.sales.filter(F.col("customer_id") != F.lit(t.unknown_customer))


def customer_totals(t: RetailTables, *names: str) -> DataFrame:
    """``names`` of orders, spend, profit, first_date and last_date per known customer.

    A star that shares counts and sums all of them once for all who ask.
    """
    totals = {
        "orders": F.countDistinct("order_id"),
        "spend": money_sum("net_revenue"),
        "profit": money_sum("profit"),
        "first_date": F.min("order_date"),
        "last_date": F.max("order_date"),
    }

    def summed(wanted: Sequence[str]) -> DataFrame:
        return known_sales(t).groupBy("customer_id").agg(*[totals[n].alias(n) for n in wanted])

    if not t.shares:
        return summed(names)
    return t.shared("customer_totals", lambda: summed([*totals])).select("customer_id", *names)


def _spend(t: RetailTables) -> DataFrame:
    return customer_totals(t, "orders", "spend")


def customer_summary(t: RetailTables) -> DataFrame:
    """Customers, mean spend, mean orders, share with two or more orders."""
    return _spend(t).agg(
        F.count(F.lit(1)).alias("unique_customers"),
        round2(money_mean("spend")).alias("average_spend_per_customer"),
        round2(mean("orders")).alias("average_orders_per_customer"),
        pct(F.count_if(F.col("orders") >= 2), F.count(F.lit(1))).alias("repeat_customer_rate_pct"),
    )


def customer_frequency_value(t: RetailTables) -> DataFrame:
    """Frequency, spend, average order value and order span of each customer."""
    per_customer = customer_totals(t, "orders", "spend", "first_date", "last_date")
    who = t.customers.select("customer_id", "customer_name", "customer_segment")
    return (
        per_customer.join(who, "customer_id")
        .orderBy(F.desc("spend"), "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "customer_segment",
            F.col("orders").alias("purchase_frequency"),
            dbl("spend").alias("total_spend"),
            round2(ratio("spend", "orders")).alias("average_order_value"),
            F.col("first_date").alias("first_order_date"),
            F.col("last_date").alias("latest_order_date"),
        )
    )


def top_customers(t: RetailTables, n: int = 20) -> DataFrame:
    per_customer = customer_totals(t, "orders", "spend", "profit")
    who = t.customers.select("customer_id", "customer_name", "city", "province")
    return (
        per_customer.join(who, "customer_id")
        .orderBy(F.desc("spend"), "customer_id")
        .limit(n)
        .select(
            "customer_id",
            "customer_name",
            "city",
            "province",
            "orders",
            dbl("spend").alias("total_spend"),
            dbl("profit").alias("gross_profit"),
        )
    )


def customer_value_segments(t: RetailTables, high: float = 2.0) -> DataFrame:
    """High Value from ``high`` times the mean spend, Core from the mean, else Occasional.

    The customer totals are written once, by a job that runs while the plan is built: their
    mean and the rows compared with it would otherwise each aggregate the facts.
    """
    named = _spend(t).join(t.customers.select("customer_id", "customer_name"), "customer_id")
    spend = stage(named, "customer_spend")
    average = spend.agg(money_mean("spend")).scalar()
    return (
        spend.withColumn("average", average)
        .orderBy(F.desc("spend"), "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "orders",
            dbl("spend").alias("total_spend"),
            F.when(dbl("spend") >= F.col("average") * high, "High Value")
            .when(dbl("spend") >= F.col("average"), "Core")
            .otherwise("Occasional")
            .alias("value_segment"),
        )
    )


def new_vs_repeat_orders(t: RetailTables) -> DataFrame:
    """First orders and later orders per month, over all history.

    A customer has exactly one first order, dated the earliest order date, so the month
    of that date is enough: no per-customer sort is needed.
    """
    orders = known_sales(t).groupBy("customer_id", "order_id").agg(
        F.min("order_date").alias("order_date")
    )
    per_month = orders.groupBy(month_key("order_date").alias("month")).agg(
        F.count(F.lit(1)).alias("orders")
    )
    firsts = (
        customer_totals(t, "first_date")
        .groupBy(month_key("first_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("firsts"))
    )
    new = F.coalesce("firsts", F.lit(0))
    return (
        per_month.join(firsts, "month", "left")
        .select(
            "month",
            new.alias("new_customer_orders"),
            (F.col("orders") - new).alias("repeat_customer_orders"),
            pct(F.col("orders") - new, "orders").alias("repeat_order_share_pct"),
        )
        .orderBy("month")
    )


def rfm_segments(
    t: RetailTables,
    champions: tuple[int, int] = (60, 10),
    active: tuple[int, int] = (120, 5),
    at_risk_days: int = 180,
) -> DataFrame:
    """Recency, frequency and value as of the last order date, with a behaviour class.

    ``champions`` and ``active`` are (days at most, orders at least); the first class
    that fits wins, and what fits none is Developing.
    """
    as_of = t.sales.agg(F.max("order_date")).scalar()
    per_customer = customer_totals(t, "last_date", "orders", "spend").withColumnsRenamed(
        {"orders": "frequency", "spend": "value"}
    )
    aged = per_customer.withColumn("recency_days", lng(F.datediff(as_of, F.col("last_date"))))

    def within(limit: tuple[int, int]):
        return (F.col("recency_days") <= limit[0]) & (F.col("frequency") >= limit[1])

    return (
        aged.join(t.customers.select("customer_id", "customer_name"), "customer_id")
        .orderBy(F.desc("value"), "customer_id")
        .select(
            "customer_id",
            "customer_name",
            "recency_days",
            "frequency",
            dbl("value").alias("monetary_value"),
            F.when(within(champions), "Champions")
            .when(within(active), "Active")
            .when(F.col("recency_days") > at_risk_days, "At Risk")
            .otherwise("Developing")
            .alias("behavioral_segment"),
        )
    )
