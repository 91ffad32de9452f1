"""Sales trends over time, discount bands and baskets.

Windows without PARTITION BY appear only over month-grain rows, whose number is bounded
by the calendar.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import with_month
from tillwise.functions.numeric import dbl, growth_pct, lng, mean, money_mean, money_sum, pct, round2
from tillwise.model import RetailTables
from tillwise.plans.calendar import calendar_lag


def monthly_revenue(t: RetailTables) -> DataFrame:
    """(month, revenue) as an exact decimal."""
    return with_month(t.sales, "order_date").groupBy("month").agg(
        money_sum("net_revenue").alias("revenue")
    )


def monthly_sales(t: RetailTables) -> DataFrame:
    """Revenue, profit, distinct orders and units per month."""
    return (
        with_month(t.sales, "order_date")
        .groupBy("month")
        .agg(
            dbl(money_sum("net_revenue")).alias("revenue"),
            dbl(money_sum("profit")).alias("profit"),
            F.countDistinct("order_id").alias("orders"),
            F.sum("quantity").alias("units_sold"),
        )
        .orderBy("month")
    )


def with_previous(monthly: DataFrame, out: str, calendar: bool = False, by: int = 1) -> DataFrame:
    """Add revenue of the ``by``-th earlier row, or of the calendar month ``by`` back."""
    if calendar:
        return calendar_lag(monthly, "revenue", out, by)
    return monthly.withColumn(out, F.lag("revenue", by).over(Window.orderBy("month")))


def month_over_month(t: RetailTables, calendar: bool = False) -> DataFrame:
    """Growth against the previous month present, or the previous calendar month."""
    grown = with_previous(monthly_revenue(t), "previous_month_revenue", calendar)
    return grown.select(
        "month",
        dbl("revenue").alias("revenue"),
        dbl("previous_month_revenue").alias("previous_month_revenue"),
        growth_pct("revenue", "previous_month_revenue").alias("growth_pct"),
    ).orderBy("month")


def calendar_month_strength(t: RetailTables) -> DataFrame:
    """January to December, pooled over the years."""
    return (
        t.sales.groupBy(F.month("order_date").alias("m"), F.date_format("order_date", "MMMM").alias("month_name"))
        .agg(
            dbl(money_sum("net_revenue")).alias("revenue"),
            F.countDistinct("order_id").alias("orders"),
        )
        .select(lng("m").alias("month_number"), "month_name", "revenue", "orders")
        .orderBy(F.desc("revenue"), "month_number")
    )


def discount_band(edges: Sequence[float] = (0, 0.10, 0.20)) -> Column:
    """Band label of ``discount_pct``: none up to the first edge, open above the last."""
    if any(low >= high for low, high in zip(edges, edges[1:])):
        raise ValueError(f"band edges must ascend: {list(edges)}")
    percent = [(Decimal(str(e)) * 100).normalize() for e in edges]
    whole = all(p == p.to_integral_value() for p in percent)
    names = [f"{p:f}" for p in percent]
    # Between whole percents the next band starts one above; else it starts past the edge.
    labels = ["No discount" if edges[0] == 0 else f"Up to {names[0]}%"] + [
        f"{int(low) + 1}-{high}%" if whole else f"Over {low:f} to {high}%"
        for low, high in zip(percent, names[1:])
    ]
    band = F.when(F.col("discount_pct") <= F.lit(str(edges[0])).cast("decimal(9,6)"), labels[0])
    for edge, label in zip(edges[1:], labels[1:]):
        band = band.when(F.col("discount_pct") <= F.lit(str(edge)).cast("decimal(9,6)"), label)
    return band.otherwise(f"Over {names[-1]}%")


def discount_bands(t: RetailTables, edges: Sequence[float] = (0, 0.10, 0.20)) -> DataFrame:
    """Lines, mean discount, revenue and margin per discount band."""
    return (
        t.sales.groupBy(discount_band(edges).alias("discount_band"))
        .agg(
            F.count(F.lit(1)).alias("sales_lines"),
            round2(mean("discount_pct") * 100).alias("average_discount_pct"),
            dbl(money_sum("net_revenue")).alias("revenue"),
            dbl(money_sum("profit")).alias("profit"),
            pct(money_sum("profit"), money_sum("net_revenue")).alias("profit_margin_pct"),
        )
        .orderBy("average_discount_pct")
    )


def running_revenue(t: RetailTables) -> DataFrame:
    """Monthly revenue with its running total."""
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        monthly_revenue(t)
        .select(
            "month",
            dbl("revenue").alias("revenue"),
            dbl(F.sum("revenue").over(so_far)).alias("running_revenue"),
        )
        .orderBy("month")
    )


def basket_size(t: RetailTables) -> DataFrame:
    """Orders by number of product lines, with mean units and value."""
    baskets = t.sales.groupBy("order_id", "order_date").agg(
        F.sum("quantity").alias("units"),
        F.count(F.lit(1)).alias("product_lines"),
        money_sum("net_revenue").alias("value"),
    )
    return (
        baskets.groupBy("product_lines")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            round2(mean("units")).alias("average_units"),
            round2(money_mean("value")).alias("average_order_value"),
        )
        .orderBy("product_lines")
    )


def year_over_year(t: RetailTables, calendar: bool = False) -> DataFrame:
    """Months against the row (or calendar month) twelve earlier."""
    compared = with_previous(monthly_revenue(t), "prior_year_revenue", calendar, by=12)
    return (
        compared.filter(F.col("prior_year_revenue").isNotNull())
        .select(
            "month",
            dbl("revenue").alias("revenue"),
            dbl("prior_year_revenue").alias("prior_year_revenue"),
            growth_pct("revenue", "prior_year_revenue").alias("year_over_year_growth_pct"),
        )
        .orderBy("month")
    )
