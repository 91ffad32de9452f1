"""Date dimension and calendar-aware measures at month grain."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import month_key, month_number
from tillwise.functions.numeric import lng, ratio
from tillwise.functions.relations import union_all
from tillwise.model import RetailTables


def fact_dates(t: RetailTables) -> DataFrame:
    """Dates of all three facts, duplicates kept."""
    return union_all(
        [
            t.sales.select(F.col("order_date").alias("date")),
            t.inventory.select("date"),
            t.returns.select(F.col("return_date").alias("date")),
        ]
    )


def date_dimension(t: RetailTables) -> DataFrame:
    """Every day between the first and last date of any fact, with its attributes."""
    span = fact_dates(t).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = span.filter(F.col("lo").isNotNull()).select(
        F.explode(F.sequence("lo", "hi")).alias("date")
    )
    return days.select(
        "date",
        lng(F.year("date")).alias("year"),
        lng(F.month("date")).alias("month_number"),
        F.date_format("date", "MMM").alias("month"),
        month_key("date").alias("year_month"),
        lng(F.year("date") * 100 + F.month("date")).alias("year_month_sort"),
        F.concat(F.lit("Q"), F.quarter("date").cast("string")).alias("quarter"),
    )


def on_month_axis(t: RetailTables, monthly: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``monthly`` with a row for every month of the date dimension per value of ``by``.

    The months travel as one array, bounded by the calendar.
    """
    span = fact_dates(t).agg(F.min("date").alias("lo"), F.max("date").alias("hi")).filter("lo IS NOT NULL")
    firsts = F.sequence(F.trunc("lo", "MM"), F.trunc("hi", "MM"), F.expr("INTERVAL 1 MONTH"))
    months = span.select(F.transform(firsts, month_key).alias("months"))
    if not by:
        return months.select(F.explode("months").alias("month")).join(monthly, "month", "left")
    keys = [F.col(c).alias(f"__{c}") for c in by]
    axis = monthly.select(*keys).distinct().select("*", F.explode(months.scalar()).alias("__month"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*by, "month")]
    values = [c for c in monthly.columns if c not in by and c != "month"]
    named = [F.col(f"__{c}").alias(c) for c in (*by, "month")]
    return axis.join(monthly, same, "left").select(*named, *values)


def calendar_lag(
    monthly: DataFrame, value: str, out: str, months: int = 1, by: Sequence[str] = ()
) -> DataFrame:
    """``value`` of the month ``months`` earlier within ``by``; NULL if that month is absent.

    The frame is one point on the month axis, so gaps are seen as gaps. A partition holds
    one row per month.
    """
    at = Window.partitionBy(*by).orderBy(month_number("month")).rangeBetween(-months, -months)
    return monthly.withColumn(out, F.first(value).over(at))


def growth(now: str, before: str):
    return ratio(F.col(now) - F.col(before), before)


def year_to_date(monthly: DataFrame, value: str, out: str, by: Sequence[str] = ()) -> DataFrame:
    """Running sum from January; a partition holds at most twelve rows."""
    year = F.substring("month", 1, 4)
    so_far = (
        Window.partitionBy(*by, year)
        .orderBy("month")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return monthly.withColumn(out, F.sum(value).over(so_far))
