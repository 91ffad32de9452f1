"""Month-end demand, gap filling and stock roll-forward."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.model import RetailTables


def monthly_demand(t: RetailTables, keys: Sequence[str] = ("store_id", "product_id")) -> DataFrame:
    """Units sold per month end and key."""
    return t.sales.groupBy(F.last_day("order_date").alias("date"), *keys).agg(
        F.sum("quantity").alias("units")
    )


def densify_grid(
    demand: DataFrame, keys: Sequence[str] = ("store_id", "product_id"), value: str = "units"
) -> DataFrame:
    """A row for every month of the calendar and every key that ever occurs; gaps are 0.

    Each key carries its own month list, so months multiply keys without a cross join.
    Key combinations that never occur would be all zero and are not produced.
    """
    span = demand.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    months = F.sequence(
        F.trunc(span.select("lo").scalar(), "month"),
        F.trunc(span.select("hi").scalar(), "month"),
        F.expr("interval 1 month"),
    )
    cells = (
        demand.select(*keys)
        .distinct()
        .withColumn("month_start", F.explode(months))
        .withColumn("date", F.last_day("month_start"))
        .drop("month_start")
    )
    return cells.join(demand, [*keys, "date"], "left").select(
        "date", *keys, F.coalesce(value, F.lit(0)).alias(value)
    )


def inventory_rollforward(inventory: DataFrame) -> DataFrame:
    """Carry stock forward from the first opening balance and the recorded flows.

    opening(t) = closing(t-1) and closing = opening + received - sold. A store-product
    has one row per month, so its window is bounded by the calendar.
    """
    by_date = Window.partitionBy("store_id", "product_id").orderBy("date")
    so_far = by_date.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    flow = F.col("units_received") - F.col("units_sold")
    closing = F.first("opening_stock").over(so_far) + F.sum(flow).over(so_far)
    return inventory.withColumn("__closing", closing).select(
        "date",
        "store_id",
        "product_id",
        (F.col("__closing") - flow).alias("opening_stock"),
        "units_received",
        "units_sold",
        F.col("__closing").alias("closing_stock"),
    )
