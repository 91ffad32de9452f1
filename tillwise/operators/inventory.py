"""Stockouts, reorder risk, demand and turnover over month-end snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl, lng, mean, pct, ratio, round2
from tillwise.model import RetailTables
from tillwise.operators.products import NAMES, product_totals


def stockout_rate_by_store(t: RetailTables) -> DataFrame:
    """Share of observations that closed with no stock."""
    per_store = t.inventory.groupBy("store_id").agg(
        F.count(F.lit(1)).alias("inventory_observations"),
        F.count_if(F.col("closing_stock") == 0).alias("stockout_observations"),
    )
    return (
        per_store.join(t.stores.select("store_id", "store_name"), "store_id")
        .select(
            "store_id",
            "store_name",
            "inventory_observations",
            "stockout_observations",
            pct("stockout_observations", "inventory_observations").alias("stockout_rate_pct"),
        )
        .orderBy(F.desc("stockout_rate_pct"), "store_id")
    )


def stock_by_category(t: RetailTables) -> DataFrame:
    """Mean closing stock, mean reorder level and units sold per category."""
    per_product = t.inventory.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(c).alias(c) for c in ("closing_stock", "reorder_level", "units_sold")],
    )
    return (
        per_product.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(
            round2(ratio(F.sum("closing_stock"), F.sum("rows"))).alias("average_closing_units"),
            round2(ratio(F.sum("reorder_level"), F.sum("rows"))).alias("average_reorder_level"),
            F.sum("units_sold").alias("recorded_units_sold"),
        )
        .orderBy(F.desc("average_closing_units"), "category")
    )


def slow_movers(t: RetailTables, n: int = 20) -> DataFrame:
    """Least recorded units, then highest mean stock."""
    per_product = t.inventory.groupBy("product_id").agg(
        F.sum("units_sold").alias("units_sold"),
        round2(mean("closing_stock")).alias("average_closing_stock"),
        F.count_if(F.col("units_sold") == 0).alias("zero_sales_periods"),
    )
    return (
        per_product.join(t.products.select(*NAMES), "product_id")
        .orderBy("units_sold", F.desc("average_closing_stock"), "product_id")
        .limit(n)
        .select(*NAMES, "units_sold", "average_closing_stock", "zero_sales_periods")
    )


def high_demand(t: RetailTables, n: int = 20) -> DataFrame:
    """Products with most recorded units.

    The rank of a top-``n`` row depends only on rows above it, so ranking after the
    limit gives the same numbers and the window sees ``n`` rows.
    """
    per_product = t.inventory.groupBy("product_id").agg(F.sum("units_sold").alias("units_sold"))
    best = (
        per_product.join(t.products.select(*NAMES), "product_id")
        .orderBy(F.desc("units_sold"), "product_id")
        .limit(n)
    )
    rank = F.rank().over(Window.orderBy(F.desc("units_sold")))
    return best.select(*NAMES, "units_sold", lng(rank).alias("demand_rank")).orderBy(
        "demand_rank", "product_id"
    )


def below_reorder_latest(t: RetailTables) -> DataFrame:
    """Rows of the latest snapshot whose closing stock is under the reorder level."""
    stock = t.inventory
    if "month" in stock.columns:  # a partition column: only the latest partition is read below
        stock = stock.filter(F.col("month") == stock.agg(F.max("month")).scalar())
    latest = stock.agg(F.max("date")).scalar()
    short = stock.filter((F.col("date") == latest) & (F.col("closing_stock") < F.col("reorder_level")))
    return (
        short.join(t.stores.select("store_id", "store_name"), "store_id")
        .join(t.products.select(*NAMES), "product_id")
        .select(
            "date",
            "store_name",
            *NAMES,
            "closing_stock",
            "reorder_level",
            (F.col("reorder_level") - F.col("closing_stock")).alias("units_below_reorder"),
        )
        .orderBy(F.desc("units_below_reorder"), "store_name", "product_id")
    )


def inventory_value(t: RetailTables, *by: str) -> DataFrame:
    """Closing stock at unit cost, summed by ``date`` and product attributes in ``by``."""
    units = t.inventory.groupBy("date", "product_id").agg(F.sum("closing_stock").alias("units"))
    attributes = [c for c in by if c != "date"]
    priced = units.join(t.products.select("product_id", "unit_cost", *attributes), "product_id")
    value = F.col("units").cast("decimal(18,0)") * F.col("unit_cost")
    return priced.groupBy(*by).agg(F.sum(value).alias("inventory_value"))


def inventory_turnover(t: RetailTables) -> DataFrame:
    """Cost of goods sold over the mean monthly inventory value, per category."""
    cogs = (
        product_totals(t, cogs="cost")
        .join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("cogs").alias("cogs"))
    )
    average = (
        inventory_value(t, "date", "category")
        .groupBy("category")
        .agg(mean("inventory_value").alias("average_value"))
    )
    return (
        cogs.join(average, "category")
        .select(
            "category",
            dbl("cogs").alias("cost_of_goods_sold"),
            round2("average_value").alias("average_inventory_value"),
            round2(ratio("cogs", "average_value")).alias("inventory_turnover"),
        )
        .orderBy(F.desc("inventory_turnover"), "category")
    )
