"""First look at the star: counts, filters, catalogue summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl, mean, round2
from tillwise.functions.relations import union_all
from tillwise.model import RetailTables
from tillwise.operators.products import product_totals


def table_row_counts(t: RetailTables) -> DataFrame:
    """Row count of every table."""
    counts = [
        t.table(name)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count")
        for name in t.names()
    ]
    return union_all(counts).orderBy("table_name")


def discounted_lines(t: RetailTables, min_revenue: float = 200, n: int = 25) -> DataFrame:
    """Newest discounted lines worth at least ``min_revenue``."""
    return (
        t.sales.filter((F.col("discount_pct") > 0) & (F.col("net_revenue") >= min_revenue))
        .orderBy(F.desc("order_date"), F.desc("net_revenue"), "order_id", "product_id")
        .limit(n)
        .select(
            "order_id",
            "order_date",
            "product_id",
            dbl("net_revenue").alias("net_revenue"),
            dbl("discount_pct").alias("discount_pct"),
        )
    )


def category_catalog(t: RetailTables) -> DataFrame:
    """Products, mean list price and mean unit margin per category."""
    return (
        t.products.groupBy("category")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            round2(mean("unit_price")).alias("average_list_price"),
            round2(mean(F.col("unit_price") - F.col("unit_cost"))).alias("average_unit_margin"),
        )
        .orderBy(F.desc("average_list_price"), "category")
    )


def large_suppliers(t: RetailTables, min_products: int = 10) -> DataFrame:
    """Suppliers with at least ``min_products`` products."""
    return (
        t.products.groupBy("supplier")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            round2(mean("unit_price")).alias("average_price"),
        )
        .filter(F.col("product_count") >= min_products)
        .orderBy(F.desc("product_count"), "supplier")
    )


def lowest_revenue_products(t: RetailTables, n: int = 20) -> DataFrame:
    """Bottom products by revenue, never-sold ones included."""
    sold = product_totals(t, units_sold="quantity", revenue="net_revenue")
    return (
        t.products.select("product_id", "product_name", "category")
        .join(sold, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
            round2(F.coalesce("revenue", F.lit(0))).alias("revenue"),
        )
        .orderBy("revenue", "product_id")
        .limit(n)
    )
