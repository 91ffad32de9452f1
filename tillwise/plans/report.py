"""Model-level work: enriching returns and the report tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.numeric import dbl, ratio
from tillwise.functions.relations import rows_for, side_by_side
from tillwise.model import RetailTables
from tillwise.plans.measures import measure_by
from tillwise.plans.ordered import global_rank


def enrich_returns(
    t: RetailTables, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Returns with store and customer of their sale line.

    A cleaned sales key is unique, so no row is added or dropped;
    :func:`enrichment_check` confirms it.

    With ``keep``, such as :func:`stage`, the lines that were returned are found and written first.
    Sales stored in buckets are then not shuffled, and a line with very many returns can still be
    split between tasks.
    """
    lines = t.sales.select("order_id", "product_id", "store_id", "customer_id")
    if keep:
        lines = keep(rows_for(lines, t.returns, ["order_id", "product_id"]), "returned_lines")
    return t.returns.join(lines, ["order_id", "product_id"], "left").select(
        *t.returns.columns, "store_id", "customer_id"
    )


def enrichment_check(t: RetailTables) -> DataFrame:
    """Row counts before and after enrichment, and the rows that found no sale."""
    return side_by_side(
        t.returns.agg(F.count(F.lit(1)).alias("rows_before")),
        enrich_returns(t).agg(
            F.count(F.lit(1)).alias("rows_after"),
            F.count_if(F.col("store_id").isNull()).alias("unmatched"),
        ),
    )


def monthly_revenue_profit(t: RetailTables) -> DataFrame:
    return measure_by(t, ["total_revenue", "total_profit"], ["month"]).orderBy("month")


def revenue_by_category(t: RetailTables) -> DataFrame:
    by = measure_by(t, ["total_revenue"], ["category"])
    return by.orderBy(F.desc("total_revenue"), "category")


def revenue_by_store(t: RetailTables) -> DataFrame:
    by = measure_by(t, ["total_revenue"], ["store_id", "store_name"])
    return by.orderBy(F.desc("total_revenue"), "store_id")


def product_ranking(t: RetailTables) -> DataFrame:
    """Every product with revenue, profit, margin, units and revenue rank."""
    by = measure_by(
        t,
        ["total_revenue", "total_profit", "profit_margin", "units_sold"],
        ["product_id", "product_name", "category"],
    )
    ranked = global_rank(by, ["-total_revenue"], ["product_id"], "revenue_rank")
    return ranked.orderBy("revenue_rank", "product_id")


def margin_by_category(t: RetailTables) -> DataFrame:
    by = measure_by(t, ["profit_margin"], ["category"])
    return by.orderBy(F.desc("profit_margin"), "category")


def discount_vs_margin(t: RetailTables) -> DataFrame:
    """Mean discount, margin and revenue per product."""
    return measure_by(
        t, ["average_discount", "profit_margin", "total_revenue"], ["product_id", "product_name"]
    )


def closing_value_by_category(t: RetailTables) -> DataFrame:
    by = measure_by(t, ["closing_inventory_value"], ["category"])
    return by.orderBy(F.desc("closing_inventory_value"), "category")


def stockout_matrix(
    t: RetailTables, categories: Sequence[str] = model.CATEGORIES, other: str = "other"
) -> DataFrame:
    """Stockout rate with a row per store and a column per category.

    Products of any other category are summed up in the column ``other``.
    """
    if other in categories:
        raise ValueError(f"{other} is the name of a category")
    listed = F.when(F.col("category").isin(*categories), F.col("category")).otherwise(F.lit(other))
    counts = (
        t.inventory.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("store_id", listed.alias("category"))
        .agg(
            F.count_if(F.col("closing_stock") == 0).alias("out"),
            F.count(F.lit(1)).alias("seen"),
        )
    )
    columns = [*categories, other]
    rates = counts.groupBy("store_id").pivot("category", columns).agg(
        ratio(F.sum("out"), F.sum("seen"))
    )
    return rates.join(t.stores.select("store_id", "store_name"), "store_id").select(
        "store_id", "store_name", *[dbl(F.col(f"`{c}`")).alias(c) for c in columns]
    )


def customers_by_segment(t: RetailTables) -> DataFrame:
    by = measure_by(t, ["customers", "total_revenue"], ["customer_segment"])
    return by.orderBy("customer_segment")
