"""Workbook analysis frames: unrounded fractions, positional ranks, strict lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.dates import with_month
from tillwise.functions.numeric import dbl, mean, money_sum, ratio, ratio_or_zero
from tillwise.functions.relations import checked_lookup, side_by_side
from tillwise.model import RetailTables
from tillwise.operators.customers import known_sales
from tillwise.operators.inventory import inventory_value
from tillwise.plans.distinct import distinct_and_sums
from tillwise.plans.ordered import with_order_stats


def _described(df: DataFrame, dim: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Add attributes from a dimension that must not repeat keys.

    Grouping by the attributes leaves out rows without them, so those are dropped here.
    """
    return checked_lookup(df, dim, key, columns, "inner").dropna(subset=columns)


def frame_monthly(t: RetailTables) -> DataFrame:
    monthly = with_month(t.sales, "order_date").groupBy("month").agg(
        money_sum("net_revenue").alias("rev"),
        money_sum("profit").alias("prof"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units_sold"),
    )
    lagged = monthly.withColumn("prev", F.lag("rev").over(Window.orderBy("month")))
    return lagged.select(
        "month",
        dbl("rev").alias("revenue"),
        dbl("prof").alias("profit"),
        "orders",
        "units_sold",
        dbl("prev").alias("previous_month_revenue"),
        ratio(F.col("rev") - F.col("prev"), "prev").alias("month_over_month_growth"),
    ).orderBy("month")


def frame_stores(t: RetailTables) -> DataFrame:
    totals = t.sales.groupBy("store_id").agg(
        money_sum("net_revenue").alias("rev"),
        money_sum("profit").alias("prof"),
        F.countDistinct("order_id").alias("orders"),
        F.sum("quantity").alias("units_sold"),
    )
    named = _described(
        totals, t.stores, "store_id", ["store_name", "city", "province", "store_type"]
    )
    return with_order_stats(named, ["-rev"], ["store_id"], row_number="revenue_rank").select(
        "revenue_rank",
        "store_id",
        "store_name",
        "city",
        "province",
        "store_type",
        dbl("rev").alias("revenue"),
        dbl("prof").alias("profit"),
        "orders",
        "units_sold",
        ratio("prof", "rev").alias("profit_margin"),
        ratio("rev", "orders").alias("average_order_value"),
    ).orderBy("revenue_rank")


def frame_products(t: RetailTables) -> DataFrame:
    totals = t.sales.groupBy("product_id").agg(
        money_sum("net_revenue").alias("rev"),
        money_sum("profit").alias("prof"),
        F.sum("quantity").alias("units_sold"),
        F.count(F.lit(1)).alias("sales_lines"),
        mean("discount_pct").alias("average_discount"),
    )
    named = _described(
        totals, t.products, "product_id", ["product_name", "category", "subcategory"]
    )
    return with_order_stats(named, ["-rev"], ["product_id"], row_number="revenue_rank").select(
        "revenue_rank",
        "product_id",
        "product_name",
        "category",
        "subcategory",
        dbl("rev").alias("revenue"),
        dbl("prof").alias("profit"),
        "units_sold",
        "sales_lines",
        "average_discount",
        ratio("prof", "rev").alias("profit_margin"),
    ).orderBy("revenue_rank")


def frame_customers(t: RetailTables) -> DataFrame:
    totals = known_sales(t).groupBy("customer_id").agg(
        F.countDistinct("order_id").alias("orders"),
        money_sum("net_revenue").alias("spend"),
        money_sum("profit").alias("prof"),
        F.min("order_date").alias("first"),
        F.max("order_date").alias("latest"),
    )
    named = _described(
        totals,
        t.customers,
        "customer_id",
        ["customer_name", "city", "province", "customer_segment"],
    )
    return named.orderBy(F.desc("spend"), "customer_id").select(
        "customer_id",
        "customer_name",
        "city",
        "province",
        "customer_segment",
        "orders",
        dbl("spend").alias("total_spend"),
        dbl("prof").alias("gross_profit"),
        F.date_format("first", "yyyy-MM-dd").alias("first_order"),
        F.date_format("latest", "yyyy-MM-dd").alias("latest_order"),
        ratio("spend", "orders").alias("average_order_value"),
        F.when(F.col("orders") >= 2, "Yes").otherwise("No").alias("repeat_customer"),
    )


def frame_inventory(t: RetailTables) -> DataFrame:
    totals = t.inventory.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("inventory_observations"),
        mean("closing_stock").alias("average_closing_stock"),
        F.sum("units_sold").alias("total_units_sold"),
        F.count_if(F.col("closing_stock") == 0).alias("stockout_observations"),
        F.count_if(F.col("closing_stock") < F.col("reorder_level")).alias(
            "below_reorder_observations"
        ),
    )
    named = _described(totals, t.products, "product_id", ["product_name", "category"])
    return named.select(
        "product_id",
        "product_name",
        "category",
        "inventory_observations",
        "average_closing_stock",
        "total_units_sold",
        "stockout_observations",
        "below_reorder_observations",
        ratio("stockout_observations", "inventory_observations").alias("stockout_rate"),
    ).orderBy("total_units_sold", F.desc("average_closing_stock"), "product_id")


def frame_returns_category(t: RetailTables) -> DataFrame:
    def units(fact: str, column: str, out: str) -> DataFrame:
        per_product = t.table(fact).groupBy("product_id").agg(F.sum(column).alias(out))
        named = _described(per_product, t.products, "product_id", ["category"])
        return named.groupBy("category").agg(F.sum(out).alias(out))

    sold = units("sales", "quantity", "units_sold")
    returned = units("returns", "quantity_returned", "units_returned")
    joined = sold.join(returned, "category", "left").withColumn(
        "units_returned", F.coalesce("units_returned", F.lit(0))
    )
    return joined.withColumn("return_rate", ratio("units_returned", "units_sold")).orderBy(
        F.desc("return_rate"), "category"
    )


def frame_returns_reason(t: RetailTables) -> DataFrame:
    per_reason = t.returns.groupBy("return_reason").agg(
        F.count(F.lit(1)).alias("return_records"),
        F.sum("quantity_returned").alias("units_returned"),
    )
    whole = t.returns.agg(F.sum("quantity_returned")).scalar()
    return per_reason.withColumn(
        "share_of_returned_units", ratio("units_returned", whole)
    ).orderBy(F.desc("units_returned"), "return_reason")


def executive_kpis(t: RetailTables) -> DataFrame:
    """The ten headline numbers as (metric, value); ratios are 0 on a zero denominator."""
    known = F.col("customer_id") != F.lit(t.unknown_customer)
    money = {"revenue": "net_revenue", "profit": "profit", "cost": "cost"}
    sold = distinct_and_sums(
        t.sales,
        [],
        {"orders": ("order_id", F.lit(True)), "customers": ("customer_id", known)},
        {
            **{out: lambda own, c=c: money_sum(own(F.col(c))) for out, c in money.items()},
            "units": lambda own: F.sum(own(F.col("quantity"))),
        },
    )
    stock = t.inventory.agg(
        F.count_if(F.col("closing_stock") == 0).alias("out"), F.count(F.lit(1)).alias("seen")
    )
    value = inventory_value(t, "date").agg(mean("inventory_value").alias("stock_value"))
    returned = t.returns.agg(F.sum("quantity_returned").alias("returned"))
    one = side_by_side(sold, stock, value, returned)
    kpis = one.select(
        dbl("revenue").alias("Total Revenue"),
        dbl("profit").alias("Gross Profit"),
        ratio_or_zero("profit", "revenue").alias("Profit Margin"),
        dbl("orders").alias("Orders"),
        ratio_or_zero("revenue", "orders").alias("Average Order Value"),
        dbl("units").alias("Units Sold"),
        dbl("customers").alias("Customers"),
        ratio_or_zero("returned", "units").alias("Return Rate"),
        ratio_or_zero("out", "seen").alias("Stockout Rate"),
        ratio_or_zero("cost", "stock_value").alias("Inventory Turnover"),
    )
    return kpis.unpivot([], kpis.columns, "metric", "value")


FRAMES = {
    op.__name__: op
    for op in (
        frame_monthly,
        frame_stores,
        frame_products,
        frame_customers,
        frame_inventory,
        frame_returns_category,
        frame_returns_reason,
        executive_kpis,
    )
}
