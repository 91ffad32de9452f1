"""Return rates. Sold and returned units are always aggregated apart, then combined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.numeric import pct
from tillwise.functions.relations import side_by_side
from tillwise.model import RetailTables
from tillwise.operators.products import NAMES, category_units, product_totals


def _with_rate(df: DataFrame) -> DataFrame:
    filled = df.withColumn("units_returned", F.coalesce("units_returned", F.lit(0)))
    return filled.withColumn("return_rate_pct", pct("units_returned", "units_sold"))


def _units(t: RetailTables, fact: str, column: str, key: str, out: str) -> DataFrame:
    return t.table(fact).groupBy(key).agg(F.sum(column).alias(out))


def overall_return_rate(t: RetailTables) -> DataFrame:
    both = side_by_side(
        t.sales.agg(F.sum("quantity").alias("units_sold")),
        t.returns.agg(F.sum("quantity_returned").alias("units_returned")),
    )
    return both.withColumn("return_rate_pct", pct("units_returned", "units_sold"))


def product_returns(t: RetailTables, n: int = 25) -> DataFrame:
    """Products with most returned units."""
    sold = product_totals(t, units_sold="quantity")
    returned = _units(t, "returns", "quantity_returned", "product_id", "units_returned")
    joined = t.products.select(*NAMES).join(sold, "product_id").join(returned, "product_id", "left")
    return (
        _with_rate(joined)
        .select(*NAMES, "units_sold", "units_returned", "return_rate_pct")
        .orderBy(F.desc("units_returned"), F.desc("return_rate_pct"), "product_id")
        .limit(n)
    )


def category_return_rate(t: RetailTables) -> DataFrame:
    sold = category_units(t, "sales", "quantity", "units_sold")
    returned = category_units(t, "returns", "quantity_returned", "units_returned")
    return (
        _with_rate(sold.join(returned, "category", "left"))
        .select("category", "units_sold", "units_returned", "return_rate_pct")
        .orderBy(F.desc("return_rate_pct"), "category")
    )


def return_reasons(t: RetailTables) -> DataFrame:
    """Records, units and share of units per reason."""
    whole = t.returns.agg(F.sum("quantity_returned")).scalar()
    return (
        t.returns.groupBy("return_reason")
        .agg(
            F.count(F.lit(1)).alias("return_records"),
            F.sum("quantity_returned").alias("units_returned"),
        )
        .withColumn("share_of_returned_units_pct", pct("units_returned", whole))
        .orderBy(F.desc("units_returned"), "return_reason")
    )


def store_return_rate(t: RetailTables) -> DataFrame:
    """Returns find their store through the sale line they refer to."""
    sold = _units(t, "sales", "quantity", "store_id", "units_sold")
    per_line = t.returns.groupBy("order_id", "product_id").agg(
        F.sum("quantity_returned").alias("units")
    )
    returned = (
        per_line.join(
            t.sales.select("order_id", "product_id", "store_id"), ["order_id", "product_id"]
        )
        .groupBy("store_id")
        .agg(F.sum("units").alias("units_returned"))
    )
    joined = (
        t.stores.select("store_id", "store_name")
        .join(sold, "store_id")
        .join(returned, "store_id", "left")
    )
    return (
        _with_rate(joined)
        .orderBy(F.desc("return_rate_pct"), "store_name")
        .select("store_name", "units_sold", "units_returned", "return_rate_pct")
    )
