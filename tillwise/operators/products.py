"""Product and category analyses.

Facts are summed to product grain first (map-side combine, one small row per product and
task), then joined to the product table: names never travel with fact rows and a
best-selling product is not a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.numeric import dbl, money_sum, pct, ratio, round2
from tillwise.model import RetailTables
from tillwise.plans.ordered import with_order_stats

MONEY_COLUMNS = ("gross_revenue", "net_revenue", "cost", "profit")
NAMES = ("product_id", "product_name", "category")
TOTALS = ("net_revenue", "profit", "cost", "quantity")


def product_totals(t: RetailTables, **sums: str) -> DataFrame:
    """Exact sums per product: ``product_totals(t, revenue="net_revenue")``.

    A star that shares sums the columns of ``TOTALS`` once for all who ask.
    """

    def summed(named: dict[str, str]) -> DataFrame:
        return t.sales.groupBy("product_id").agg(
            *[(money_sum(c) if c in MONEY_COLUMNS else F.sum(c)).alias(n) for n, c in named.items()]
        )

    if not t.shares or not set(sums.values()) <= set(TOTALS):
        return summed(sums)
    whole = t.shared("product_totals", lambda: summed({c: c for c in TOTALS if c in t.sales.columns}))
    return whole.select("product_id", *[F.col(c).alias(n) for n, c in sums.items()])


def _named(t: RetailTables, totals: DataFrame, *columns: str) -> DataFrame:
    return totals.join(t.products.select(*(columns or NAMES)), "product_id")


def category_units(t: RetailTables, fact: str, column: str, out: str) -> DataFrame:
    """Units of a fact per category, through product grain."""
    if fact == "sales":
        per_product = product_totals(t, **{out: column})
    else:
        per_product = t.table(fact).groupBy("product_id").agg(F.sum(column).alias(out))
    return (
        per_product.join(t.products.select("product_id", "category"), "product_id")
        .groupBy("category")
        .agg(F.sum(out).alias(out))
    )


def top_products_by_revenue(t: RetailTables, n: int = 10) -> DataFrame:
    totals = product_totals(t, revenue="net_revenue", units_sold="quantity")
    return (
        _named(t, totals)
        .orderBy(F.desc("revenue"), "product_id")
        .limit(n)
        .select(*NAMES, dbl("revenue").alias("revenue"), "units_sold")
    )


def top_products_by_profit(t: RetailTables, n: int = 10) -> DataFrame:
    totals = product_totals(t, profit="profit", revenue="net_revenue")
    return (
        _named(t, totals)
        .orderBy(F.desc("profit"), "product_id")
        .limit(n)
        .select(
            *NAMES,
            dbl("profit").alias("profit"),
            pct("profit", "revenue").alias("profit_margin_pct"),
        )
    )


def slow_catalog_products(t: RetailTables, n: int = 20) -> DataFrame:
    """Fewest units, then least revenue; never-sold products included."""
    totals = product_totals(t, units_sold="quantity", revenue="net_revenue", profit="profit")
    return (
        t.products.select(*NAMES)
        .join(totals, "product_id", "left")
        .select(
            *NAMES,
            F.coalesce("units_sold", F.lit(0)).alias("units_sold"),
            round2(F.coalesce("revenue", F.lit(0))).alias("revenue"),
            round2(F.coalesce("profit", F.lit(0))).alias("profit"),
        )
        .orderBy("units_sold", "revenue", "product_id")
        .limit(n)
    )


def high_revenue_low_margin(t: RetailTables) -> DataFrame:
    """At least the mean product's revenue, but below the company margin."""
    totals = product_totals(t, revenue="net_revenue", profit="profit")
    both = F.struct(  # one subquery, whose sums per product are those of the rows filtered
        ratio(F.sum("revenue"), F.count(F.lit(1))).alias("mean_revenue"),
        ratio(F.sum("profit"), F.sum("revenue")).alias("company"),
    )
    level = totals.agg(both.alias("level")).scalar()
    picked = totals.filter(
        (dbl("revenue") >= level["mean_revenue"]) & (ratio("profit", "revenue") < level["company"])
    )
    return (
        _named(t, picked)
        .orderBy(F.desc("revenue"), "product_id")
        .select(
            *NAMES,
            dbl("revenue").alias("revenue"),
            pct("profit", "revenue").alias("profit_margin_pct"),
        )
    )


def category_performance(t: RetailTables) -> DataFrame:
    """Sales and returns per category, aggregated apart so neither inflates the other."""
    totals = product_totals(t, revenue="net_revenue", profit="profit", units_sold="quantity")
    sold = (
        _named(t, totals, "product_id", "category")
        .groupBy("category")
        .agg(*[F.sum(c).alias(c) for c in ("revenue", "profit", "units_sold")])
    )
    returned = category_units(t, "returns", "quantity_returned", "units_returned")
    return (
        sold.join(returned, "category", "left")
        .withColumn("units_returned", F.coalesce("units_returned", F.lit(0)))
        .select(
            "category",
            dbl("revenue").alias("revenue"),
            dbl("profit").alias("profit"),
            pct("profit", "revenue").alias("profit_margin_pct"),
            "units_sold",
            "units_returned",
            pct("units_returned", "units_sold").alias("return_rate_pct"),
        )
        .orderBy(F.desc("revenue"), "category")
    )


def product_contribution(t: RetailTables) -> DataFrame:
    """Rank, share and cumulative share of revenue per product."""
    revenue = _named(t, product_totals(t, revenue="net_revenue"))
    ordered = with_order_stats(
        revenue,
        order=["-revenue"],
        key=["product_id"],
        rank="revenue_rank",
        running={"so_far": "revenue"},
        total={"whole": "revenue"},
    )
    return (
        ordered.orderBy(F.desc("revenue"), "product_id")
        .select(
            *NAMES,
            dbl("revenue").alias("revenue"),
            "revenue_rank",
            pct("revenue", "whole").alias("revenue_share_pct"),
            pct("so_far", "whole").alias("cumulative_revenue_share_pct"),
        )
    )


def top_products_per_category(t: RetailTables, n: int = 3) -> DataFrame:
    """Best sellers of each category; ranks beyond ``n`` are dropped before the shuffle.

    Beyond Spark's limit for that, ranks are counted along sorted slices instead, so a large
    category is never one task.
    """
    named = _named(t, product_totals(t, revenue="net_revenue"))
    limit = int(named.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold"))
    if n <= limit:
        best = Window.partitionBy("category").orderBy(F.desc("revenue"), "product_id")
        placed = named.withColumn("category_position", F.row_number().over(best))
    else:
        placed = with_order_stats(
            named, ["-revenue"], ["product_id"], within=["category"], row_number="category_position"
        )
    return (
        placed
        .filter(F.col("category_position") <= n)
        .select(
            "category",
            F.col("category_position").cast("long").alias("category_position"),
            "product_id",
            "product_name",
            dbl("revenue").alias("revenue"),
        )
        .orderBy("category", "category_position")
    )


def abc_classification(t: RetailTables, a: float = 0.80, b: float = 0.95) -> DataFrame:
    """A, B or C by cumulative revenue share, the product itself included."""
    ordered = with_order_stats(
        product_totals(t, revenue="net_revenue"),
        order=["-revenue"],
        key=["product_id"],
        running={"so_far": "revenue"},
        total={"whole": "revenue"},
    )
    share = ordered.withColumn("share", ratio("so_far", "whole"))
    return (
        _named(t, share)
        .orderBy(F.desc("revenue"), "product_id")
        .select(
            *NAMES,
            dbl("revenue").alias("revenue"),
            round2(F.col("share") * 100).alias("cumulative_revenue_share_pct"),
            F.when(F.col("share") <= a, "A")
            .when(F.col("share") <= b, "B")
            .otherwise("C")
            .alias("abc_class"),
        )
    )
