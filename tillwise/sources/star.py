"""Maps the benchmark tables (orders, lineitem, part, ...) onto the retail star.

Rules are in FIXTURES.md. Facts are derived once per application and staged, since
every analysis reads them: one deduplication and two joins instead of one per query.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.dates import month_key
from tillwise.functions.relations import dealt
from tillwise.model import MONEY, PRICE, RetailTables
from tillwise.operators.cleaning import dedupe_by_key
from tillwise.sources.staging import stage

REASONS = ("Defective", "Wrong Item", "Customer Changed Mind", "Damaged", "Size Issue", "Unknown")

_LOCK = threading.RLock()
_STARS: dict[tuple[str, str], RetailTables] = {}


def _products(read) -> DataFrame:
    price = F.col("p_retailprice").cast(PRICE)
    share = F.lit("0.40").cast("decimal(2,2)") + (F.col("p_size") % 40).cast("decimal(4,0)") * F.lit(
        "0.01"
    ).cast("decimal(2,2)")
    return read("part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.round(price * share, 2).cast(PRICE).alias("unit_cost"),
        price.alias("unit_price"),
        F.concat(F.lit("Supplier "), (F.col("p_size") % 12).cast("string")).alias("supplier"),
    )


def _places(read) -> DataFrame:
    nation, region = read("nation"), read("region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("place"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("province"),
    )


def _customers(read) -> DataFrame:
    days = (F.col("c_custkey") % 1000).cast("int")
    return (
        read("customer")
        .join(_places(read), F.col("c_nationkey") == F.col("place"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            "city",
            "province",
            F.date_add(F.lit("2020-01-01").cast("date"), days).alias("signup_date"),
            F.col("c_mktsegment").alias("customer_segment"),
        )
    )


def _stores(read) -> DataFrame:
    days = (F.col("s_suppkey") % 1000).cast("int")
    return (
        read("supplier")
        .join(_places(read), F.col("s_nationkey") == F.col("place"))
        .select(
            F.col("s_suppkey").alias("store_id"),
            F.col("s_name").alias("store_name"),
            "city",
            "province",
            F.when(F.col("s_suppkey") % 2 == 0, "Urban").otherwise("Suburban").alias("store_type"),
            F.date_add(F.lit("2010-01-01").cast("date"), days).alias("opening_date"),
        )
    )


def _sale_lines(read) -> DataFrame:
    """Sales plus the three line columns that returns are derived from.

    Lines are dealt by order once, which serves both the first line per key and the orders joined.
    """
    lines = dedupe_by_key(
        dealt(read("lineitem"), "l_orderkey"),
        ["l_orderkey", "l_partkey"],
        order=[
            "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate",
            "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        ],
    )
    return (
        lines.join(
            read("orders").select("o_orderkey", "o_custkey", "o_orderdate"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )
        .join(
            _products(read).select("product_id", "unit_price", "unit_cost"),
            F.col("l_partkey") == F.col("product_id"),
        )
        .select(
            F.col("l_orderkey").alias("order_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            F.col("o_custkey").alias("customer_id"),
            F.col("l_suppkey").alias("store_id"),
            "product_id",
            F.col("l_quantity").cast("long").alias("quantity"),
            "unit_price",
            F.col("l_discount").cast("decimal(4,2)").alias("discount_pct"),
            "unit_cost",
            F.col("l_shipdate").cast("date").alias("ship_date"),
            F.col("l_returnflag").alias("return_flag"),
            F.col("l_linenumber").alias("line_number"),
        )
        .withColumn("month", month_key("order_date"))
    )


def _with_money(lines: DataFrame) -> DataFrame:
    """The lines with their money columns; ``month`` stays last."""
    quantity = F.col("quantity").cast("decimal(6,0)")
    keep = F.lit(1).cast("decimal(1,0)") - F.col("discount_pct")
    money = ("gross_revenue", "net_revenue", "cost", "profit")
    return (
        lines.withColumn("gross_revenue", (quantity * F.col("unit_price")).cast(MONEY))
        .withColumn("net_revenue", F.round(F.col("gross_revenue") * keep, 2).cast(MONEY))
        .withColumn("cost", (quantity * F.col("unit_cost")).cast(MONEY))
        .withColumn("profit", (F.col("net_revenue") - F.col("cost")).cast(MONEY))
        .select(*[c for c in lines.columns if c != "month"], *money, "month")
    )


def _sales(lines: DataFrame) -> DataFrame:
    return lines.drop("ship_date", "return_flag", "line_number")


def _returns(lines: DataFrame) -> DataFrame:
    reason = F.element_at(
        F.array(*[F.lit(r) for r in REASONS]), (F.col("line_number") % 6 + 1).cast("int")
    )
    return lines.filter(
        (F.col("return_flag") == "R") & (F.col("ship_date") >= F.col("order_date"))
    ).select(
        F.concat_ws("-", F.lit("RET"), "order_id", "product_id").alias("return_id"),
        "order_id",
        "product_id",
        F.col("ship_date").alias("return_date"),
        (1 + (F.col("order_id") + F.col("product_id")) % F.col("quantity")).alias("quantity_returned"),
        reason.alias("return_reason"),
    )


def _units_sold(sales: DataFrame) -> DataFrame:
    """Units by month end, store and product.

    That is close to a row per line, so the lines are dealt first: summing them up in the tasks that
    read them would save nothing and hold a row per line in memory. They are dealt by ranges, so a
    task holds few months and the sums are written by month where they are.
    """
    key = ["date", "store_id", "product_id"]
    lines = sales.select(F.last_day("order_date").alias("date"), "store_id", "product_id", "quantity")
    partitions = int(sales.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        lines.repartitionByRange(partitions, *key)
        .groupBy(*key)
        .agg(F.sum("quantity").alias("units_sold"))
        .withColumn("month", month_key("date"))
    )


def _inventory(sold: DataFrame) -> DataFrame:
    store, product = F.col("store_id"), F.col("product_id")
    target = F.when((store + product + F.month("date")) % 5 == 0, F.lit(0)).otherwise(
        1 + (store + product * 2) % 20
    )
    return (
        sold.withColumn("opening_stock", (store * 7 + product * 13) % 18)
        .withColumn(
            "units_received",
            F.greatest(F.lit(0), F.col("units_sold") + target - F.col("opening_stock")).cast("long"),
        )
        .select(
            "date",
            "store_id",
            "product_id",
            "opening_stock",
            "units_received",
            "units_sold",
            (F.col("opening_stock") + F.col("units_received") - F.col("units_sold")).alias(
                "closing_stock"
            ),
            (4 + (store * 3 + product * 5) % 11).alias("reorder_level"),
            "month",
        )
    )


def benchmark_star(spark: SparkSession, sf_dir: str) -> RetailTables:
    """The retail star over ``<sf_dir>/*.parquet``; each table is staged on first use.

    The star is kept for the application: files rewritten under one name need a new session.
    """
    key = (spark.sparkContext.applicationId, str(sf_dir))
    with _LOCK:
        if key in _STARS:
            return _STARS[key]

        def read(name: str) -> DataFrame:
            return spark.read.parquet(f"{sf_dir}/{name}.parquet")

        memo: dict[str, DataFrame] = {}

        def once(name: str, build, partition_by=(), then=lambda df: df, rebalance=True):
            lock = threading.RLock()  # per table: building one never holds up another

            def get() -> DataFrame:
                with lock:
                    if name not in memo:
                        memo[name] = stage(build(), name, partition_by, then, rebalance)
                    return memo[name]

            return get

        lines = once("sale_lines", lambda: _sale_lines(read), ["month"], _with_money)
        _STARS[key] = RetailTables(
            unknown_customer=0,
            customers=once("customers", lambda: _customers(read)),
            products=once("products", lambda: _products(read)),
            stores=once("stores", lambda: _stores(read)),
            sales=lambda: _sales(lines()),
            inventory=once("inventory", lambda: _units_sold(_sales(lines())), ["month"], _inventory, rebalance=False),
            returns=once("returns", lambda: _returns(lines())),
        )
        return _STARS[key]
