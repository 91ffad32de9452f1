"""Every operator bound to the benchmark tables, by query name."""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcheck.defects import CATEGORIES, RAW, SUSPECT, messy_frame
from tillwise import model
from tillwise.catalog import ANALYSES
from tillwise.functions.numeric import dbl, lng
from tillwise.functions.relations import rows_for, union_all
from tillwise.functions.text import normalize_province, normalize_text
from tillwise.model import RetailTables
from tillwise.operators import cleaning, demand, sales, sampling, validation
from tillwise.operators.frames import FRAMES
from tillwise.plans import calendar, measures, report, slicing
from tillwise.plans.suite import run_suite
from tillwise.sources import files, stored
from tillwise.sources.staging import new_path, stage
from tillwise.sources.star import benchmark_star

Query = Callable[[SparkSession, str], DataFrame]

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")

_LOCK = threading.Lock()
_LOCKS: dict[tuple[str, str], threading.Lock] = {}
_CLEANED: dict[tuple[str, str], dict[str, cleaning.Cleaned]] = {}
_STORED: dict[tuple[str, str], tuple[str, DataFrame]] = {}


def raw_table(t: RetailTables, name: str) -> DataFrame:
    return messy_frame(t, RAW, name)


def suspect_star(t: RetailTables) -> RetailTables:
    lazy = {n: (lambda n=n: messy_frame(t, SUSPECT, n)) for n in model.TABLES}
    return RetailTables(unknown_customer=0, **lazy)


def all_cleaned(spark: SparkSession, sf_dir: str) -> dict[str, cleaning.Cleaned]:
    """The messy tables cleaned, once per application and folder."""
    t = benchmark_star(spark, sf_dir)
    key = (spark.sparkContext.applicationId, str(sf_dir))
    with _LOCK:
        lock = _LOCKS.setdefault(key, threading.Lock())
    with lock:
        if key not in _CLEANED:
            raw = {n: raw_table(t, n) for n in model.TABLES}
            _CLEANED[key] = cleaning.clean_all(raw, categories=CATEGORIES, keep=stage)
        return _CLEANED[key]


def cleaned(spark: SparkSession, sf_dir: str, name: str) -> cleaning.Cleaned:
    return all_cleaned(spark, sf_dir)[name]


def _plain_money(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so both engines hand over the same type."""
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    return df.select(*[dbl(c).alias(c) if kinds[c] == "decimal" else F.col(c) for c in df.columns])


def _on_star(op, **params) -> Query:
    return lambda spark, sf_dir: op(benchmark_star(spark, sf_dir), **params)


def _counts(t: RetailTables) -> DataFrame:
    return ANALYSES["table_row_counts"](t)


# ------------------------------------------------------------------ cleaning


def _clean(name: str) -> Query:
    return lambda spark, sf_dir: _plain_money(cleaned(spark, sf_dir, name).rows)


def _typed_sales(t: RetailTables) -> DataFrame:
    """First messy sales line per key, normalised and typed."""
    key = ["order_id", "product_id"]
    first = cleaning.first_by_key(raw_table(t, "sales"), key, stage)
    ids = ("order_id", "customer_id", "store_id", "product_id")
    typed = first.withColumns({c: normalize_text(c, upper=True) for c in ids})
    return cleaning.coerce_numeric(
        cleaning.coerce_date(typed, "order_date"),
        {"quantity": "double", "unit_price": "decimal(20,8)", "discount_pct": "decimal(20,10)"},
    )


def _impute(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed_sales(benchmark_star(spark, sf_dir))
    products = cleaned(spark, sf_dir, "products").rows
    filled = cleaning.impute_from_dim(typed, products, "product_id", "unit_price", stage)
    return filled.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("row_count"), dbl(F.sum("unit_price")).alias("price_sum")
    )


def _map_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    typed = _typed_sales(benchmark_star(spark, sf_dir))
    customers = cleaned(spark, sf_dir, "customers").rows
    mapped = cleaning.map_unknown_member(
        typed, customers, "customer_id", model.UNKNOWN_CUSTOMER, keep=stage
    )
    return mapped.groupBy("customer_id").agg(F.count(F.lit(1)).alias("row_count"))


def _append_unknown(t: RetailTables) -> DataFrame:
    members = cleaning.append_unknown_member(raw_table(t, "customers"))
    return members.groupBy("customer_name").agg(F.count(F.lit(1)).alias("row_count"))


def _derive(t: RetailTables) -> DataFrame:
    lines = t.sales.drop("gross_revenue", "net_revenue", "cost", "profit")
    return cleaning.derive_measures(lines).select(
        "order_id",
        "product_id",
        *[dbl(c).alias(c) for c in ("gross_revenue", "net_revenue", "cost", "profit")],
    )


def _repair(t: RetailTables) -> DataFrame:
    first = cleaning.dedupe_by_key(raw_table(t, "inventory"), model.PRIMARY_KEYS["inventory"])
    typed = cleaning.coerce_numeric(first, {c: "double" for c in model.STOCK_COLUMNS})
    repaired = cleaning.repair_balance(typed, "fixed")
    return repaired.groupBy(normalize_text("store_id", upper=True).alias("store_id")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if("fixed").alias("repaired"),
        lng(F.sum("closing_stock")).alias("closing_stock"),
    )


def _filter_valid(t: RetailTables) -> DataFrame:
    rules = [F.col("quantity") > 0, F.col("discount_pct").between(0, 1)]
    kept = cleaning.filter_valid(_typed_sales(t), rules)
    return kept.groupBy("product_id").agg(F.count(F.lit(1)).alias("row_count"))


def _match_returns(t: RetailTables) -> DataFrame:
    matched = cleaning.match_returns(suspect_star(t).returns, t.sales)
    return matched.select("return_id", "order_id", "product_id")


def _distinct_rows(t: RetailTables) -> DataFrame:
    distinct = cleaning.drop_exact_duplicates(raw_table(t, "sales"))
    return distinct.groupBy("product_id").agg(F.count(F.lit(1)).alias("row_count"))


def _counted(df: DataFrame, *columns) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("row_count"))


def _coerce_date(t: RetailTables) -> DataFrame:
    return _counted(cleaning.coerce_date(raw_table(t, "sales"), "order_date"), "order_date")


def _coerce_numeric(t: RetailTables) -> DataFrame:
    raw = raw_table(t, "sales").withColumn("raw_quantity", F.col("quantity"))
    return _counted(cleaning.coerce_numeric(raw, {"quantity": "double"}), "raw_quantity", "quantity")


def _fill_default(t: RetailTables) -> DataFrame:
    supplier = F.lit(model.DEFAULTS["supplier"])
    return _counted(cleaning.fill_default(raw_table(t, "products"), {"supplier": supplier}), "supplier")


def _domain_default(t: RetailTables) -> DataFrame:
    kept = cleaning.domain_default(
        normalize_text("customer_segment", title=True), model.SEGMENTS, model.DEFAULTS["segment"]
    )
    return _counted(
        raw_table(t, "customers"),
        F.col("customer_segment").alias("raw_segment"),
        kept.alias("customer_segment"),
    )


def _normalize_text(t: RetailTables) -> DataFrame:
    return raw_table(t, "customers").select(
        F.col("customer_id").alias("raw_id"),
        normalize_text("customer_id", upper=True).alias("customer_id"),
        normalize_text("customer_name", title=True).alias("customer_name"),
        normalize_text("city", title=True).alias("city"),
    )


def _normalize_province(t: RetailTables) -> DataFrame:
    return _counted(
        raw_table(t, "customers"),
        F.col("province").alias("raw_province"),
        normalize_province("province").alias("province"),
    )


def _dedupe(t: RetailTables) -> DataFrame:
    first = cleaning.dedupe_by_key(raw_table(t, "sales"), ["order_id", "product_id"])
    return first.select("order_id", "product_id", "quantity")


def _clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(cleaning.cleaned_tables(all_cleaned(spark, sf_dir)))


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.cleaning_summary(all_cleaned(spark, sf_dir))


def _missing(t: RetailTables) -> DataFrame:
    """Missing values per column of every raw table."""
    parts = [
        cleaning.count_missing(raw_table(t, n)).select(F.lit(n).alias("table_name"), "column", "missing")
        for n in model.TABLES
    ]
    return union_all(parts)


def _derive_half_even(t: RetailTables) -> DataFrame:
    lines = t.sales.drop("gross_revenue", "net_revenue", "cost", "profit")
    return cleaning.derive_measures(lines, rounding="half_even").select(
        "order_id", "product_id", dbl("net_revenue").alias("net_revenue"), dbl("profit").alias("profit")
    )


def cleaning_queries() -> dict[str, Query]:
    out: dict[str, Query] = {f"clean_{name}": _clean(name) for name in model.TABLES}
    out["clean_all"] = _clean_all
    out["cleaning_summary"] = _summary
    out["impute_from_dim"] = _impute
    out["map_unknown_member"] = _map_unknown
    on_star = {
        "count_missing": _missing,
        "derive_measures_half_even": _derive_half_even,
        "drop_exact_duplicates": _distinct_rows,
        "dedupe_by_key": _dedupe,
        "normalize_text": _normalize_text,
        "normalize_province": _normalize_province,
        "coerce_date": _coerce_date,
        "coerce_numeric": _coerce_numeric,
        "fill_default": _fill_default,
        "domain_default": _domain_default,
        "append_unknown_member": _append_unknown,
        "derive_measures": _derive,
        "repair_balance": _repair,
        "filter_valid": _filter_valid,
        "match_returns": _match_returns,
    }
    out.update({name: _on_star(op) for name, op in on_star.items()})
    return out


# ---------------------------------------------------------------- validation


def _required_columns(t: RetailTables) -> DataFrame:
    """Missing columns beside the rows of each table, with two sales columns taken away."""
    lacking = t.replace(sales=t.sales.drop("profit", "cost"))
    report = validation.check_required_columns(t.sales.sparkSession, lacking)
    return report.join(_counts(lacking).withColumnRenamed("table_name", "table"), "table")


def validation_queries() -> dict[str, Query]:
    v = validation

    def primary_keys(s: RetailTables) -> DataFrame:
        return union_all([v.check_primary_key(s.table(n), n) for n in model.TABLES])

    on_suspect = {
        "check_not_null": lambda s: union_all([v.check_not_null(s.table(n), n) for n in model.TABLES]),
        "check_primary_key": primary_keys,
        "check_ranges": v.check_ranges,
        "check_foreign_key": v.check_foreign_keys,
        "check_composite_foreign_key": v.check_composite_foreign_key,
        "check_derived_measures": v.check_derived_measures,
        "check_inventory_balance": v.check_inventory_balance,
        "check_returns_vs_sales": v.check_returns_vs_sales,
        "check_dates": v.check_dates,
        "check_declared_constraints": v.check_declared_constraints,
        "foreign_key_report": v.foreign_key_report,
        "validate_all": v.validate_all,
    }
    out: dict[str, Query] = {
        name: _on_star(lambda t, op=op: op(suspect_star(t))) for name, op in on_suspect.items()
    }
    out["check_required_columns"] = _on_star(_required_columns)
    out["validate_all_clean"] = _on_star(v.validate_all)
    out["reconcile_row_counts"] = _on_star(lambda t: v.reconcile_row_counts(t, suspect_star(t)))
    out["reconcile_totals"] = _on_star(v.reconcile_totals)
    return out


# ------------------------------------------------- measures, report and demand

SLICE = {"date_from": "1997-03-15", "date_to": "1999-10-20", "province": "EUROPE"}


def _slice(t: RetailTables) -> DataFrame:
    picked = slicing.slice_star(t, **SLICE, category="PROMO", customer_segment="BUILDING")
    return slicing.slice_totals(picked)


def _slice_by_category(t: RetailTables) -> DataFrame:
    by = measures.measure_by(t, ["total_revenue", "orders"], ["category"], where=SLICE)
    return by.withColumnRenamed("total_revenue", "revenue")


def _returned_by_store(t: RetailTables) -> DataFrame:
    enriched = t.replace(returns=report.enrich_returns(t))
    return measures.measure_by(enriched, ["returned_units"], ["province", "customer_segment"])


def _densify(t: RetailTables) -> DataFrame:
    described = t.sales.join(t.products.select("product_id", "category"), "product_id")
    keys = ("store_id", "category")
    return demand.densify_grid(demand.monthly_demand(t.replace(sales=described), keys), keys)


def measure_queries() -> dict[str, Query]:
    hidden = {"cost_of_goods_sold", "discount_sum", "sales_lines"}
    out = {
        f"measure_{name}": _on_star(measures.measure_by, names=[name], dims=["year", "category"])
        for name in measures.MEASURES
        if name not in hidden
    }
    for name in measures.TIME_MEASURES:
        out[f"measure_{name}"] = _on_star(measures.time_measures, by=["category"], names=[name])
    out["measure_by_company"] = _on_star(
        measures.measure_by,
        names=["total_revenue", "orders", "return_rate", "stockout_rate", "repeat_customers"],
    )
    out["measure_by_segment_province"] = _on_star(
        measures.measure_by,
        names=["total_revenue", "customers", "returned_units"],
        dims=["customer_segment", "province"],
    )
    out["measure_by_month_segment"] = _on_star(
        measures.measure_by,
        names=["total_revenue", "returned_units"],
        dims=["month", "customer_segment"],
    )
    out["measure_by_segment_unrelated"] = _on_star(
        measures.measure_by, names=["returned_units"], dims=["customer_segment"]
    )
    out["measure_by_customer_product"] = _on_star(
        measures.measure_by,
        names=["total_revenue", "returned_units", "return_rate"],
        dims=["customer_id", "product_id"],
    )
    out["measure_by_customer"] = _on_star(
        measures.measure_by, names=["total_profit", "returned_units"], dims=["customer_id", "province"]
    )
    out["measure_by_province_category"] = _on_star(
        measures.measure_by,
        names=["total_profit", "closing_inventory_value", "avg_monthly_inventory_value"],
        dims=["province", "category"],
    )
    out["measure_by_province_stock_and_sales"] = _on_star(
        measures.measure_by, names=["profit_margin", "stockout_rate"], dims=["province"]
    )
    return out


def report_queries() -> dict[str, Query]:
    on_star = {
        "date_dimension": calendar.date_dimension,
        "slice": _slice,
        "slice_by_category": _slice_by_category,
        "enrich_returns": report.enrich_returns,
        "enrichment_check": report.enrichment_check,
        "returned_units_by_store": _returned_by_store,
        "monthly_revenue_profit": report.monthly_revenue_profit,
        "revenue_by_category": report.revenue_by_category,
        "revenue_by_store": report.revenue_by_store,
        "product_ranking": report.product_ranking,
        "margin_by_category": report.margin_by_category,
        "discount_vs_margin": report.discount_vs_margin,
        "closing_value_by_category": report.closing_value_by_category,
        "stockout_matrix": lambda t: report.stockout_matrix(t, PART_TYPES),
        "customers_by_segment": report.customers_by_segment,
        "monthly_demand": demand.monthly_demand,
        "densify_grid": _densify,
        "inventory_rollforward": lambda t: demand.inventory_rollforward(t.inventory),
        "sample_rows": lambda t: sampling.sample_rows(t.products, 100, ["product_id"]).select(
            "product_id", "product_name"
        ),
        "weighted_sample": lambda t: sampling.weighted_sample(
            t.products, 100, "unit_price", ["product_id"], seed=7
        ).select("product_id", "product_name"),
        "sample_tenth": lambda t: sampling.sample_rows(
            t.sales, t.sales.count() // 10, ["order_id", "product_id"], most_sorted=100
        ).select("order_id", "product_id"),
        "weighted_tenth": lambda t: sampling.weighted_sample(
            t.sales, t.sales.count() // 10, "quantity", ["order_id", "product_id"], seed=7, most_sorted=100
        ).select("order_id", "product_id"),
        "run_suite": run_suite,
    }
    return {name: _on_star(op) for name, op in on_star.items()}


# --------------------------------------------------------------- round trips


def _read_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = benchmark_star(spark, sf_dir)
    path = new_path(spark, "raw_csv")
    files.write_raw({n: raw_table(t, n) for n in model.TABLES}, path)
    tables = files.read_raw(spark, path)
    return union_all(
        [
            df.agg(
                F.count(F.lit(1)).alias("row_count"),
                F.countDistinct(model.PRIMARY_KEYS[n][0]).alias("first_key_values"),
                lng(F.sum(_digest(df.columns))).alias("content"),
            ).select(F.lit(n).alias("table_name"), "row_count", "first_key_values", "content")
            for n, df in tables.items()
        ]
    )


def _damaged_lines(df: DataFrame) -> DataFrame:
    """The rows as quoted CSV lines under their header: one in forty too long, one too short."""
    cells = [F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in map(F.col, df.columns)]
    cells = [F.coalesce(c, F.lit("")) for c in cells]
    kind = _digest(df.columns) % 40
    line = (
        F.when(kind == 0, F.concat_ws(",", *cells, F.lit('EXTRA,"X, Y"')))
        .when(kind == 1, F.concat_ws(",", *cells[:-1]))
        .otherwise(F.concat_ws(",", *cells))
    )
    return df.select(line.alias(",".join(df.columns)))


def _read_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of damaged files, per table, and how many lines were kept apart."""
    t = benchmark_star(spark, sf_dir)
    path = new_path(spark, "damaged_csv")
    for n in model.TABLES:
        as_is = _damaged_lines(raw_table(t, n)).write.options(header=True, sep="\x01", quote="")
        as_is.csv(f"{path}/{n}.csv")
    good, bad = files.split_raw(spark, path, keep=stage)
    apart = bad.groupBy(F.col("table").alias("table_name")).agg(
        F.count_if(F.col("cells") > F.col("expected")).alias("n_long"),
        F.count_if(F.col("cells") < F.col("expected")).alias("n_short"),
        lng(F.sum("cells")).alias("cells_apart"),
    )
    kept = union_all(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), lng(F.sum(_digest(df.columns))).alias("content")).select(
                F.lit(n).alias("table_name"), "row_count", "content"
            )
            for n, df in good.items()
        ]
    )
    return kept.join(apart, "table_name", "left").na.fill(0, ["n_long", "n_short", "cells_apart"])


def _digest(columns: Sequence[str]) -> Column:
    """A number from all cells of a row; equal rows in both engines get the same one."""
    cells = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("~")) for c in columns])
    return F.conv(F.substring(F.md5(cells), 1, 8), 16, 10).cast("long")


def _contents(t: RetailTables) -> DataFrame:
    """Per table its rows and a digest of all its cells; money counts as cents."""
    parts = []
    for n in model.TABLES:
        df = t.table(n)
        money = {f.name for f in df.schema if f.dataType.typeName() == "decimal"}
        text = df.select(*[((F.col(c) * 100).cast("long") if c in money else F.col(c)).cast("string").alias(c) for c in sorted(df.columns)])
        parts.append(
            text.agg(F.count(F.lit(1)).alias("row_count"), lng(F.sum(_digest(text.columns))).alias("content")).select(
                F.lit(n).alias("table_name"), "row_count", "content"
            )
        )
    return union_all(parts)


def _round_trip(spark: SparkSession, sf_dir: str) -> RetailTables:
    t = benchmark_star(spark, sf_dir)
    path = new_path(spark, "cleaned")
    files.write_cleaned(t, path, by_month=("sales", "inventory"))  # the star stages both by month
    return files.read_cleaned(spark, path, files.cleaned_schemas(t), unknown_customer=0)


def _read_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir).sales.groupBy("month").agg(
        F.count(F.lit(1)).alias("row_count"), dbl(F.sum("net_revenue")).alias("revenue")
    )


def _write_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "cleaning_summary")
    files.write_cleaning_summary(_summary(spark, sf_dir), path)
    return files.read_cleaning_summary(spark, path)


def _write_cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sales lines as written and read back."""
    return _plain_money(_round_trip(spark, sf_dir).sales.drop("month"))


def _load(t: RetailTables) -> RetailTables:
    frames = {n: t.table(n) for n in model.TABLES}
    schemas = files.cleaned_schemas(t)
    return files.load_tables(frames, schemas, prefix="retail_", unknown_customer=t.unknown_customer, check=True)


def _load_values(t: RetailTables) -> DataFrame:
    _load(t)
    return _plain_money(t.sales.sparkSession.table("retail_products"))




def _database(spark: SparkSession, sf_dir: str) -> str:
    name = f"{spark.sparkContext.applicationId}|{sf_dir}"
    return f"retail_{hashlib.md5(name.encode()).hexdigest()[:12]}"


def _stored(spark: SparkSession, sf_dir: str, other: bool = False) -> tuple[RetailTables, DataFrame]:
    """The star stored in three loads, and what each load added; ``other`` opens it in a session of its own.

    The first load has the sales and stock before 1997 and their returns, the second everything,
    the third the same again.
    """
    key = (spark.sparkContext.applicationId, str(sf_dir))
    with _LOCK:
        lock = _LOCKS.setdefault((*key, "stored"), threading.Lock())
    t = benchmark_star(spark, sf_dir)
    schemas = files.cleaned_schemas(t)
    database = _database(spark, sf_dir)
    with lock:
        if key not in _STORED:
            root = new_path(spark, "stored")
            early = slicing.slice_star(t, date_to="1996-12-31")
            early = early.replace(returns=rows_for(t.returns, early.sales, ["order_id", "product_id"]))
            parts = []
            for n, star in enumerate((early, t, t), 1):
                added = stored.load(
                    spark, {n: star.table(n) for n in model.TABLES}, root, database, schemas, 0,
                    validation.declared_rules(segments=SEGMENTS), buckets=8,
                )
                parts.append(added.select(F.lit(n).alias("load_no"), F.col("table").alias("table_name"), "offered", "added"))
            _STORED[key] = root, union_all(parts)
    root, added = _STORED[key]
    return stored.open_tables(spark.newSession() if other else spark, root, database, schemas, 0), added


def _on_stored(op, other: bool = False, **params) -> Query:
    return lambda spark, sf_dir: op(_stored(spark, sf_dir, other)[0], **params)


def _match_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    suspects = suspect_star(benchmark_star(spark, sf_dir)).returns
    matched = cleaning.match_returns(suspects, _stored(spark, sf_dir)[0].sales, keep=stage)
    return matched.select("return_id", "order_id", "product_id")


def _stored_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain SQL over the stored tables, in a session that did not load them."""
    session = _stored(spark, sf_dir, other=True)[0].sales.sparkSession
    return session.sql(
        """SELECT s.month, p.province, count(*) AS row_count, CAST(sum(s.net_revenue) AS DOUBLE) AS revenue
           FROM {db}.sales s JOIN {db}.stores p ON s.store_id = p.store_id GROUP BY ALL""".format(db=_database(spark, sf_dir))
    )


# Result of every frame export: the column whose largest value is compared.
EXPORTED = {
    "frame_monthly": "revenue",
    "frame_stores": "revenue",
    "frame_products": "revenue",
    "frame_customers": "total_spend",
    "frame_inventory": "total_units_sold",
    "frame_returns_category": "units_returned",
    "frame_returns_reason": "units_returned",
    "executive_kpis": "value",
}


def _exported(spark: SparkSession, sf_dir: str) -> str:
    t = benchmark_star(spark, sf_dir)
    path = new_path(spark, "export")
    files.export_results({n: FRAMES[n](t) for n in EXPORTED}, path)
    return path


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _exported(spark, sf_dir)
    return union_all(
        [
            spark.read.parquet(f"{path}/{n}")
            .agg(F.count(F.lit(1)).alias("row_count"), F.max(c).cast("double").alias("largest"))
            .select(F.lit(n).alias("name"), "row_count", "largest")
            for n, c in EXPORTED.items()
        ]
    )


def _verify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.verify_export(spark, _exported(spark, sf_dir), list(EXPORTED))


def file_queries() -> dict[str, Query]:
    return {
        "read_raw": _read_raw,
        "read_raw_malformed": _read_malformed,
        "write_cleaned": _write_cleaned,
        "write_cleaned_content": lambda spark, sf_dir: _contents(_round_trip(spark, sf_dir)),
        "read_cleaned": _read_cleaned,
        "write_cleaning_summary": _write_summary,
        "stored_tables": _on_stored(_contents, other=True),
        "stored_tables_by_name": _stored_by_name,
        "stored_loads": lambda spark, sf_dir: _stored(spark, sf_dir)[1],
        "store_return_rate_stored": _on_stored(ANALYSES["store_return_rate"]),
        "enrich_returns_stored": _on_stored(report.enrich_returns, keep=stage),
        "match_returns_stored": _match_stored,
        "load_tables": _on_star(_load_values),
        "load_tables_content": _on_star(lambda t: _contents(_load(t))),
        "load_tables_counts": _on_star(lambda t: _counts(_load(t))),
        "load_tables_customers": _on_star(lambda t: ANALYSES["customer_summary"](_load(t))),
        "export_results": _export,
        "verify_export": _verify,
    }


def star_queries() -> dict[str, Query]:
    names = ("products", "customers", "stores", "inventory", "returns")
    return {
        f"star_{n}": _on_star(lambda t, n=n: _plain_money(t.table(n))) for n in names
    }


def all_queries() -> dict[str, Query]:
    out = {name: _on_star(op) for name, op in ANALYSES.items()}
    # The benchmark discounts end at 10%, so the default edges would leave bands empty.
    out["discount_bands"] = _on_star(sales.discount_bands, edges=(0, 0.03, 0.07))
    out["month_over_month_calendar"] = _on_star(sales.month_over_month, calendar=True)
    out["year_over_year_calendar"] = _on_star(sales.year_over_year, calendar=True)
    out.update({name: _on_star(op) for name, op in FRAMES.items()})
    for group in (
        star_queries,
        measure_queries,
        report_queries,
        cleaning_queries,
        validation_queries,
        file_queries,
    ):
        out.update(group())
    return out
