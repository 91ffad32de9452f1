"""Each rule reports the rows that break it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.small_star import d, tiny_star
from tillwise import model
from tillwise.operators import validation as v
from tillwise.model import RetailTables


@pytest.fixture(scope="module")
def star(spark):
    return tiny_star(spark)


def found(report):
    rows = [r for r in report.collect() if r.rule != "row_count"]
    return {(r.table, r.rule): r.violations for r in rows if r.violations}


def test_a_clean_star_has_no_violations(star):
    assert found(v.validate_all(star, raise_on_failure=True)) == {}


BREAKS = {
    "null": ("customers", {"city": "null"}, ("customers", "not_null:city"), 3),
    "negative quantity": ("sales", {"quantity": "-1L"}, ("sales", "quantity_positive"), 6),
    "discount": ("sales", {"discount_pct": "cast(1.5 as decimal(8,6))"}, ("sales", "discount_0_to_1"), 6),
    "price": ("products", {"unit_price": "cast(-1 as decimal(12,2))"}, ("products", "prices_not_negative"), 4),
    "closing": ("inventory", {"closing_stock": "-1L"}, ("inventory", "closing_stock_not_negative"), 4),
    "opening": ("inventory", {"opening_stock": "-1L"}, ("inventory", "stock_fields_not_negative"), 4),
    "balance": ("inventory", {"closing_stock": "closing_stock + 1"}, ("inventory", "balance"), 4),
    "orphan store": ("sales", {"store_id": "'S9'"}, ("sales", "foreign_key:store_id->stores"), 6),
    "null customer": ("sales", {"customer_id": "cast(null as string)"}, ("sales", "foreign_key:customer_id->customers"), 6),
    "orphan return": ("returns", {"order_id": "'O9'"}, ("returns", "foreign_key:order_id+product_id->sales"), 2),
    "early return": ("returns", {"return_date": "date '2020-01-01'"}, ("returns", "not_before_order"), 2),
    "large return": ("returns", {"quantity_returned": "100L"}, ("returns", "within_quantity_sold"), 2),
    "revenue": ("sales", {"net_revenue": "cast(net_revenue + 1 as decimal(14,2))"}, ("sales", "net_revenue_recomputes"), 6),
    "same key": ("stores", {"store_id": "'S1'"}, ("stores", "primary_key"), 1),
}


@pytest.mark.parametrize("case", BREAKS)
def test_each_rule(star, case):
    table, change, rule, rows = BREAKS[case]
    broken = star.replace(
        **{table: star.table(table).withColumns({c: F.expr(e) for c, e in change.items()})}
    )
    assert found(v.validate_all(broken))[rule] == rows
    with pytest.raises(v.ValidationError, match=rule[1].split(":")[0]):
        v.validate_all(broken, raise_on_failure=True)


def test_small_differences_are_tolerated(star):
    off = star.replace(sales=star.sales.withColumn("net_revenue", F.expr("cast(net_revenue + 0.01 as decimal(14,2))")))
    assert ("sales", "net_revenue_recomputes") not in found(v.validate_all(off))


def test_required_columns(spark, star):
    lacking = star.replace(sales=star.sales.drop("profit", "cost"))
    assert found(v.check_required_columns(spark, lacking)) == {("sales", "required_columns"): 2}


def test_missing_columns_are_reported_and_the_rest_goes_on(star):
    lacking = star.replace(sales=star.sales.drop("profit"), stores=star.stores.drop("store_id"))
    got = {(r["table"], r.rule): r.violations for r in v.validate_all(lacking).collect()}
    assert got["sales", "required_columns"] == 1 and got["stores", "required_columns"] == 1
    every = v.validate_all(star)
    rules = {(r["table"], r.rule) for r in every.select("table", "rule").collect()}
    silent = {k for k in rules if k not in {(r["table"], r.rule) for r in v.validate_all(lacking).collect()}}
    assert ("sales", "profit_recomputes") in silent and ("stores", "primary_key") in silent
    assert ("sales", "net_revenue_recomputes") not in silent
    assert got["returns", "row_count"] == 2
    with pytest.raises(v.ValidationError, match="sales: required_columns"):
        v.validate_all(lacking, raise_on_failure=True)


def test_text_dates_are_parsed(star):
    text = star.replace(sales=star.sales.withColumn("order_date", F.expr("if(order_id = 'O1', '2023-13-01', '2023-01-01')")))
    assert found(v.check_dates(text)) == {("sales", "date_parses:order_date"): 2}


def test_declared_constraints_accept_null_in_checks(star):
    nulls = star.replace(stores=star.stores.withColumn("store_type", F.lit(None).cast("string")))
    assert found(v.check_declared_constraints(nulls)) == {("stores", "not_null:store_type"): 2}
    other = star.replace(stores=star.stores.withColumn("store_type", F.lit("Kiosk")))
    assert found(v.check_declared_constraints(other)) == {("stores", "check:store_type"): 2}


def test_foreign_key_report_lists_values(star):
    lost = star.replace(products=star.products.filter("product_id <> 'P1'"))
    rows = v.foreign_key_report(lost).collect()
    assert {(r.table, r.parent, r.value, r.row_count) for r in rows} == {
        ("sales", "products", "P1", 2),
        ("inventory", "products", "P1", 2),
    }
    cut = v.foreign_key_report(star.replace(products=star.products.limit(0)), limit=1).collect()
    assert {(r.table, r.orphan_values, r.orphan_rows) for r in cut} == {("sales", 3, 6), ("inventory", 2, 4)}


def test_reconciliation(star):
    fewer = star.replace(sales=star.sales.limit(2))
    rows = {r["table"]: r.matches for r in v.reconcile_row_counts(star, fewer).collect()}
    assert [n for n, same in rows.items() if not same] == ["sales"]
    totals = v.reconcile_totals(star).collect()
    assert len({(r.revenue, r.profit, r.units_sold) for r in totals}) == 1


def test_star_rejects_unknown_tables(star):
    with pytest.raises(ValueError, match="orders"):
        RetailTables(orders=star.sales)
    with pytest.raises(KeyError, match="returns"):
        RetailTables(sales=star.sales).returns
    assert star.names() == list(model.TABLES) and d("2023-01-10") is not None


def test_foreign_keys_read_a_child_once(spark, star):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/keys"
    star.sales.withColumn("store_id", F.expr("if(order_id = 'O1', null, store_id)")).write.mode("overwrite").parquet(path)
    read = star.replace(sales=spark.read.parquet(path), products=star.products.filter("product_id <> 'P1'"))
    report = v.check_foreign_keys(read)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line for line in plan.split("\n")) == 1
    each = [v.check_foreign_key(read, *fk).first() for fk in v.SINGLE]
    assert sorted(map(tuple, report.collect())) == sorted(map(tuple, each))
    assert sum(r.violations for r in each) > 2 and len(each) == 5
    nulls = [r for r in v.foreign_key_report(read).collect() if r.value == "NULL"]
    assert [(r.table, r.parent) for r in nulls] == [("sales", "stores")]
