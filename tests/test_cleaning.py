"""Cleaning the messy star: one expectation per defect, then the cleaned invariants."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.small_star import d, money, raw_tables
from tillwise import model
from tillwise.operators import cleaning, validation
from tillwise.sources.staging import stage


@pytest.fixture(scope="module")
def cleaned(spark):
    return cleaning.clean_all(raw_tables(spark))


def rows(cleaned, table, *columns):
    return sorted(tuple(r) for r in cleaned[table].rows.select(*columns).collect())


def test_customers(cleaned):
    assert rows(cleaned, "customers", *model.CLEAN_SCHEMAS["customers"].names) == [
        ("CUST0001", "Maya O'Brien-Singh", "Toronto", "Ontario", d("2022-09-14"), "Loyal"),
        ("CUST0002", "Unknown Customer CUST0002", "Montreal", "Quebec", d("2023-01-01"), "Regular"),
        ("CUST0003", "Li Wei", "Vancouver", "British Columbia", d("2023-01-01"), "Regular"),
        ("CUST0004", "Ana", "Halifax", "Nova Scotia", d("2023-05-01"), "Regular"),
        ("CUST0008", "Ed", "Toronto", "Ontario", d("2023-05-01"), "New"),
        ("CUST_UNKNOWN", "Unknown Customer", "Unknown", "Ontario", d("2023-01-01"), "New"),
    ]


def test_products(cleaned):
    assert rows(cleaned, "products", "product_id", "product_name", "category", "unit_cost", "supplier") == [
        ("PROD001", "Audio Item", "Electronics", money("10.00"), "Supplier A"),
        ("PROD002", "Milk", "Grocery", money("1.10"), "Unknown Supplier"),
        ("PROD003", "Desk", "Office", money("40.00"), "Supplier B"),
        ("PROD007", "Never Sold", "Home", money("5.00"), "Supplier B"),
    ]


def test_stores(cleaned):
    assert rows(cleaned, "stores", "store_id", "store_name", "province", "store_type", "opening_date") == [
        ("STORE01", "Toronto Centre", "Ontario", "Urban", d("2015-11-12")),
        ("STORE02", "Halifax Mall", "Nova Scotia", "Suburban", d("2018-01-01")),
    ]


def test_sales(cleaned):
    got = rows(cleaned, "sales", "order_id", "product_id", "customer_id", "quantity", "unit_price", "net_revenue", "profit")
    assert got == [
        ("ORD000001", "PROD001", "CUST0001", 2, money("12.50"), money("22.50"), money("2.50")),
        ("ORD000001", "PROD002", "CUST0001", 1, money("1.25"), money("1.13"), money("0.03")),
        ("ORD000002", "PROD002", "CUST_UNKNOWN", 3, money("2.00"), money("6.00"), money("2.70")),
        ("ORD000003", "PROD003", "CUST_UNKNOWN", 1, money("80.00"), money("64.00"), money("24.00")),
        ("ORD000010", "PROD001", "CUST0001", 4, money("12.50"), money("50.00"), money("10.00")),
    ]


def test_half_even_rounding(spark):
    sales = cleaning.clean_all(raw_tables(spark), rounding="half_even")["sales"].rows
    nets = {r.product_id: r.net_revenue for r in sales.filter("order_id = 'ORD000001'").collect()}
    assert nets["PROD002"] == Decimal("1.12")


def test_inventory(cleaned):
    assert rows(cleaned, "inventory", "date", "store_id", "product_id", "closing_stock") == [
        (d("2024-01-31"), "STORE01", "PROD001", 13),
        (d("2024-01-31"), "STORE02", "PROD002", 0),
        (d("2024-02-29"), "STORE01", "PROD001", 10),
        (d("2024-02-29"), "STORE02", "PROD002", 7),
        (d("2024-03-31"), "STORE01", "PROD001", 2),
    ]


def test_returns(cleaned):
    # The first two exceed the sold quantity only together, which is accepted.
    assert rows(cleaned, "returns", "return_id", "quantity_returned", "return_reason") == [
        ("RET000001", 1, "Unknown"),
        ("RET000002", 2, "Defective"),
        ("RET000008", 1, "Wrong Item"),
    ]


def test_summary(cleaned):
    got = {(r.table, r.metric): r.value for r in cleaning.cleaning_summary(cleaned).collect()}
    assert got["customers", "rows_before"] == 10
    assert got["customers", "rows_after"] == 6  # five valid and the unknown member
    assert got["customers", "exact_duplicates_removed"] == 1
    assert got["customers", "primary_key_duplicates_removed"] == 1
    assert got["customers", "invalid_rows_removed"] == 3
    assert got["customers", "missing_values_handled"] == 3
    assert got["sales", "rows_before"] == 14
    assert got["sales", "rows_after"] == 5
    assert got["sales", "exact_duplicates_removed"] == 1
    assert got["sales", "primary_key_duplicates_removed"] == 1
    assert got["sales", "invalid_rows_removed"] == 7
    assert got["sales", "customer_ids_assigned_to_unknown"] == 2
    assert got["inventory", "closing_balances_corrected"] == 3
    assert got["inventory", "invalid_rows_removed"] == 3
    assert got["returns", "invalid_rows_removed"] == 5


def test_keeping_checked_rows_changes_nothing(spark, cleaned):
    lazy = cleaning.clean_all(raw_tables(spark), keep=cleaning.as_is)
    for name in model.TABLES:
        assert sorted(map(tuple, lazy[name].rows.collect()), key=str) == sorted(
            map(tuple, cleaned[name].rows.collect()), key=str
        )
        assert lazy[name].counts.collect() == cleaned[name].counts.collect()


def test_the_report_reads_no_table(spark, cleaned):
    eager = cleaning.clean_all(raw_tables(spark))
    for name in model.TABLES:
        counts = eager[name].counts
        assert counts.collect() == cleaned[name].counts.collect()
        assert "FileScan" not in counts._jdf.queryExecution().executedPlan().toString()
        stored = eager[name].rows._jdf.queryExecution().analyzed().toString()
        assert "__rows" not in stored and "__valid" not in stored


def test_empty_raw_tables(spark):
    empty = {n: df.limit(0) for n, df in raw_tables(spark).items()}
    eager, lazy = cleaning.clean_all(empty), cleaning.clean_all(empty, keep=cleaning.as_is)
    for name in model.TABLES:
        assert eager[name].counts.collect() == lazy[name].counts.collect()
        assert eager[name].rows.count() == (1 if name == "customers" else 0)


def test_cleaned_star_satisfies_every_rule(spark, cleaned):
    # The one balance that cannot be repaired is kept by cleaning and caught here.
    report = validation.validate_all(cleaning.cleaned_tables(cleaned))
    broken = {(r.table, r.rule): r.violations for r in report.filter("violations > 0 AND rule <> 'row_count'").collect()}
    assert broken == {("inventory", "balance"): 1}


def test_amounts_recompute(cleaned):
    for r in cleaned["sales"].rows.collect():
        assert abs(r.gross_revenue - r.quantity * r.unit_price) <= Decimal("0.01")
        assert abs(r.net_revenue - r.gross_revenue * (1 - r.discount_pct)) <= Decimal("0.01")
        assert abs(r.cost - r.quantity * r.unit_cost) <= Decimal("0.01")
        assert abs(r.profit - (r.net_revenue - r.cost)) <= Decimal("0.01")


def test_keys_and_references(spark, cleaned):
    raw = raw_tables(spark)
    assert raw["sales"].count() > raw["sales"].dropDuplicates().count()
    for name, key in model.PRIMARY_KEYS.items():
        df = cleaned[name].rows
        assert df.count() == df.dropDuplicates(key).count()
    customers = {r[0] for r in cleaned["customers"].rows.select("customer_id").collect()}
    used = {r[0] for r in cleaned["sales"].rows.select("customer_id").collect()}
    assert used <= customers and "CUST9999" not in used and "CUST_UNKNOWN" in customers


def test_dedupe_before_or_after_normalising(spark):
    columns = ", ".join(f"{c} string" for c in model.RAW_COLUMNS["stores"])
    twice = spark.createDataFrame(
        [
            ("STORE01", "A", "Toronto", "ON", "Urban", "2020-01-01"),
            (" store01", "B", "Toronto", "ON", "Urban", "2020-01-01"),
        ],
        columns,
    )
    assert cleaning.clean_stores(twice).rows.count() == 2
    assert cleaning.clean_stores(twice, dedupe_after_normalize=True).rows.count() == 1


def test_duplicate_dimension_keys_do_not_multiply_sales(spark):
    raw = raw_tables(spark)
    padded = raw["stores"].filter("store_id = 'STORE01'").withColumn("store_id", F.lit(" store01 "))
    raw["stores"] = raw["stores"].unionByName(padded)
    assert cleaning.clean_all(raw)["sales"].rows.count() == 5


def test_dedupe_keeps_the_first_by_order(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (None, 2, "x"), (None, 1, "y")], "k int, o int, v string")
    kept = cleaning.dedupe_by_key(df, ["k"], ["o"]).collect()
    assert {(r.k, r.v) for r in kept} == {(1, "a"), (None, "y")}


def test_dedupe_drops_rows_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("id % 10 as k", "id as o")
    plan = cleaning.dedupe_by_key(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    limit = plan.rfind("WindowGroupLimit")
    assert plan.count("WindowGroupLimit") == 2 and plan.find("Exchange hashpartitioning") < limit


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="city, province"):
        cleaning.require_columns(spark.range(1), "stores", ["id", "province", "city"])


def test_count_missing(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int")
    assert sorted(map(tuple, cleaning.count_missing(df).collect())) == [("a", 1), ("b", 2)]
    assert cleaning.count_missing(df.filter("a > 5")).count() == 0


def test_unknown_rules_reject(spark):
    df = spark.createDataFrame([(1,), (None,)], "a int")
    assert cleaning.filter_valid(df, [F.col("a") > 0]).collect() == [(1,)]


def test_cleaning_an_empty_table(spark):
    raw = {n: df.limit(0) for n, df in raw_tables(spark).items()}
    out = cleaning.clean_all(raw)
    assert out["sales"].rows.count() == 0
    assert out["sales"].counts.first()["rows_before"] == 0


def test_default_ids_may_grow(spark):
    columns = ", ".join(f"{c} string" for c in model.RAW_COLUMNS["customers"])
    rows = [(f"CUST{i}", "A", "Toronto", "ON", "2023-01-01", "New") for i in range(9990, 10010)]
    raw = spark.createDataFrame(rows + [("CUST12", "B", "Toronto", "ON", "2023-01-01", "New")], columns)
    assert cleaning.clean_customers(raw).rows.count() == 20
    assert cleaning.clean_customers(raw, model.EXACT_ID_PATTERNS).rows.count() == 10


@pytest.mark.parametrize("after", [False, True])
def test_first_rows_shuffle_the_raw_table_once(spark, after):
    raw = spark.createDataFrame(
        [("K1", None), ("K1", None), ("K1", "b"), (" k1", "a"), (None, "c"), (None, "c"), (None, None), ("K2", "d")],
        "k string, v string",
    ).repartition(3)
    first = cleaning._first_rows(raw.select("k", "v"), ["k"], {"k": F.upper(F.trim("k"))}, after)
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "HashAggregate" not in plan
    got = {(r["k"], r["v"], r["__rows"], r["__distinct"], r["__missing_k"], r["__missing_v"]) for r in first.collect()}
    one = {("K1", None, 4, 3, 0, 2)} if after else {("K1", None, 3, 2, 0, 2), ("K1", "a", 1, 1, 0, 0)}
    assert got == one | {(None, None, 3, 2, 3, 1), ("K2", "d", 1, 1, 0, 0)}


@pytest.mark.parametrize("after", [False, True])
def test_raw_tables_are_dealt_into_every_shuffle_partition(spark, partitions, after):
    """Adaptive execution merges partitions by compressed size; the rows of one were too many to sort in memory."""
    partitions(7)
    raw = spark.range(500).selectExpr("concat('K', id) k", "'v' v").repartition(3)
    first = cleaning._first_rows(raw, ["k"], {"k": F.upper(F.trim("k"))}, after)
    assert first.rdd.getNumPartitions() == 7 and first.count() == 500


def test_rows_alone_under_their_key_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Of a table whose keys seldom repeat only key hashes are dealt; the report and the rows are those of one deal."""
    raw = spark.range(3000).selectExpr("concat('K', id) k", "if(id % 5 = 0, null, 'v') v")
    copies = raw.filter("k in ('K1', 'K5')").union(spark.sql("SELECT 'K1', 'a'")).union(spark.sql("SELECT null, 'b'"))
    raw = stage(raw.union(copies).union(spark.sql("SELECT null, null")), "raw")
    sent = []
    whole = cleaning._first_rows
    monkeypatch.setattr(cleaning, "_first_rows", lambda rest, *more: (sent.append(rest.count()), whole(rest, *more))[1])
    for after in (False, True):
        first = cleaning._firsts(raw, ["k"], {"k": F.upper(F.trim("k"))}, after, stage)
        expected = whole(raw, ["k"], {"k": F.upper(F.trim("k"))}, after)
        assert sorted(map(str, first.select(expected.columns).collect())) == sorted(map(str, expected.collect()))
    assert all(7 <= n < 40 for n in sent)  # K1, K5, the missing key, and a few that share their bits
    got = cleaning.first_by_key(raw, ["k"], stage).collect()
    assert sorted(map(str, got)) == sorted(map(str, cleaning.dedupe_by_key(raw, ["k"]).collect()))


def test_rows_meet_only_keys_without_a_parent(spark, monkeypatch):
    """The dimension is not sent past the rows: with many parents they meet the few values that have none."""
    sales = stage(spark.range(1000).selectExpr("id", "if(id % 7 = 0, null, concat(' c', id % 100)) c"), "lines")
    dim = spark.range(98).selectExpr("concat('C', id) c")
    upper = {"c": F.upper(F.trim("c"))}
    monkeypatch.setattr(cleaning, "_MOST_KEYS", 50)
    written = []

    def watched(df, name):
        written.append(name)
        return stage(df, name)

    rows = sales.withColumns(upper)
    plain = cleaning.map_unknown_member(rows, dim, "c", "none", "changed")
    mapped = cleaning.map_unknown_member(rows, dim, "c", "none", "changed", watched, cleaning._values(sales, upper, "c"))
    assert sorted(map(tuple, mapped.select(plain.columns).collect())) == sorted(map(tuple, plain.collect()))
    assert "Exchange hashpartitioning" not in mapped._jdf.queryExecution().executedPlan().toString()
    assert written == ["lookup_c", "strays_c"]
