"""What reaches the scan: pushed filters, pruned columns, partition columns for free."""

from __future__ import annotations

import re

import pytest

from tillwise.operators import basic, inventory, products, sales
from tillwise.sources.star import benchmark_star

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def star(spark):
    return benchmark_star(spark, SF)


def scans(df):
    """(pushed filters, read columns, partition filters) of every scan of the plan."""
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    out = []
    for block in re.split(r"\n\n+", text):
        if "Scan parquet" in block and "ReadSchema" in block:
            schema = re.search(r"ReadSchema: struct<(.*)>", block).group(1)
            # Type arguments such as decimal(14,2) hold commas too.
            columns = [c.split(":")[0] for c in re.split(r",(?![^(]*\))", schema) if c]
            pushed = re.search(r"PushedFilters: \[(.*)\]", block)
            parts = re.search(r"PartitionFilters: \[(.*)\]", block)
            out.append((pushed.group(1) if pushed else "", set(columns), parts.group(1) if parts else ""))
    return out


def test_filters_are_pushed_and_columns_pruned(star):
    [(pushed, columns, _)] = scans(basic.discounted_lines(star))
    assert "GreaterThan(discount_pct" in pushed and "GreaterThanOrEqual(net_revenue" in pushed
    assert columns == {"order_id", "order_date", "product_id", "net_revenue", "discount_pct"}


def test_monthly_revenue_reads_one_column(star):
    [(_, columns, _)] = scans(sales.month_over_month(star))
    assert columns == {"net_revenue"}


def test_top_products_read_what_they_sum(star):
    read = [columns for _, columns, _ in scans(products.top_products_by_revenue(star))]
    assert {"product_id", "quantity", "net_revenue"} in read
    assert {"product_id", "product_name", "category"} in read


def test_latest_snapshot_prunes_partitions(star):
    facts = [s for s in scans(inventory.below_reorder_latest(star)) if "closing_stock" in s[1]]
    assert facts and all("month" in partitions for _, _, partitions in facts)
