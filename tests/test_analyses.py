"""Hand-checked results, identities between analyses, and independence of partitioning."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from tests.small_star import d, tiny_star
from tillwise.catalog import ANALYSES
from tillwise.operators import basic, customers, demand, frames, inventory, products, returns, sales, sampling, stores
from tillwise.plans import calendar, measures, report, slicing
from tillwise.plans.suite import run_suite
from tillwise.sources.staging import stage


@pytest.fixture(scope="module")
def star(spark):
    return tiny_star(spark)


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_all_42_run(star):
    assert len(ANALYSES) == 42
    done = {r.name: r.row_count for r in run_suite(star).collect()}
    assert list(done) == list(ANALYSES)
    assert done["table_row_counts"] == 6 and done["monthly_sales"] == 3


SHARING = (
    "lowest_revenue_products", "slow_catalog_products", "high_revenue_low_margin", "category_performance", "inventory_turnover",
    "product_returns", "category_return_rate", "customer_summary", "customer_frequency_value", "top_customers",
    "customer_value_segments", "new_vs_repeat_orders", "rfm_segments",
)


@pytest.mark.parametrize("name", SHARING)
def test_shared_totals_give_the_same_rows(star, shared, name):
    assert rows(ANALYSES[name](shared)) == rows(ANALYSES[name](star))


@pytest.fixture(scope="module")
def shared(star):
    return star.sharing(stage)


def test_shared_totals_are_written_once(star):
    kept = []
    t = star.sharing(lambda df, name: kept.append(name) or stage(df, name))
    for op in ANALYSES.values():
        op(t)
    assert sorted(kept) == ["customer_totals", "product_totals"]
    for op in (products.abc_classification, products.top_products_by_profit, returns.category_return_rate, customers.rfm_segments):
        assert "FileScan parquet" in op(t)._jdf.queryExecution().executedPlan().toString()
    assert not star.shares and not t.replace(sales=star.sales.limit(1)).shares


def test_orders_of_stores_are_counted_apart(star):
    """The pairs of store and order that are shuffled carry no sums; NULL orders count for nothing."""
    more = star.replace(sales=star.sales.unionByName(star.sales.withColumn("order_id", F.lit(None).cast("string"))))
    plan = stores.store_scorecard(more)
    got = {r.store_id: (r.orders, r.units_sold) for r in plan.collect()}
    lines = more.sales.collect()
    for store in got:
        own = [r for r in lines if r.store_id == store]
        assert got[store] == (len({r.order_id for r in own if r.order_id}), sum(r.quantity for r in own))


def test_levels_of_all_products_are_one_subquery(star):
    plan = products.high_revenue_low_margin(star)._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"scalar-subquery#\d+", plan)) == 2 and "mean_revenue" in plan


def test_suite_names_the_failure(star):
    def broken(t):
        raise RuntimeError("boom")

    with pytest.raises(RuntimeError, match="analysis bad failed"):
        run_suite(star, {"bad": broken})


def test_month_gap_row_lag_and_calendar_lag(star):
    by_row = rows(sales.month_over_month(star))
    assert by_row == [
        ("2023-01", 29.0, None, None),
        ("2023-03", 25.0, 29.0, -13.79),
        ("2024-01", 20.0, 25.0, -20.0),
    ]
    assert [r[2] for r in rows(sales.month_over_month(star, calendar=True))] == [None, None, None]
    assert rows(sales.year_over_year(star)) == []
    assert rows(sales.year_over_year(star, calendar=True)) == [("2024-01", 20.0, 29.0, -31.03)]


def test_discount_bands(star):
    assert [r[:2] for r in rows(sales.discount_bands(star))] == [
        ("No discount", 4), ("1-10%", 1), ("Over 20%", 1),
    ]
    assert [r[0] for r in rows(sales.discount_bands(star, edges=(0, 0.05, 0.25)))] == [
        "No discount", "6-25%",
    ]


def test_unsold_products_come_first(star):
    assert rows(basic.lowest_revenue_products(star, 1)) == [("P4", "Unsold", "Office", 0, 0.0)]
    assert rows(products.slow_catalog_products(star, 1))[0][:4] == ("P4", "Unsold", "Office", 0)


def test_abc_uses_the_share_including_the_row(star):
    got = {r[0]: (r[4], r[5]) for r in rows(products.abc_classification(star, a=0.4, b=0.8))}
    assert got == {"P3": (39.19, "A"), "P1": (72.97, "B"), "P2": (100.0, "C")}


def test_ties_share_a_rank_and_cut_by_key(spark, star):
    same = star.replace(sales=star.sales.withColumn("net_revenue", F.lit("5.00").cast("decimal(14,2)")).filter("order_id in ('O1', 'O2')"))
    assert [(r[0], r[4]) for r in rows(products.product_contribution(same))] == [("P1", 1), ("P2", 1), ("P3", 1)]
    assert [r[0] for r in rows(products.top_products_by_revenue(same, 2))] == ["P1", "P2"]


def test_unknown_customer_is_left_out(star):
    assert rows(customers.customer_summary(star)) == [(2, 32.0, 2.0, 50.0)]
    assert {r[0] for r in rows(customers.customer_frequency_value(star))} == {"C1", "C2"}
    assert rows(customers.new_vs_repeat_orders(star)) == [
        ("2023-01", 2, 0, 0.0), ("2023-03", 0, 1, 100.0), ("2024-01", 0, 1, 100.0),
    ]


def test_rfm_class_order(star):
    got = {r[0]: (r[2], r[3], r[5]) for r in rows(customers.rfm_segments(star))}
    assert got == {"C1": (0, 3, "Developing"), "C2": (352, 1, "At Risk")}
    loose = {r[0]: r[5] for r in rows(customers.rfm_segments(star, champions=(10, 3)))}
    assert loose["C1"] == "Champions"


def test_inventory(star):
    assert rows(inventory.below_reorder_latest(star)) == [
        (d("2023-03-31"), "First", "P1", "One", "Home", 2, 3, 1)
    ]
    assert rows(inventory.stockout_rate_by_store(star)) == [
        ("S2", "Second", 2, 1, 50.0), ("S1", "First", 2, 0, 0.0),
    ]
    turnover = {r[0]: r[1:] for r in rows(inventory.inventory_turnover(star))}
    assert turnover == {"Home": (22.0, 12.0, 1.83), "Office": (15.0, 2.0, 7.5)}


def test_returns(star):
    assert rows(returns.overall_return_rate(star)) == [(20, 3, 15.0)]
    assert rows(returns.store_return_rate(star)) == [("First", 4, 1, 25.0), ("Second", 16, 2, 12.5)]
    nothing = star.replace(returns=star.returns.limit(0), sales=star.sales.limit(0))
    assert rows(returns.overall_return_rate(nothing)) == [(None, None, None)]


def test_discount_bands_keep_fine_edges_apart(star):
    fine = star.replace(sales=star.sales.withColumn("discount_pct", F.expr("CASE order_id WHEN 'O1' THEN 0.0005 WHEN 'O2' THEN 0.002 ELSE 0.5 END").cast("decimal(9,6)")))
    labels = {r[0] for r in rows(sales.discount_bands(fine, edges=(0, 0.001, 0.004)))}
    assert labels == {"Over 0 to 0.1%", "Over 0.1 to 0.4%", "Over 0.4%"}
    with pytest.raises(ValueError, match="ascend"):
        sales.discount_bands(star, edges=(0, 0.2, 0.1))


def test_suite_computes_every_column(star):
    def pruned(t):
        return t.sales.select("order_id", F.raise_error(F.lit("no")).alias("x"))

    with pytest.raises(RuntimeError, match="pruned"):
        run_suite(star, {"pruned": pruned})


def test_identities(star):
    total = star.sales.agg(F.sum("net_revenue")).first()[0]
    by_category = rows(products.category_performance(star))
    assert sum(r[1] for r in by_category) == pytest.approx(float(total))
    contribution = rows(products.product_contribution(star))
    assert contribution[-1][-1] == 100.0
    assert len(rows(products.abc_classification(star))) == len(contribution) == 3
    known = star.sales.filter("customer_id <> 'CUST_UNKNOWN'").select("order_id").distinct().count()
    assert sum(r[1] + r[2] for r in rows(customers.new_vs_repeat_orders(star))) == known
    assert rows(sales.running_revenue(star))[-1][-1] == float(total)
    assert sum(r[3] for r in rows(stores.monthly_store_rank(star))) == pytest.approx(float(total))


def test_enrichment_keeps_rows(star):
    assert rows(report.enrichment_check(star)) == [(2, 2, 0)]
    lost = star.replace(sales=star.sales.filter("order_id <> 'O1'"))
    assert rows(report.enrichment_check(lost)) == [(2, 2, 1)]
    enriched = star.replace(returns=report.enrich_returns(star))
    by_store = {r[0]: r[1] for r in rows(measures.measure_by(enriched, ["returned_units"], ["store_name"]))}
    assert by_store == {"First": 1, "Second": 2}


def test_measures_repeat_over_unrelated_dimensions(star):
    got = {r[0]: r[1:] for r in rows(measures.measure_by(star, ["total_revenue", "returned_units"], ["customer_segment"]))}
    assert got == {"New": (65.0, 3), "Loyal": (9.0, 3)}
    alone = rows(measures.measure_by(star, ["returned_units"], ["customer_segment"]))
    assert sorted(alone) == [("Loyal", 3), ("New", 3)]


def test_unrelated_values_are_not_multiplied(star):
    """One side that grows with the data is repeated as a DataFrame; two are never multiplied."""
    attributes = {c.customer_id: c.customer_name for c in star.customers.collect()}
    kinds = {s.store_type for s in star.stores.collect()}
    returned = {}
    for r in star.returns.collect():
        returned[r.product_id] = returned.get(r.product_id, 0) + r.quantity_returned
    by = measures.measure_by(star, ["total_revenue", "returned_units"], ["customer_id"])
    assert {r[0]: r[2] for r in rows(by)}.items() >= dict.fromkeys(attributes, sum(returned.values())).items()
    wide = measures.measure_by(star, ["returned_units"], ["product_id", "store_type"])
    assert set(rows(wide)) == {(p, k, v) for p, v in returned.items() for k in kinds}
    monthly = measures.measure_by(star, ["returned_units"], ["month", "customer_name", "store_type"])
    months = {str(r.return_date)[:7] for r in star.returns.collect()}
    assert len(rows(monthly)) == len(months) * len(set(attributes.values())) * len(kinds)
    for df in (by, wide, monthly):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "collect_set" not in plan


def test_unrelated_keys_are_looked_up_or_refused(star):
    returned, sold = {}, {}
    for r in star.returns.collect():
        returned[r.product_id] = returned.get(r.product_id, 0) + r.quantity_returned
    for r in star.sales.collect():
        key = r.customer_id, r.product_id
        sold[key] = sold.get(key, 0) + r.quantity
    got = rows(measures.measure_by(star, ["units_sold", "returned_units", "return_rate"], ["customer_id", "product_id"]))
    assert {r[:2]: r[2:4] for r in got} == {k: (v, returned.get(k[1])) for k, v in sold.items()}
    assert {r[:2]: r[4] for r in got} == {
        k: returned[k[1]] / v if k[1] in returned else None for k, v in sold.items()
    }
    everywhere = rows(measures.measure_by(star, ["units_sold", "returned_units"], ["customer_id", "store_name"]))
    assert {r[3] for r in everywhere} == {sum(returned.values())}
    for dims in (["customer_id", "product_id"], ["customer_name", "store_id"], ["month", "customer_id", "product_name"]):
        with pytest.raises(ValueError, match="relates to customers and"):
            measures.measure_by(star, ["returned_units"], dims)


def test_repeated_values_are_bounded(star):
    few = measures.measure_by(star, ["returned_units"], ["product_id", "store_type"], most_values=2)
    assert few.count() == 2 * star.returns.select("product_id").distinct().count()
    for dims in (["product_id", "store_type"], ["month", "customer_id"]):
        with pytest.raises(Exception, match="more than 1 (values of store_type|measures by month)"):
            measures.measure_by(star, ["returned_units"], dims, most_values=1).collect()


def test_no_rows_of_partly_related_facts_are_lost(star):
    by = measures.measure_by(star, ["total_revenue", "returned_units"], ["month", "customer_segment"])
    got = {(r[0], r[1]): r[2:] for r in rows(by)}
    assert got["2023-02", "New"] == got["2023-02", "Loyal"] == (None, 1)  # a return in a month without sales
    assert got["2024-01", "New"] == (20.0, None)
    months = {m: v[1] for (m, _), v in got.items()}
    assert sum(v for v in months.values() if v) == 3


def test_measures_without_dimensions(star):
    names = [n for n in measures.MEASURES if n not in ("cost_of_goods_sold", "discount_sum", "sales_lines")]
    assert len(names) + len(measures.TIME_MEASURES) == 21
    got = measures.measure_by(star, names).first().asDict()
    assert got["total_revenue"] == 74.0 and got["orders"] == 5 and got["customers"] == 2
    assert got["repeat_customers"] == 1 and got["repeat_customer_rate"] == 0.5
    assert got["return_rate"] == 0.15 and got["stockout_rate"] == 0.25
    assert got["avg_monthly_inventory_value"] == 14.0
    assert got["inventory_turnover_measure"] == pytest.approx(37 / 14)


def test_time_measures(star):
    got = rows(measures.time_measures(star).orderBy("month"))
    assert len(got) == 13  # every month of the date dimension
    assert got[:4] == [
        ("2023-01", None, None, 29.0), ("2023-02", 29.0, None, 29.0),
        ("2023-03", None, None, 54.0), ("2023-04", 25.0, None, 54.0),
    ]
    assert got[11] == ("2023-12", None, None, 54.0) and got[12] == ("2024-01", None, None, 20.0)
    april = star.sales.filter("order_id = 'O3'").withColumn("order_date", F.lit(d("2023-04-01")))
    consecutive = star.replace(sales=star.sales.unionByName(april))
    growth = {r[0]: r[1:] for r in rows(measures.time_measures(consecutive, names=["previous_month_revenue", "mom_growth"]))}
    assert growth["2023-04"] == (25.0, pytest.approx(-0.4)) and growth["2023-03"] == (None, None)
    by = measures.time_measures(star, by=["category"]).groupBy("category").count()
    assert sorted(rows(by)) == [("Home", 13), ("Office", 13)]
    with pytest.raises(ValueError, match="weekly"):
        measures.time_measures(star, names=["weekly"])


def test_date_dimension_covers_every_day(star):
    days = calendar.date_dimension(star)
    assert days.count() == (d("2024-01-07") - d("2023-01-10")).days + 1
    assert rows(days.orderBy("date"))[0] == (d("2023-01-10"), 2023, 1, "Jan", "2023-01", 202301, "Q1")


def test_slice_filters_only_related_facts(star):
    picked = slicing.slice_star(star, date_from="2023-01-01", date_to="2023-12-31", province="Ontario")
    assert {r[0]: r[1] for r in rows(slicing.slice_totals(picked))} == {"sales": 3, "inventory": 2, "returns": 2}
    s2 = slicing.slice_star(star, supplier="S2", subcategory="B", category="Office")
    assert {r[0]: r[1] for r in rows(slicing.slice_totals(s2))} == {"sales": 2, "inventory": 2, "returns": 1}
    bob = slicing.slice_star(star, customer_segment="Loyal")
    assert {r[0]: r[1] for r in rows(slicing.slice_totals(bob))} == {"sales": 1, "inventory": 4, "returns": 2}


def test_stockout_matrix(star):
    got = {r.store_id: r.asDict() for r in report.stockout_matrix(star, ["Home", "Office"]).collect()}
    assert got["S1"]["Home"] == 0.0 and got["S1"]["Office"] is None
    assert got["S2"]["Office"] == 0.5 and got["S2"]["other"] is None
    rest = {r.store_id: r.other for r in report.stockout_matrix(star, ["Home"]).collect()}
    assert rest == {"S1": None, "S2": 0.5}


def test_executive_kpis_zero_policy(star):
    kpis = dict(rows(frames.executive_kpis(star)))
    assert kpis["Total Revenue"] == 74.0 and kpis["Inventory Turnover"] == pytest.approx(37 / 14)
    empty = star.replace(sales=star.sales.limit(0))
    assert dict(rows(frames.executive_kpis(empty)))["Profit Margin"] == 0.0


def test_frames_refuse_duplicate_dimension_keys(star):
    twice = star.replace(stores=star.stores.unionByName(star.stores))
    with pytest.raises(Exception, match="duplicate store_id"):
        frames.frame_stores(twice).collect()


def test_densify_and_rollforward(star):
    dense = demand.densify_grid(demand.monthly_demand(star))
    pairs = star.sales.select("store_id", "product_id").distinct().count()
    assert dense.count() == pairs * 13  # January 2023 to January 2024
    assert dense.agg(F.sum("units")).first()[0] == 20
    rolled = rows(demand.inventory_rollforward(star.inventory).orderBy("store_id", "date"))
    assert [(r[3], r[6]) for r in rolled] == [(5, 4), (4, 2), (5, 0), (0, 4)]


def test_samples_do_not_depend_on_partitioning(spark):
    df = spark.range(1000).selectExpr("id", "id + 1.0 as w")
    for draw in (
        lambda x: sampling.sample_rows(x, 50, ["id"], seed=1),
        lambda x: sampling.weighted_sample(x, 50, "w", ["id"], seed=1),
    ):
        first = {r.id for r in draw(df).collect()}
        assert len(first) == 50
        assert first == {r.id for r in draw(df.repartition(7)).collect()}
    assert {r.id for r in sampling.sample_rows(df, 50, ["id"], seed=2).collect()} != {
        r.id for r in sampling.sample_rows(df, 50, ["id"], seed=1).collect()
    }
    heavy = spark.range(1000).selectExpr("id", "if(id < 10, 1e9, 1e-9) as w")
    assert {r.id for r in sampling.weighted_sample(heavy, 10, "w", ["id"]).collect()} == set(range(10))


def _snapshot(star):
    picks = ("monthly_sales", "store_scorecard", "monthly_store_rank", "abc_classification", "rfm_segments", "province_performance")
    return {n: sorted(rows(ANALYSES[n](star)), key=str) for n in picks}


def test_results_do_not_depend_on_shuffle_partitions(star, partitions):
    seen = []
    for n in (1, 4, 50):
        partitions(n)
        seen.append(_snapshot(star))
    assert seen[0] == seen[1] == seen[2]


@pytest.mark.parametrize("n", [1, 150, 999, 1000, 1500])
def test_large_samples_are_the_same_rows(spark, n):
    """Cutoffs from histograms against sorting, for spread, tied and repeated keys."""
    df = spark.range(1000).selectExpr(
        "id", "id % 7 AS few", "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 13 = 0 THEN -1D ELSE exp(id % 40 - 20D) END AS w"
    ).repartition(5)
    for pick in (
        lambda **m: sampling.sample_rows(df, n, ["id"], seed=3, **m),
        lambda **m: sampling.sample_rows(df, n, ["few", "id"], seed=3, **m),
        lambda **m: sampling.weighted_sample(df, n, "w", ["id"], seed=3, **m),
    ):
        want = sorted(r.id for r in pick().collect())
        for most in (0, 1, 10, 200):
            got = pick(most_sorted=most)
            assert sorted(r.id for r in got.collect()) == want
            assert got.columns == df.columns
    want = sorted(r.few for r in sampling.sample_rows(df, n, ["few"]).collect())  # a key on a seventh of the rows
    assert sorted(r.few for r in sampling.sample_rows(df, n, ["few"], most_sorted=20).collect()) == want


def test_large_sample_sorts_only_the_edge(spark):
    df = spark.range(100_000).withColumn("w", F.col("id") + 1)
    got = sampling.weighted_sample(df, 20_000, "w", ["id"], most_sorted=100)
    assert got.count() == 20_000 and got.select("id").distinct().count() == 20_000
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"TakeOrderedAndProject\(limit=\d{1,3},", plan)
    assert sampling.sample_rows(df.limit(0), 20_000, ["id"]).count() == 0
