"""Column helpers: rounding, ratios, parsing, text."""

from __future__ import annotations

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillwise.functions import dates, numeric, text
from tillwise.functions.relations import checked_lookup, side_by_side


def values(spark, kind, items, expr):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_round2_is_half_up_on_decimals(spark):
    assert values(spark, "double", [1.005, 1.125, -1.125, None], numeric.round2) == [1.01, 1.13, -1.13, None]


def test_ratio_policies(spark):
    one = spark.createDataFrame([(1, 0), (1, 4), (None, 4)], "a long, b long")
    rows = one.select(
        numeric.ratio("a", "b"), numeric.ratio_or_zero("a", "b"), numeric.pct("a", "b")
    ).collect()
    assert [tuple(r) for r in rows] == [(None, 0.0, None), (0.25, 0.25, 25.0), (None, 0.0, None)]


def test_money_sum_is_exact(spark):
    amounts = [Decimal("0.01")] * 1000 + [Decimal("999999999999.99")] * 50 + [Decimal("-3.07"), None]
    df = spark.createDataFrame([(x,) for x in amounts], "x decimal(14,2)")
    got = df.agg(numeric.money_sum("x").alias("s"), F.sum("x").alias("t")).first()
    assert got.s == got.t == sum(x for x in amounts if x is not None)
    assert df.filter("x is null").agg(numeric.money_sum("x")).first()[0] is None


def test_to_number_refuses_what_is_not_a_number(spark):
    items = ["12", " 1.5 ", "1e3", "-.5", "abc", "12abc", "NaN", "inf", "1.5d", "0x10", "", None]
    assert values(spark, "string", items, lambda c: numeric.to_number(c, "double")) == [
        12.0, 1.5, 1000.0, -0.5, *[None] * 8,
    ]


def test_to_date_wants_iso(spark):
    items = ["2024-02-29", " 2024-01-05 ", "2023-02-29", "2024-1-5", "2024", "13/40/2020", "2024-01-05x10:00", None]
    assert values(spark, "string", items, dates.to_date) == [
        datetime.date(2024, 2, 29), datetime.date(2024, 1, 5), *[None] * 6,
    ]


def test_to_date_takes_date_times(spark):
    times = ["2024-03-05 00:00:00", "2024-03-05T23:59:59Z", "2024-03-05T23:30:00.123-05:00", " 2024-03-05 10:00"]
    assert values(spark, "string", times, dates.to_date) == [datetime.date(2024, 3, 5)] * 4
    other = values(spark, "string", ["05.03.2024", "2024-03-05", "x"], lambda c: dates.to_date(c, ["yyyy-MM-dd", "dd.MM.yyyy"]))
    assert other == [datetime.date(2024, 3, 5), datetime.date(2024, 3, 5), None]


def test_month_numbers_are_consecutive(spark):
    got = values(spark, "string", ["2023-12", "2024-01", "2025-01"], dates.month_number)
    assert got[1] - got[0] == 1 and got[2] - got[1] == 12


@pytest.mark.parametrize(
    "raw", ["o'BRIEN MARY-ANN", "  3rd street ", "élan vital", "they're", "a1b2", "x", " pad \n"]
)
def test_title_case_matches_python(spark, raw):
    got = values(spark, "string", [raw], lambda c: text.normalize_text(c, title=True))
    assert got == [raw.strip().title()]


def test_normalize_text_missing_words(spark):
    assert values(spark, "string", ["", "  ", "nan", "NaN", " ok ", None], lambda c: text.normalize_text(c, upper=True)) == [
        None, None, None, None, "OK", None,
    ]


def test_province(spark):
    items = ["ON", " B.C. ", "québec", "Ont.", "Atlantis", None]
    assert values(spark, "string", items, text.normalize_province) == [
        "Ontario", "British Columbia", "Quebec", "Ontario", None, None,
    ]


def test_full_match_is_strict(spark):
    items = ["CUST0001", "CUST0001\n", "xCUST0001", "CUST001", None]
    assert values(spark, "string", items, lambda c: text.full_match(c, r"CUST\d{4}")) == [
        True, False, False, False, None,
    ]


def test_is_integral(spark):
    assert values(spark, "double", [2.0, 2.5, None], numeric.is_integral) == [True, False, None]


def test_side_by_side(spark):
    a, b = spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")
    assert side_by_side(a, b).collect() == [(1, "x")]


def test_checked_lookup_refuses_duplicate_keys(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    good = spark.createDataFrame([(1, "a")], "k int, v string")
    assert sorted(checked_lookup(df, good, "k", ["v"]).collect(), key=str) == [(1, "a"), (2, None)]
    bad = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(Exception, match="duplicate k"):
        checked_lookup(df, bad, "k", ["v"]).collect()
