"""The KPI layer: named measures evaluated by any dimensions.

Each fact table is aggregated on its own and the results are stacked by dimension
values, so facts are never joined to each other. Sums are taken at key grain before the
dimension tables are joined; only distinct counts carry dimensions with fact rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.dates import month_key
from tillwise.functions.numeric import dbl, lng, money_sum, ratio
from tillwise.functions.relations import dealt, side_by_side
from tillwise.model import RetailTables
from tillwise.plans.calendar import calendar_lag, growth, on_month_axis, year_to_date
from tillwise.plans.distinct import distinct_and_sums
from tillwise.plans.slicing import FACT_DATE, KEYS, slice_star

# dimension attribute -> dimension table
ATTRIBUTES = {
    **{c: "products" for c in ("product_id", "product_name", "category", "subcategory", "supplier")},
    **{c: "stores" for c in ("store_id", "store_name", "province", "store_type")},
    **{c: "customers" for c in ("customer_id", "customer_name", "customer_segment")},
    **{c: "date" for c in ("date", "month", "year", "quarter")},
}

# Attributes that may have as many values as their table has rows; all others are few by nature.
GROWING = {
    "product_id", "product_name", "store_id", "store_name", "customer_id", "customer_name",
}
MOST_VALUES = 10_000


def _date_attribute(name: str, date: str) -> Column:
    return {
        "date": F.col(date),
        "month": month_key(date),
        "year": lng(F.year(date)),
        "quarter": F.concat(F.lit("Q"), F.quarter(date).cast("string")),
    }[name]


@dataclass(frozen=True)
class Additive:
    """Sum of a fact column, optionally weighted by a product column afterwards."""

    fact: str
    source: Callable[[], Column]
    weight: str | None = None
    money: bool = False  # report as double
    cents: bool = False  # a two-decimal column

    def total(self, own: Callable[[Column], Column] = lambda c: c) -> Column:
        value = own(self.source())
        return money_sum(value) if self.cents else F.sum(value)


@dataclass(frozen=True)
class Distinct:
    """Distinct count of an id on the sales lines; ``known`` leaves the unknown member out."""

    column: str
    known: bool = False
    fact: str = "sales"

    def condition(self, unknown: object) -> Column:
        return F.col(self.column) != F.lit(unknown) if self.known else F.lit(True)


@dataclass(frozen=True)
class Nested:
    """Aggregate of an aggregate; builds its own frame from (tables, dims)."""

    fact: str
    build: Callable[[RetailTables, Sequence[str], str], DataFrame]


@dataclass(frozen=True)
class Ratio:
    num: str
    den: str


def _average_monthly_value(t: RetailTables, dims: Sequence[str], out: str) -> DataFrame:
    per_month = _additive(t, "inventory", {"__v": MEASURES["closing_inventory_value"]}, [*dims, "__month"])
    return per_month.groupBy(*dims).agg(
        F.try_divide(F.sum("__v").cast("double"), F.count("__v")).alias(out)
    )


def _repeat_customers(t: RetailTables, dims: Sequence[str], out: str) -> DataFrame:
    known = t.sales.filter(F.col("customer_id") != F.lit(t.unknown_customer))
    """Customers with two orders or more.

    Orders of a customer are close to a row per line, so lines are dealt before they are counted:
    tasks that read them would hold a row per line and save nothing. The orders of a customer who
    has very many are spread, and only counted in one task.
    """
    key = [*[c for c in dims if c != "customer_id"], "customer_id"]
    lines = _described(t, known, "sales", dims).select(*key, "order_id")
    orders = dealt(lines, *key, "order_id").distinct()
    per_customer = dealt(orders, *key).groupBy(*key).agg(F.count("order_id").alias("__n"))
    return per_customer.groupBy(*dims).agg(F.count_if(F.col("__n") >= 2).alias(out))


MEASURES: dict[str, Additive | Distinct | Nested | Ratio] = {
    "total_revenue": Additive("sales", lambda: F.col("net_revenue"), money=True, cents=True),
    "total_profit": Additive("sales", lambda: F.col("profit"), money=True, cents=True),
    "profit_margin": Ratio("total_profit", "total_revenue"),
    "orders": Distinct("order_id"),
    "units_sold": Additive("sales", lambda: F.col("quantity")),
    "average_order_value": Ratio("total_revenue", "orders"),
    "customers": Distinct("customer_id", known=True),
    "average_discount": Ratio("discount_sum", "sales_lines"),
    "returned_units": Additive("returns", lambda: F.col("quantity_returned")),
    "return_rate": Ratio("returned_units", "units_sold"),
    "inventory_observations": Additive("inventory", lambda: F.lit(1)),
    "stockout_observations": Additive(
        "inventory", lambda: F.when(F.col("closing_stock") == 0, 1).otherwise(0)
    ),
    "stockout_rate": Ratio("stockout_observations", "inventory_observations"),
    "closing_inventory_value": Additive(
        "inventory", lambda: F.col("closing_stock"), weight="unit_cost", money=True
    ),
    "avg_monthly_inventory_value": Nested("inventory", _average_monthly_value),
    "inventory_turnover_measure": Ratio("cost_of_goods_sold", "avg_monthly_inventory_value"),
    "repeat_customers": Nested("sales", _repeat_customers),
    "repeat_customer_rate": Ratio("repeat_customers", "customers"),
    # parts of ratios above
    "cost_of_goods_sold": Additive("sales", lambda: F.col("cost"), money=True, cents=True),
    "discount_sum": Additive("sales", lambda: F.col("discount_pct"), money=True),
    "sales_lines": Additive("sales", lambda: F.lit(1)),
}
TIME_MEASURES = ("previous_month_revenue", "mom_growth", "ytd_revenue")


def _related(t: RetailTables, fact: str) -> set[str]:
    """Dimension tables that filter a fact; enriched returns relate to all of them."""
    columns = set(t.table(fact).columns)
    return {"date"} | {dim for dim, key in KEYS.items() if key in columns}


def _dims_of(t: RetailTables, fact: str, dims: Sequence[str]) -> list[str]:
    return [d for d in dims if d == "__month" or ATTRIBUTES[d] in _related(t, fact)]


def _with_dates(df: DataFrame, fact: str, dims: Sequence[str]) -> DataFrame:
    date = FACT_DATE[fact]
    named = {d: _date_attribute(d, date) for d in dims if ATTRIBUTES.get(d) == "date"}
    if "__month" in dims:
        named["__month"] = month_key(date)
    return df.withColumns(named) if named else df


def _join_dims(t: RetailTables, df: DataFrame, dims: Sequence[str], weight: str | None = None) -> DataFrame:
    for table, key in KEYS.items():
        wanted = [d for d in dims if ATTRIBUTES.get(d) == table and d != key]
        if table == "products" and weight:
            wanted.append(weight)
        if wanted:
            df = df.join(t.table(table).select(key, *wanted), key)
    return df


def _described(t: RetailTables, rows: DataFrame, fact: str, dims: Sequence[str]) -> DataFrame:
    return _join_dims(t, _with_dates(rows, fact, dims), dims)


def _additive(
    t: RetailTables, fact: str, measures: dict[str, Additive], dims: Sequence[str]
) -> DataFrame:
    """Additive measures of one fact by attributes.

    With one dimension table the facts are summed by its key before the join, so only a
    row per key meets it. Keys of several tables together are close to fact grain; then
    summing twice would shuffle the facts for nothing, and they are joined directly.
    """
    weight = next((m.weight for m in measures.values() if m.weight), None)
    tables = {ATTRIBUTES[d] for d in dims if d != "__month"} | ({"products"} if weight else set())
    keys = [key for table, key in KEYS.items() if table in tables]
    dates = [d for d in dims if d == "__month" or ATTRIBUTES[d] == "date"]
    dated = _with_dates(t.table(fact), fact, dates)

    def weighted(value: Column, m: Additive) -> Column:
        return value.cast("decimal(18,0)") * F.col(m.weight) if m.weight else value

    if len(keys) > 1:
        totals = {
            n: F.sum(weighted(m.source(), m)) if m.weight else m.total() for n, m in measures.items()
        }
        joined = _join_dims(t, dated, dims, weight)
    else:
        per_key = dated.groupBy(*keys, *dates).agg(*[m.total().alias(n) for n, m in measures.items()])
        totals = {n: F.sum(weighted(F.col(n), m)) for n, m in measures.items()}
        joined = _join_dims(t, per_key, dims, weight)
    return joined.groupBy(*dims).agg(*[c.alias(n) for n, c in totals.items()])


def _direct(
    t: RetailTables, fact: str, measures: dict[str, Additive | Distinct], dims: Sequence[str]
) -> DataFrame:
    """All measures of a fact in one aggregation; needed once a distinct count is asked for."""
    aggregates = []
    for name, m in measures.items():
        if isinstance(m, Distinct):
            value = F.when(m.condition(t.unknown_customer), F.col(m.column))
            aggregates.append(F.countDistinct(value).alias(name))
        else:
            aggregates.append(m.total().alias(name))
    return _described(t, t.table(fact), fact, dims).groupBy(*dims).agg(*aggregates)


def _parts(names: Iterable[str]) -> list[str]:
    out: list[str] = []
    for name in names:
        m = MEASURES[name]
        for part in _parts((m.num, m.den)) if isinstance(m, Ratio) else [name]:
            if part not in out:
                out.append(part)
    return out


def _value(name: str) -> Column:
    m = MEASURES[name]
    if isinstance(m, Ratio):
        return ratio(_value(m.num), _value(m.den))
    return dbl(name) if getattr(m, "money", False) else F.col(name)


def _fact_frames(t: RetailTables, names: Sequence[str], dims: Sequence[str]):
    """(related dims, frame) per independent aggregation."""
    plain: dict[str, dict[str, Additive | Distinct]] = {}
    for name in names:
        m = MEASURES[name]
        if isinstance(m, Nested):
            own = _dims_of(t, m.fact, dims)
            yield own, m.build(t, own, name)
        else:
            plain.setdefault(m.fact, {})[name] = m
    for fact, group in plain.items():
        own = _dims_of(t, fact, dims)
        weighted = {n: m for n, m in group.items() if getattr(m, "weight", None)}
        rest = {n: m for n, m in group.items() if n not in weighted}
        if weighted:
            yield own, _additive(t, fact, weighted, own)
        counts = {n: m for n, m in rest.items() if isinstance(m, Distinct)}
        if len(counts) > 1:
            sums = {n: m.total for n, m in rest.items() if n not in counts}
            ids = {n: (m.column, m.condition(t.unknown_customer)) for n, m in counts.items()}
            yield own, distinct_and_sums(_described(t, t.table(fact), fact, own), own, ids, sums)
        elif rest:
            yield own, (_direct if counts else _additive)(t, fact, rest, own)


def measure_by(
    t: RetailTables,
    names: Sequence[str],
    dims: Sequence[str] = (),
    where: Mapping[str, object] | None = None,
    most_values: int = MOST_VALUES,
) -> DataFrame:
    """Measures by dimension attributes; no ``dims`` gives one row.

    ``where`` holds filters of :func:`slice_star`, applied before aggregating. Rows are the
    full outer combination of the facts. A fact that a dimension does not relate to is not
    split by it: its value repeats over all values of that dimension.

    Keys and names grow with the data, so two tables of them are never multiplied with each
    other (returns by customer and product). There the value of the less related fact is looked
    up for the combinations that occur in the other facts asked for; without such a fact it is a
    ValueError. Everything else that repeats has at most ``most_values`` values, or the query fails
    by name while it runs.
    """
    dims = list(dims)
    if where:
        t = slice_star(t, **where)
    frames = list(_fact_frames(t, _parts(names), dims))
    outputs = [_value(n).alias(n) for n in names]
    if not dims:
        return side_by_side(*[f for _, f in frames]).select(*outputs)
    whole, sparse = [], []
    for own, frame in frames:
        (sparse if _grows_twice(own, dims) else whole).append((own, frame))
    if not whole:
        apart = sorted({ATTRIBUTES[d] for d in dims if d in GROWING})
        raise ValueError(
            f"no measure asked for relates to {' and '.join(apart)} together, so their combinations"
            f" would be a product; add one that does, or ask for fewer of {', '.join(dims)}"
        )
    spread = [_repeated(t, f, own, dims, most_values) for own, f in whole]
    stacked = spread[0]
    for f in spread[1:]:
        stacked = stacked.unionByName(f, allowMissingColumns=True)
    values = [c for c in stacked.columns if c not in dims]
    out = stacked.groupBy(*dims).agg(*[F.max(c).alias(c) for c in values])
    for own, frame in sparse:
        out = _looked_up(out, frame, own)
    return out.select(*dims, *outputs)


def _grows_twice(own: Sequence[str], dims: Sequence[str]) -> bool:
    """If repeating a fact by ``own`` over the other dims multiplies two sides that grow with the data."""
    missing = {ATTRIBUTES[d] for d in dims if d not in own and d in GROWING}
    return len(missing) + any(d in GROWING for d in own) > 1


def _repeated(
    t: RetailTables, frame: DataFrame, own: Sequence[str], dims: Sequence[str], most: int
) -> DataFrame:
    """A fact's rows once for every value of the dimension tables it does not relate to.

    At most one side grows with the data: the rows of the fact, or the values of one table. It stays
    a DataFrame, and the others, of checked size, are unfolded on each of its rows.
    """
    tables = [k for k in KEYS if any(d not in own and ATTRIBUTES[d] == k for d in dims)]
    growing = [k for k in tables if any(d in GROWING and ATTRIBUTES[d] == k for d in dims)]
    for table in sorted(tables, key=lambda k: k in growing):
        attributes = [d for d in dims if ATTRIBUTES[d] == table]
        values = t.table(table).select(*attributes).distinct()
        if table in growing:
            frame = _unfolded(values, frame, most, f"measures by {', '.join(own) or 'company'}")
        else:
            frame = _unfolded(frame, values, most, f"values of {', '.join(attributes)}")
    return frame


def _unfolded(rows: DataFrame, few: DataFrame, most: int, what: str) -> DataFrame:
    """Every row of ``rows`` with every row of ``few``, which must be at most ``most``.

    One row more than allowed is read; it stops the query instead of being dropped.
    """
    packed = few.limit(most + 1).agg(F.collect_list(F.struct(*few.columns)).alias("all"))
    checked = packed.select(
        F.when(F.size("all") <= most, F.col("all")).otherwise(F.raise_error(F.lit(f"more than {most} {what}")))
    )
    return rows.select("*", F.inline(checked.scalar()))


def _looked_up(out: DataFrame, frame: DataFrame, own: Sequence[str]) -> DataFrame:
    """The values of a fact by ``own`` dims on every row of ``out`` that has those."""
    if not own:
        return out.select("*", *[frame.select(c).scalar().alias(c) for c in frame.columns])
    named = frame.withColumnsRenamed({d: f"__own_{d}" for d in own})
    same = reduce(lambda a, b: a & b, [F.col(d).eqNullSafe(F.col(f"__own_{d}")) for d in own])
    return out.join(named, same, "left").drop(*[f"__own_{d}" for d in own])


def time_measures(
    t: RetailTables, by: Sequence[str] = (), names: Sequence[str] = TIME_MEASURES
) -> DataFrame:
    """Measures on the date axis: previous calendar month, growth on it, year to date.

    Each combination of ``by`` that has sales gets a row for every month of the date dimension,
    so a month without sales still shows its year to date and its previous month.
    """
    unknown = sorted(set(names) - set(TIME_MEASURES))
    if unknown:
        raise ValueError(f"unknown time measures: {', '.join(unknown)}")
    by = list(by)
    sold = _additive(t, "sales", {"total_revenue": MEASURES["total_revenue"]}, [*by, "month"])
    out = on_month_axis(t, sold, by)
    if {"previous_month_revenue", "mom_growth"} & set(names):
        out = calendar_lag(out, "total_revenue", "previous_month_revenue", by=by)
    if "ytd_revenue" in names:
        out = year_to_date(out, "total_revenue", "ytd_revenue", by=by)
    values = {
        "previous_month_revenue": dbl("previous_month_revenue"),
        "mom_growth": growth("total_revenue", "previous_month_revenue"),
        "ytd_revenue": dbl("ytd_revenue"),
    }
    return out.select(*by, "month", *[values[n].alias(n) for n in names])
