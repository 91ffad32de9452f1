"""Cleaning operators: from messy all-text tables to the typed star.

Every ``clean_*`` returns a :class:`Cleaned` with two lazy frames: ``rows``, the valid
rows, and ``counts``, the one-row cleaning report. Both derive from the same checked
table, which a ``keep(df, name)`` callback may write out (``sources.staging.stage``) so
that it is computed once however many consumers follow.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.dates import ISO, to_date
from tillwise.functions.numeric import close_to, is_integral, to_number
from tillwise.functions.relations import dealt, rows_apart, rows_for, side_by_side
from tillwise.functions.text import full_match, normalize_province, normalize_text
from tillwise.sources.staging import stage

_VALID, _COUNTS = "__valid", "__counts"
_MOST_KEYS = 500_000  # keys that every task may read whole

Keep = Callable[[DataFrame, str], DataFrame]  # writes a table and reads it back, such as ``stage``


def as_is(df: DataFrame, name: str) -> DataFrame:
    """A ``keep`` that keeps nothing: the table is computed again by every consumer."""
    return df


@dataclass(frozen=True)
class Cleaned:
    rows: DataFrame
    counts: DataFrame


# ---------------------------------------------------------------- building blocks


def require_columns(df: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """Pass ``df`` on, or fail naming every missing column."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{table} lacks required columns: {', '.join(missing)}")
    return df


def count_missing(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(column, missing) for every column with at least one NULL; one pass."""
    columns = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    long = wide.unpivot([], columns, "column", "missing")
    return long.filter(F.col("missing") > 0)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """Distinct whole rows; NULLs compare equal."""
    return df.dropDuplicates()


def dedupe_by_key(df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """First row per key.

    A distributed table has no file order, so "first" means first by ``order``
    (default: all columns). Filtering on row 1 lets Spark drop all but one row per key
    before the shuffle, so a key holding most of the table costs no more than others.
    """
    order = list(order or df.columns)
    first = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return df.withColumn("__n", F.row_number().over(first)).filter(F.col("__n") == 1).drop("__n")


def first_by_key(df: DataFrame, key: Sequence[str], keep: Keep) -> DataFrame:
    """:func:`dedupe_by_key` of a large table, of which only rows that may share their key are dealt by it."""
    alone, rest = rows_apart(df, key, keep)
    return alone.unionByName(dedupe_by_key(dealt(rest, *key), key))


def coerce_date(
    df: DataFrame, *columns: str, formats: Sequence[str] = (ISO,)
) -> DataFrame:
    return df.withColumns({c: to_date(c, formats) for c in columns})


def coerce_numeric(df: DataFrame, kinds: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: to_number(c, kind) for c, kind in kinds.items()})


def fill_default(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), d) for c, d in defaults.items()})


def domain_default(c: Column | str, domain: Sequence[str], default: str) -> Column:
    """Keep members of the domain; others and NULL become the default."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(c.isin(*domain), c).otherwise(F.lit(default))


def lookup(dim: DataFrame, key: str, columns: Sequence[str] = (), keep: Keep = as_is) -> DataFrame:
    """One row per key with ``columns``, renamed to ``__<key>`` and ``__<column>``.

    Unique keys mean a join can never multiply fact rows. A dimension too large to
    broadcast should be kept (written out): adaptive execution splits a hot key of the
    fact side only if the other side of the join is a plain shuffle of a scan, not an
    aggregation that already fixed the partitioning.
    """
    rows = dim.groupBy(F.col(key).alias(f"__{key}")).agg(
        F.count(F.lit(1)).alias("__copies"), *[F.min(c).alias(f"__{c}") for c in columns]
    )
    return keep(rows.drop("__copies"), f"lookup_{key}")


def impute_from_dim(
    df: DataFrame, dim: DataFrame, key: str, column: str, keep: Keep = as_is
) -> DataFrame:
    """Fill NULLs of ``column`` with the dimension's value for the same key."""
    values = lookup(dim, key, [column], keep)
    filled = F.coalesce(F.col(column), F.col(f"__{column}"))
    joined = df.join(values, F.col(key) == F.col(f"__{key}"), "left")
    return joined.withColumn(column, filled).drop(f"__{key}", f"__{column}")


def map_unknown_member(
    df: DataFrame,
    dim: DataFrame,
    key: str,
    unknown: object,
    flag: str | None = None,
    keep: Keep = as_is,
    among: DataFrame | None = None,
) -> DataFrame:
    """Point NULL or orphan keys at the unknown member; ``flag`` marks the rows changed.

    ``among`` is that of :func:`with_parent`.
    """
    out = with_parent(df, lookup(dim, key, keep=keep), key, f"__has_{key}", keep, among)
    if flag:
        out = out.withColumn(flag, ~F.col(f"__has_{key}"))
    return out.withColumn(key, F.when(F.col(f"__has_{key}"), F.col(key)).otherwise(F.lit(unknown))).drop(f"__has_{key}")


def with_parent(
    df: DataFrame, parents: DataFrame, key: str, flag: str, keep: Keep = as_is, among: DataFrame | None = None
) -> DataFrame:
    """``flag`` tells whether ``key`` is in ``parents``, a :func:`lookup`.

    ``among`` holds all values of ``key`` in ``df`` and is cheaper to read. If it is given, ``keep``
    writes tables and the parents are many, its values meet the parents and ``df`` meets only those that
    have none: mostly few, so that the rows need not be shuffled.
    """
    found, stray = F.col(f"__{key}"), F.col(f"__stray_{key}")
    if among is not None and keep is not as_is and parents.count() > _MOST_KEYS:  # of files this reads footers only
        values = among.select(F.col(key).alias(f"__stray_{key}")).filter(stray.isNotNull()).distinct()
        strays = keep(values.join(parents, stray == found, "left_anti"), f"strays_{key}")
        out = df.join(F.broadcast(strays) if strays.count() <= _MOST_KEYS else strays, F.col(key) == stray, "left")
        return out.withColumn(flag, F.col(key).isNotNull() & stray.isNull()).drop(f"__stray_{key}")
    if among is not None and keep is not as_is:
        parents = F.broadcast(parents)
    out = df.join(parents.select(f"__{key}"), F.col(key) == found, "left")
    return out.withColumn(flag, found.isNotNull()).drop(f"__{key}")


def _values(raw: DataFrame, normalise: Mapping[str, Column], column: str) -> DataFrame:
    """The normalised values of a raw column, equal texts once."""
    return raw.select(column).distinct().withColumn(column, normalise[column])


def append_unknown_member(
    customers: DataFrame, member: Mapping[str, str] = model.UNKNOWN_CUSTOMER_ROW
) -> DataFrame:
    """Add the sentinel customer so unattributed sales keep a valid key."""
    values = [F.lit(member[f.name]).cast(f.dataType).alias(f.name) for f in customers.schema]
    return customers.unionByName(customers.sparkSession.range(1).select(*values))


def derive_measures(df: DataFrame, rounding: str = "half_up") -> DataFrame:
    """gross, net, cost and profit of a sales line, each rounded to cents in turn."""
    if rounding not in ("half_up", "half_even"):
        raise ValueError(f"unknown rounding {rounding}")
    cents = F.round if rounding == "half_up" else F.bround
    quantity = F.col("quantity").cast("decimal(10,0)")
    keep = F.lit(1).cast("decimal(1,0)") - F.col("discount_pct")

    def money(c: Column) -> Column:
        return cents(c, 2).cast(model.MONEY)

    return (
        df.withColumn("gross_revenue", money(quantity * F.col("unit_price")))
        .withColumn("net_revenue", money(F.col("gross_revenue") * keep))
        .withColumn("cost", money(quantity * F.col("unit_cost")))
        .withColumn("profit", money(F.col("net_revenue") - F.col("cost")))
    )


def repair_balance(df: DataFrame, flag: str = "__repaired") -> DataFrame:
    """Recompute a closing stock that is negative, missing or off balance.

    Only where opening + received - sold is known and not negative.
    """
    expected = F.col("opening_stock") + F.col("units_received") - F.col("units_sold")
    wrong = (F.col("closing_stock") < 0) | ~close_to(F.col("closing_stock"), expected)
    fix = F.coalesce(expected >= 0, F.lit(False)) & F.coalesce(wrong, F.lit(True))
    return df.withColumn(flag, fix).withColumn(
        "closing_stock", F.when(F.col(flag), expected).otherwise(F.col("closing_stock"))
    )


def all_true(rules: Sequence[Column]) -> Column:
    """Conjunction in which an unknown (NULL) rule counts as broken."""
    return reduce(lambda a, b: a & b, [F.coalesce(r, F.lit(False)) for r in rules])


def filter_valid(df: DataFrame, rules: Sequence[Column]) -> DataFrame:
    return df.filter(all_true(rules))


def match_returns(
    returns: DataFrame, sales: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """Returns that agree with a sale line: same order and product, sold no later, and at
    least the (positive, whole) quantity returned.

    Quantities are checked per return row, not summed over one sale line. A semi join
    cannot multiply rows, and adaptive execution may split it on a hot sale line. With ``keep``,
    such as :func:`stage`, the lines returned are found and written first, so sales stored in
    buckets of their key are not shuffled.
    """
    if keep:
        key = ["order_id", "product_id"]
        sales = keep(rows_for(sales.select(*key, "order_date", "quantity"), returns, key), "returned_lines")
    lines = sales.select(
        F.col("order_id").alias("__o"),
        F.col("product_id").alias("__p"),
        F.col("order_date").alias("__date"),
        F.col("quantity").alias("__sold"),
    )
    whole = returns.filter(
        all_true([F.col("quantity_returned") > 0, is_integral("quantity_returned")])
    )
    agrees = (
        (F.col("order_id") == F.col("__o"))
        & (F.col("product_id") == F.col("__p"))
        & (F.col("return_date") >= F.col("__date"))
        & (F.col("quantity_returned") <= F.col("__sold"))
    )
    return whole.join(lines, agrees, "left_semi")


# ---------------------------------------------------------------- per-table composites


def _first_rows(raw: DataFrame, key: list[str], normalise: Mapping[str, Column], after: bool) -> DataFrame:
    """The first row per key plus normalised columns, and what the report says about the key.

    The raw table is read and dealt once, by key, and sorted once: a row that ranks where it
    stands is the first of its equals, and the rows of a key are then summed as they come, without
    holding them. By default keys are compared as they were read, so ``" P1 "`` and ``"P1"`` both
    survive; ``after=True`` normalises first and merges them.
    """
    columns = raw.columns
    by = [f"__by_{c}" for c in key] if after else key
    keyed = raw.withColumns({b: normalise.get(c, F.col(c)) for b, c in zip(by, key)}) if after else raw
    in_order = Window.partitionBy(*by).orderBy(*columns)
    counted = dealt(keyed, *by).withColumn(
        "__fresh", (F.rank().over(in_order) == F.row_number().over(in_order)).cast("long")
    ).withColumns({f"__missing_{c}": F.col(c).isNull().cast("long") for c in columns})
    if after:
        counted = counted.withColumns(normalise)
    first = (
        counted.groupBy(*[F.col(b).alias(f"__key_{c}") for b, c in zip(by, key)])
        .agg(
            F.min(F.struct(*columns)).alias("__first"),
            F.sum("__fresh").alias("__distinct"),
            F.count(F.lit(1)).alias("__rows"),
            *[F.sum(f"__missing_{c}").alias(f"__missing_{c}") for c in columns],
        )
        .select("__first.*", "__distinct", "__rows", *[f"__missing_{c}" for c in columns])
    )
    return first if after else first.withColumns(normalise)


def _firsts(raw: DataFrame, key: list[str], normalise: Mapping[str, Column], after: bool, keep: Keep) -> DataFrame:
    """:func:`_first_rows` of a large table: if ``keep`` writes tables, rows alone under their key stay where they are."""
    if keep is as_is:
        return _first_rows(raw, key, normalise, after)
    by = [f"__by_{c}" for c in key] if after else key
    keyed = raw.withColumns({b: normalise.get(c, F.col(c)) for b, c in zip(by, key)}) if after else raw
    alone, rest = (part.select(*raw.columns) for part in rows_apart(keyed, by, keep))
    counted = alone.withColumns(
        {"__distinct": F.lit(1).cast("long"), "__rows": F.lit(1).cast("long")}
        | {f"__missing_{c}": F.col(c).isNull().cast("long") for c in raw.columns}
    )
    return counted.withColumns(normalise).unionByName(_first_rows(rest, key, normalise, after))


def _packed(first: DataFrame, table: str) -> DataFrame:
    """What the report says about a key as one column, NULL where that is one row with nothing missing."""
    missing = [f"__missing_{c}" for c in model.RAW_COLUMNS[table]]
    plain = reduce(lambda a, b: a & b, [F.col(c) == 0 for c in missing], F.col("__rows") == 1)
    names = ["__rows", "__distinct", *missing]
    return first.withColumn(_COUNTS, F.when(~plain, F.struct(*names))).drop(*names)


def _typed(table: str, rows: DataFrame) -> DataFrame:
    return rows.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in model.CLEAN_SCHEMAS[table]]
    )


def _totals(table: str) -> list[Column]:
    """What the rows of :func:`_packed` say about the raw table, as aggregates."""
    total = lambda c, plain: F.coalesce(
        F.sum(F.coalesce(F.col(f"{_COUNTS}.{c}"), F.lit(plain))), F.lit(0)
    ).alias(c)
    return [
        F.count(F.lit(1)).alias("__keys"),
        total("__rows", 1),
        total("__distinct", 1),
        *[total(f"__missing_{c}", 0) for c in model.RAW_COLUMNS[table]],
    ]


def _report(table: str, totals: DataFrame, extras: Sequence[str] = ()) -> DataFrame:
    """One-row cleaning report from one row of totals, ``rows_after`` and the ``extras``.

    Key duplicates are the distinct raw rows beyond the keys.
    """
    missing = {c: F.col(f"__missing_{c}") for c in model.RAW_COLUMNS[table]}
    return totals.select(
        F.col("__rows").alias("rows_before"),
        "rows_after",
        (F.col("__rows") - F.col("__distinct")).alias("exact_duplicates_removed"),
        (F.col("__distinct") - F.col("__keys")).alias("primary_key_duplicates_removed"),
        (F.col("__keys") - F.col("rows_after")).alias("invalid_rows_removed"),
        reduce(lambda a, b: a + b, missing.values()).alias("missing_values_handled"),
        *[n.alias(f"missing_values:{c}") for c, n in missing.items()],
        *extras,
    )


def _observed(
    df: DataFrame, totals: Sequence[Column], keep: Keep, name: str, then: Callable[[DataFrame], DataFrame]
) -> tuple[DataFrame, DataFrame]:
    """What ``then`` makes of ``df``, kept, and one row of totals over ``df``.

    The totals are counted while the kept table is written, in the stage that writes it, so neither
    a second pass nor the counting columns are stored. A lost task is counted once, when it succeeds.
    """
    if keep is as_is:
        return then(df), df.agg(*totals)
    seen = Observation()
    kept = keep(then(df.observe(seen, *totals)), name)
    found = [F.lit(n).cast("long").alias(c) for c, n in seen.get.items()]
    return kept, df.sparkSession.range(1).select(*found)


def _cleaned(
    table: str,
    checked: DataFrame,
    keep: Keep,
    finish: Callable[[DataFrame], DataFrame] = lambda df: df,
    extras: Mapping[str, str] | None = None,
) -> Cleaned:
    """Split rows by the validity flag; ``extras`` are boolean columns to count."""
    totals = [
        *_totals(table),
        F.count_if(F.col(_VALID)).alias("rows_after"),
        *[F.count_if(F.col(c)).alias(n) for n, c in (extras or {}).items()],
    ]
    rows, counted = _observed(
        checked, totals, keep, table, lambda df: _typed(table, finish(df.filter(F.col(_VALID))))
    )
    return Cleaned(rows, _report(table, counted, list(extras or {})))


def clean_customers(
    raw: DataFrame,
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    segments: Sequence[str] = model.SEGMENTS,
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
) -> Cleaned:
    columns = model.RAW_COLUMNS["customers"]
    raw = require_columns(raw, "customers", columns).select(*columns)
    first = _packed(_first_rows(
        raw,
        ["customer_id"],
        {
            "customer_id": normalize_text("customer_id", upper=True),
            "customer_name": normalize_text("customer_name", title=True),
            "city": normalize_text("city", title=True),
            "province": normalize_province("province"),
            "customer_segment": normalize_text("customer_segment", title=True),
        },
        dedupe_after_normalize,
    ), "customers")
    named = F.concat(
        F.lit("Unknown Customer "), F.coalesce(F.col("customer_id"), F.lit("Record"))
    )
    filled = fill_default(
        coerce_date(first, "signup_date"),
        {
            "customer_name": named,
            "signup_date": F.lit(model.DEFAULTS["signup_date"]).cast("date"),
        },
    ).withColumn(
        "customer_segment",
        domain_default("customer_segment", segments, model.DEFAULTS["segment"]),
    )
    valid = all_true(
        [
            full_match("customer_id", patterns["customer_id"]),
            F.col("city").isNotNull(),
            F.col("province").isNotNull(),
        ]
    )
    return _cleaned("customers", filled.withColumn(_VALID, valid), keep)


def clean_products(
    raw: DataFrame,
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    categories: Sequence[str] = model.CATEGORIES,
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
) -> Cleaned:
    columns = model.RAW_COLUMNS["products"]
    raw = require_columns(raw, "products", columns).select(*columns)
    titled = ("product_name", "category", "subcategory", "supplier")
    first = _packed(_first_rows(
        raw,
        ["product_id"],
        {
            "product_id": normalize_text("product_id", upper=True),
            **{c: normalize_text(c, title=True) for c in titled},
        },
        dedupe_after_normalize,
    ), "products")
    filled = fill_default(
        coerce_numeric(first, {"unit_cost": "decimal(20,8)", "unit_price": "decimal(20,8)"}),
        {"supplier": F.lit(model.DEFAULTS["supplier"])},
    )
    valid = all_true(
        [
            full_match("product_id", patterns["product_id"]),
            F.col("product_name").isNotNull(),
            F.col("category").isin(*categories),
            F.col("subcategory").isNotNull(),
            F.col("unit_cost") >= 0,
            F.col("unit_price") >= 0,
        ]
    )
    return _cleaned("products", filled.withColumn(_VALID, valid), keep)


def clean_stores(
    raw: DataFrame,
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    store_types: Sequence[str] = model.STORE_TYPES,
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
) -> Cleaned:
    columns = model.RAW_COLUMNS["stores"]
    raw = require_columns(raw, "stores", columns).select(*columns)
    titled = ("store_name", "city", "store_type")
    first = _packed(_first_rows(
        raw,
        ["store_id"],
        {
            "store_id": normalize_text("store_id", upper=True),
            "province": normalize_province("province"),
            **{c: normalize_text(c, title=True) for c in titled},
        },
        dedupe_after_normalize,
    ), "stores")
    filled = fill_default(
        coerce_date(first, "opening_date"),
        {"opening_date": F.lit(model.DEFAULTS["opening_date"]).cast("date")},
    )
    valid = all_true(
        [
            full_match("store_id", patterns["store_id"]),
            F.col("store_name").isNotNull(),
            F.col("city").isNotNull(),
            F.col("province").isNotNull(),
            F.col("store_type").isin(*store_types),
        ]
    )
    return _cleaned("stores", filled.withColumn(_VALID, valid), keep)


def clean_sales(
    raw: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    rounding: str = "half_up",
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
    lookups: Mapping[str, DataFrame] | None = None,
) -> Cleaned:
    """Needs the three cleaned dimensions; orphan customers move to the unknown member.

    ``lookups`` are those of :func:`shared_lookups`, if made already.
    """
    lookups = lookups or shared_lookups(products, stores, keep)
    columns = model.RAW_COLUMNS["sales"]
    raw = require_columns(raw, "sales", columns).select(*columns)
    normalised = {
        c: normalize_text(c, upper=True) for c in ("order_id", "customer_id", "store_id", "product_id")
    }
    first = _packed(_firsts(
        raw,
        ["order_id", "product_id"],
        normalised,
        dedupe_after_normalize,
        keep,
    ), "sales")
    typed = coerce_numeric(
        coerce_date(first, "order_date"),
        {"quantity": "double", "unit_price": "decimal(20,8)", "discount_pct": "decimal(20,10)"},
    )
    # One join per dimension: the product row gives price, cost and existence.
    mapped = map_unknown_member(
        typed, customers, "customer_id", model.UNKNOWN_CUSTOMER, "__to_unknown", keep,
        _values(raw, normalised, "customer_id"),
    )
    placed = with_parent(
        mapped, lookups["stores"], "store_id", "__in_store", keep, _values(raw, normalised, "store_id")
    )
    looked_up = (
        placed.join(lookups["products"], F.col("product_id") == F.col("__product_id"), "left")
        .withColumn("unit_price", F.coalesce(F.col("unit_price"), F.col("__unit_price")))
        .withColumnRenamed("__unit_cost", "unit_cost")
    )
    valid = all_true(
        [
            full_match("order_id", patterns["order_id"]),
            F.col("order_date").isNotNull(),
            F.col("__in_store"),
            F.col("__product_id").isNotNull(),
            F.col("quantity") > 0,
            is_integral("quantity"),
            F.col("unit_price") >= 0,
            F.col("discount_pct").between(0, 1),
        ]
    )

    def finish(df: DataFrame) -> DataFrame:
        whole = df.withColumn("quantity", F.col("quantity").cast("long"))
        return derive_measures(whole, rounding)

    return _cleaned(
        "sales",
        looked_up.withColumn(_VALID, valid),
        keep,
        finish,
        {"customer_ids_assigned_to_unknown": "__to_unknown"},
    )


def shared_lookups(products: DataFrame, stores: DataFrame, keep: Keep = as_is) -> dict[str, DataFrame]:
    """The product and store lookups that sales and inventory both join."""
    return {
        "products": lookup(products, "product_id", ["unit_price", "unit_cost"], keep),
        "stores": lookup(stores, "store_id", keep=keep),
    }


def clean_inventory(
    raw: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
    lookups: Mapping[str, DataFrame] | None = None,
) -> Cleaned:
    lookups = lookups or shared_lookups(products, stores, keep)
    columns = model.RAW_COLUMNS["inventory"]
    raw = require_columns(raw, "inventory", columns).select(*columns)
    normalised = {c: normalize_text(c, upper=True) for c in ("store_id", "product_id")}
    first = _packed(_firsts(
        raw,
        ["date", "store_id", "product_id"],
        normalised,
        dedupe_after_normalize,
        keep,
    ), "inventory")
    typed = coerce_numeric(
        coerce_date(first, "date"), {c: "double" for c in model.STOCK_COLUMNS}
    )
    known = repair_balance(typed)
    for key, parents, flag in (("product_id", "products", "__in_catalog"), ("store_id", "stores", "__in_store")):
        known = with_parent(known, lookups[parents], key, flag, keep, _values(raw, normalised, key))
    valid = all_true(
        [
            F.col("date").isNotNull(),
            F.col("__in_store"),
            F.col("__in_catalog"),
            *[F.col(c) >= 0 for c in model.STOCK_COLUMNS],
        ]
    )
    return _cleaned(
        "inventory",
        known.withColumn(_VALID, valid),
        keep,
        extras={"closing_balances_corrected": "__repaired"},
    )


def clean_returns(
    raw: DataFrame,
    sales: DataFrame,
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    dedupe_after_normalize: bool = False,
    keep: Keep = as_is,
) -> Cleaned:
    """Needs the cleaned sales."""
    columns = model.RAW_COLUMNS["returns"]
    raw = require_columns(raw, "returns", columns).select(*columns)
    first = _packed(_firsts(
        raw,
        ["return_id"],
        {
            **{c: normalize_text(c, upper=True) for c in ("return_id", "order_id", "product_id")},
            "return_reason": normalize_text("return_reason", title=True),
        },
        dedupe_after_normalize,
        keep,
    ), "returns")
    typed = fill_default(
        coerce_numeric(coerce_date(first, "return_date"), {"quantity_returned": "double"}),
        {"return_reason": F.lit(model.DEFAULTS["return_reason"])},
    )
    named, before = _observed(
        typed, _totals("returns"), keep, "typed_returns",
        lambda df: filter_valid(df, [full_match("return_id", patterns["return_id"])]).select(*columns),
    )
    rows, after = _observed(
        match_returns(named, sales), [F.count(F.lit(1)).alias("rows_after")], keep, "returns",
        lambda df: _typed("returns", df),
    )
    return Cleaned(rows, _report("returns", side_by_side(before, after)))


# ---------------------------------------------------------------- whole star


def clean_all(
    raw: Mapping[str, DataFrame],
    patterns: Mapping[str, str] = model.ID_PATTERNS,
    categories: Sequence[str] = model.CATEGORIES,
    segments: Sequence[str] = model.SEGMENTS,
    store_types: Sequence[str] = model.STORE_TYPES,
    rounding: str = "half_up",
    dedupe_after_normalize: bool = False,
    keep: Keep = stage,
) -> dict[str, Cleaned]:
    """Clean dimensions, then sales and inventory, then returns.

    Later tables look up earlier ones, so each cleaned table is written to shared storage as it is
    reached, and counted for the report on the way; pass ``keep=as_is`` to stay lazy.
    """
    after = dedupe_after_normalize
    part = clean_customers(raw["customers"], patterns, segments, after, keep)
    customers = Cleaned(
        append_unknown_member(part.rows),
        part.counts.withColumn("rows_after", F.col("rows_after") + 1),
    )
    products = clean_products(raw["products"], patterns, categories, after, keep)
    stores = clean_stores(raw["stores"], patterns, store_types, after, keep)
    lookups = shared_lookups(products.rows, stores.rows, keep)
    sales = clean_sales(
        raw["sales"], customers.rows, products.rows, stores.rows, patterns, rounding, after, keep, lookups
    )
    return {
        "customers": customers,
        "products": products,
        "stores": stores,
        "sales": sales,
        "inventory": clean_inventory(raw["inventory"], products.rows, stores.rows, after, keep, lookups),
        "returns": clean_returns(raw["returns"], sales.rows, patterns, after, keep),
    }


def cleaned_tables(cleaned: Mapping[str, Cleaned]) -> model.RetailTables:
    return model.RetailTables(**{name: part.rows for name, part in cleaned.items()})


def cleaning_summary(cleaned: Mapping[str, Cleaned]) -> DataFrame:
    """(table, metric, value) over all tables."""
    parts = []
    for name, part in cleaned.items():
        long = part.counts.unpivot([], part.counts.columns, "metric", "value")
        parts.append(
            long.select(F.lit(name).alias("table"), "metric", F.col("value").cast("long"))
        )
    return reduce(DataFrame.unionByName, parts)
