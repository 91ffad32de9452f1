"""Declarative checks. Each yields rows (table, rule, violations); zero means it holds.

Row rules of one table share a single scan. Key and relationship checks first count
rows per key, which combines map-side, so a key that fills a third of a table moves as
one row per task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.dates import to_date
from tillwise.functions.numeric import close_to, dbl, money_sum
from tillwise.functions.relations import union_all
from tillwise.model import RetailTables
from tillwise.sources.staging import stage

REPORT = "table string, rule string, violations long"


class ValidationError(AssertionError):
    """At least one rule found violations."""


def _holds(rule: Column) -> Column:
    return F.coalesce(rule, F.lit(False))


def _one(df: DataFrame, table: str, rule: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("long").alias("violations")).select(
        F.lit(table).alias("table"), F.lit(rule).alias("rule"), "violations"
    )


def check_rules(
    df: DataFrame,
    table: str,
    rules: Mapping[str, Column],
    weight: str | None = None,
    row_count: bool = False,
) -> DataFrame:
    """Rows breaking each rule, all rules in one pass; NULL counts as broken.

    ``weight`` is a column saying how many table rows a row of ``df`` stands for; ``row_count``
    adds a row of that name with all rows.
    """
    rows = F.col(weight) if weight else F.lit(1)
    broken = {name: F.when(~_holds(rule), rows).otherwise(0) for name, rule in rules.items()}
    if row_count:
        broken["row_count"] = rows
    wide = df.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(n) for n, c in broken.items()]
    )
    long = wide.unpivot([], list(broken), "rule", "violations")
    return long.select(F.lit(table).alias("table"), "rule", "violations")


def check_required_columns(
    spark: SparkSession, t: RetailTables, tables: Sequence[str] = model.TABLES
) -> DataFrame:
    """Schema check: number of required columns each table lacks."""
    found = [
        (n, "required_columns", len(set(model.CLEAN_SCHEMAS[n].names) - set(t.table(n).columns)))
        for n in tables
    ]
    return spark.createDataFrame(found, REPORT)


def check_not_null(df: DataFrame, table: str) -> DataFrame:
    return check_rules(
        df,
        table,
        {f"not_null:{c}": F.col(c).isNotNull() for c in model.CLEAN_SCHEMAS[table].names},
    )


def check_primary_key(df: DataFrame, table: str, counted: DataFrame | None = None) -> DataFrame:
    """Rows beyond the first of each key; ``counted`` holds a ``count`` per key, if known."""
    copies = counted if counted is not None else df.groupBy(*model.PRIMARY_KEYS[table]).count()
    return _one(copies, table, "primary_key", F.sum(F.col("count") - 1))


def sale_lines_by_key(t: RetailTables) -> DataFrame:
    """One row per sale line: its rows, first date and largest quantity.

    Serves the primary key, the composite foreign key and the returns check.
    """
    return t.sales.groupBy(*model.PRIMARY_KEYS["sales"]).agg(
        F.count(F.lit(1)).alias("count"),
        F.min("order_date").alias("order_date"),
        F.max("quantity").alias("quantity"),
    )


def range_rules() -> dict[str, dict[str, Column]]:
    c = F.col
    return {
        "sales": {
            "quantity_positive": c("quantity") > 0,
            "prices_not_negative": (c("unit_price") >= 0) & (c("unit_cost") >= 0),
            "discount_0_to_1": c("discount_pct").between(0, 1),
        },
        "products": {"prices_not_negative": (c("unit_price") >= 0) & (c("unit_cost") >= 0)},
        "inventory": {
            "closing_stock_not_negative": c("closing_stock") >= 0,
            "stock_fields_not_negative": (c("opening_stock") >= 0)
            & (c("units_received") >= 0)
            & (c("units_sold") >= 0)
            & (c("reorder_level") >= 0),
        },
    }


def check_ranges(t: RetailTables) -> DataFrame:
    return union_all(
        [check_rules(t.table(name), name, rules) for name, rules in range_rules().items()]
    )


def _orphans(child: DataFrame, columns: Sequence[str], parent: DataFrame) -> DataFrame:
    """(columns, count) of key values without a parent row."""
    return child.groupBy(*columns).count().join(parent.select(*columns), list(columns), "left_anti")


def check_foreign_key(
    t: RetailTables, child: str, columns: Sequence[str], parent: str
) -> DataFrame:
    """Child rows whose key is NULL or has no parent; works for composite keys too."""
    lost = _orphans(t.table(child), columns, t.table(parent))
    return _one(lost, child, _rule_of((child, columns, parent)), F.sum("count"))


ForeignKey = tuple[str, Sequence[str], str]  # child table, its columns, parent table
SINGLE = tuple(fk for fk in model.FOREIGN_KEYS if len(fk[1]) == 1)


def _orphan_values(t: RetailTables, keys: Sequence[ForeignKey]) -> DataFrame:
    """(no, value, count) of the values without a parent row, for single-column keys by number.

    A child is read once for all its keys: its rows become (relationship, value) pairs, which are
    counted before they leave their task, and all pairs meet all parents in one anti-join.
    """
    pairs, parents = [], []
    for child in dict.fromkeys(c for c, _, _ in keys):
        own = [
            F.struct(F.lit(no).alias("no"), F.col(columns[0]).cast("string").alias("value"))
            for no, (c, columns, _) in enumerate(keys)
            if c == child
        ]
        pairs.append(t.table(child).select(F.inline(F.array(*own))).groupBy("no", "value").count())
    for no, (_, columns, parent) in enumerate(keys):
        parents.append(t.table(parent).select(F.lit(no).alias("no"), F.col(columns[0]).cast("string").alias("value")))
    return union_all(pairs).join(union_all(parents), ["no", "value"], "left_anti")


def _rule_of(key: ForeignKey) -> str:
    return f"foreign_key:{'+'.join(key[1])}->{key[2]}"


def check_foreign_keys(t: RetailTables, keys: Sequence[ForeignKey] = SINGLE) -> DataFrame:
    """Several single-column relationships at once, by default all five."""
    lost = _orphan_values(t, keys).groupBy("no").agg(F.sum("count").alias("count"))
    found = [F.coalesce(F.sum(F.when(F.col("no") == no, F.col("count"))), F.lit(0)) for no in range(len(keys))]
    rows = [
        F.struct(F.lit(key[0]).alias("table"), F.lit(_rule_of(key)).alias("rule"), F.col(f"n{no}").alias("violations"))
        for no, key in enumerate(keys)
    ]
    one = lost.agg(*[c.cast("long").alias(f"n{no}") for no, c in enumerate(found)])
    return one.select(F.inline(F.array(*rows)))


def check_composite_foreign_key(t: RetailTables) -> DataFrame:
    return check_foreign_key(t, "returns", ("order_id", "product_id"), "sales")


def foreign_key_report(t: RetailTables, limit: int = 5) -> DataFrame:
    """The most frequent orphan key values, ``limit`` per relationship.

    ``orphan_values`` and ``orphan_rows`` are the totals of the relationship, so a cut shows.
    """
    lost = [_orphan_values(t, SINGLE)]
    keys = [*SINGLE, *[fk for fk in model.FOREIGN_KEYS if fk not in SINGLE]]
    for no, (child, columns, parent) in list(enumerate(keys))[len(SINGLE) :]:
        value = F.concat_ws("+", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns])
        composite = _orphans(t.table(child), columns, t.table(parent))
        lost.append(composite.select(F.lit(no).alias("no"), value.alias("value"), "count"))
    every = union_all(lost).withColumn("value", F.coalesce("value", F.lit("NULL")))
    totals = every.groupBy("no").agg(F.count(F.lit(1)).alias("orphan_values"), F.sum("count").alias("orphan_rows"))
    frequent = Window.partitionBy("no").orderBy(F.desc("count"), "value")  # cut to the limit in every task first
    top = every.withColumn("place", F.row_number().over(frequent)).filter(F.col("place") <= limit)
    names = lambda at: F.element_at(F.array(*[F.lit(k[at]) for k in keys]), F.col("no") + 1)
    return top.join(totals, "no").select(
        names(0).alias("table"), names(2).alias("parent"), "value",
        F.col("count").alias("row_count"), "orphan_values", "orphan_rows",
    )


def derived_rules(atol: float = 0.01) -> dict[str, Column]:
    quantity = F.col("quantity").cast("decimal(10,0)")
    gross = F.round(quantity * F.col("unit_price"), 2)
    net = F.round(gross.cast(model.MONEY) * (F.lit(1).cast("decimal(1,0)") - F.col("discount_pct")), 2)
    cost = F.round(quantity * F.col("unit_cost"), 2)
    profit = net - cost
    expected = {"gross_revenue": gross, "net_revenue": net, "cost": cost, "profit": profit}
    return {
        f"{name}_recomputes": close_to(F.col(name), value, atol) for name, value in expected.items()
    }


def check_derived_measures(t: RetailTables, atol: float = 0.01) -> DataFrame:
    return check_rules(t.sales, "sales", derived_rules(atol))


def balance_rule() -> dict[str, Column]:
    moved = F.col("opening_stock") + F.col("units_received") - F.col("units_sold")
    return {"balance": moved == F.col("closing_stock")}


def check_inventory_balance(t: RetailTables) -> DataFrame:
    return check_rules(t.inventory, "inventory", balance_rule())


def check_returns_vs_sales(t: RetailTables, lines: DataFrame | None = None) -> DataFrame:
    """Return date parses, is not before its order, and quantity does not exceed the sale.

    Equal returns are counted first, so many returns of one sale line join as few rows.
    """
    key = ["order_id", "product_id"]
    sold = (lines if lines is not None else sale_lines_by_key(t)).drop("count")
    returned = t.returns.groupBy(*key, "return_date", "quantity_returned").count()
    return check_rules(
        returned.join(sold, key, "left"),
        "returns",
        {
            "return_date_parses": F.col("return_date").isNotNull(),
            "not_before_order": F.col("return_date") >= F.col("order_date"),
            "within_quantity_sold": F.col("quantity_returned") <= F.col("quantity"),
        },
        weight="count",
    )


def _date_rule(df: DataFrame, column: str) -> dict[str, Column]:
    typed = dict(df.dtypes)[column] == "date"
    parsed = F.col(column) if typed else to_date(column)
    return {f"date_parses:{column}": parsed.isNotNull()}


def check_dates(t: RetailTables) -> DataFrame:
    return union_all(
        [
            check_rules(t.table(name), name, _date_rule(t.table(name), c))
            for name, c in model.DATE_COLUMNS.items()
        ]
    )


def declared_rules(
    segments: Sequence[str] = model.SEGMENTS, store_types: Sequence[str] = model.STORE_TYPES
) -> dict[str, dict[str, Column]]:
    """The CHECK clauses of the table declarations."""
    c = F.col
    return {
        "customers": {"check:customer_segment": c("customer_segment").isin(*segments)},
        "products": {
            "check:unit_cost": c("unit_cost") >= 0,
            "check:unit_price": c("unit_price") >= 0,
        },
        "stores": {"check:store_type": c("store_type").isin(*store_types)},
        "sales": {
            "check:quantity": c("quantity") > 0,
            "check:unit_price": c("unit_price") >= 0,
            "check:discount_pct": c("discount_pct").between(0, 1),
            "check:unit_cost": c("unit_cost") >= 0,
        },
        "inventory": {f"check:{name}": c(name) >= 0 for name in model.STOCK_COLUMNS},
        "returns": {"check:quantity_returned": c("quantity_returned") > 0},
    }


def check_declared_constraints(
    t: RetailTables,
    segments: Sequence[str] = model.SEGMENTS,
    store_types: Sequence[str] = model.STORE_TYPES,
) -> DataFrame:
    """CHECK and NOT NULL of every table, one pass per table."""
    parts = []
    for name, checks in declared_rules(segments, store_types).items():
        not_null = {
            f"not_null:{c}": F.col(c).isNotNull() for c in model.CLEAN_SCHEMAS[name].names
        }
        # SQL CHECK accepts NULL; NOT NULL reports it.
        lenient = {rule: F.coalesce(cond, F.lit(True)) for rule, cond in checks.items()}
        parts.append(check_rules(t.table(name), name, {**lenient, **not_null}))
    return union_all(parts)


def reconcile_row_counts(source: RetailTables, loaded: RetailTables) -> DataFrame:
    """(table, source_rows, loaded_rows, matches) for every table of the source star."""

    def counts(t: RetailTables, side: str) -> DataFrame:
        return union_all(
            [
                t.table(n).agg(F.count(F.lit(1)).alias(side)).select(F.lit(n).alias("table"), side)
                for n in source.names()
            ]
        )

    both = counts(source, "source_rows").join(counts(loaded, "loaded_rows"), "table")
    return both.withColumn("matches", F.col("source_rows") == F.col("loaded_rows"))


def reconcile_totals(t: RetailTables) -> DataFrame:
    """Company totals from the sales lines against the same totals via two dimensions."""

    sums = {
        "revenue": money_sum("net_revenue"),
        "profit": money_sum("profit"),
        "units_sold": F.sum("quantity"),
    }
    named = [c.alias(n) for n, c in sums.items()]

    def report(totals: DataFrame, path: str) -> DataFrame:
        return totals.select(
            F.lit(path).alias("path"), dbl("revenue").alias("revenue"), dbl("profit").alias("profit"), "units_sold"
        )

    def via(dim: DataFrame, key: str) -> DataFrame:
        per_key = t.sales.groupBy(key).agg(*named).join(dim.select(key), key)
        return per_key.agg(*[F.sum(n).alias(n) for n in sums])

    return union_all(
        [
            report(t.sales.agg(*named), "sales"),
            report(via(t.products, "product_id"), "products"),
            report(via(t.stores, "store_id"), "stores"),
        ]
    )


def _answerable(df: DataFrame, rules: Mapping[str, Column]) -> dict[str, Column]:
    """The rules whose columns the table has; what it lacks is reported on its own."""
    out = {}
    for name, rule in rules.items():
        try:
            df.select(rule)
        except AnalysisException as error:
            if error.getCondition() not in ("UNRESOLVED_COLUMN.WITH_SUGGESTION", "UNRESOLVED_COLUMN.WITHOUT_SUGGESTION"):
                raise
        else:
            out[name] = rule
    return out


def validate_all(
    t: RetailTables,
    raise_on_failure: bool = False,
    atol: float = 0.01,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
) -> DataFrame:
    """Every rule over the whole star as one report.

    Rules that read one table only are merged into a single pass over it. Missing columns are
    violations themselves (``required_columns``) and silence only the rules that need them.
    ``row_count`` rows say how large each table is. The sale lines are aggregated by key once,
    and with the default ``keep`` written to shared storage while the report is put together.
    """
    has = {name: set(t.table(name).columns) for name in model.TABLES}
    rules: dict[str, dict[str, Column]] = {}
    for name in model.TABLES:
        present = [c for c in model.CLEAN_SCHEMAS[name].names if c in has[name]]
        rules[name] = {f"not_null:{c}": F.col(c).isNotNull() for c in present}
        if model.DATE_COLUMNS.get(name) in has[name]:
            rules[name].update(_date_rule(t.table(name), model.DATE_COLUMNS[name]))
    for name, extra in range_rules().items():
        rules[name].update(extra)
    rules["sales"].update(derived_rules(atol))
    rules["inventory"].update(balance_rule())

    def keyed(name: str, columns: Sequence[str]) -> bool:
        return set(columns) <= has[name]

    line = [*model.PRIMARY_KEYS["sales"], "order_date", "quantity"]
    lines = keep(sale_lines_by_key(t), "sale_lines_by_key") if keyed("sales", line) else None
    parts = [check_required_columns(t.table("sales").sparkSession, t)]
    parts += [
        check_rules(t.table(n), n, _answerable(t.table(n), named), row_count=True) for n, named in rules.items()
    ]
    parts += [
        check_primary_key(t.table(n), n, lines if n == "sales" else None)
        for n in model.TABLES
        if keyed(n, model.PRIMARY_KEYS[n])
    ]
    known = [fk for fk in model.FOREIGN_KEYS if keyed(fk[0], fk[1]) and keyed(fk[2], fk[1])]
    single = [fk for fk in known if fk in SINGLE]
    if single:
        parts.append(check_foreign_keys(t, single))
    for child, columns, parent in known:
        if (child, columns, parent) not in SINGLE:
            star = t.replace(sales=lines) if parent == "sales" and lines is not None else t
            parts.append(check_foreign_key(star, child, columns, parent))
    if lines is not None and keyed("returns", ["order_id", "product_id", "return_date", "quantity_returned"]):
        parts.append(check_returns_vs_sales(t, lines))
    report = union_all(parts)
    if raise_on_failure:
        # At most one row per rule reaches the driver.
        broken = report.filter((F.col("violations") > 0) & (F.col("rule") != "row_count")).collect()
        if broken:
            rows = [f"  - {r['table']}: {r['rule']} ({r['violations']} rows)" for r in broken]
            raise ValidationError(f"{len(broken)} rule(s) broken:\n" + "\n".join(rows))
    return report
