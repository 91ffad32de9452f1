"""Messy variants of the star, written once as expressions both engines understand.

``RAW`` is the all-text input of the cleaning operators; ``SUSPECT`` is a typed star that
breaks validation rules. Every defect is a fixed share of the keys, over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tillwise.model import RetailTables

# Fixed values of the check data: the default id formats, longer numbers included, and the
# categories as title-cased part types.
PATTERNS = {
    "customer_id": r"CUST\d{4,}",
    "product_id": r"PROD\d{3,}",
    "store_id": r"STORE\d{2,}",
    "order_id": r"ORD\d{6,}",
    "return_id": r"RET\d{6,}",
}
CATEGORIES = ("Economy", "Large", "Medium", "Promo", "Small", "Standard")

_PROVINCE = """CASE {k} % 8 WHEN 0 THEN 'ON' WHEN 1 THEN 'ontario' WHEN 2 THEN ' B.C. '
  WHEN 3 THEN 'QC' WHEN 4 THEN 'Québec' WHEN 5 THEN 'nova scotia' WHEN 6 THEN 'sk'
  ELSE CASE WHEN {k} % 5 = 0 THEN 'Atlantis' ELSE 'Alberta' END END"""


def _padded(column: str, width: int) -> str:
    """The number as text of at least ``width`` digits."""
    text = f"CAST({column} AS STRING)"
    return f"repeat('0', greatest({width} - length({text}), 0)) || {text}"


_CUSTOMER, _STORE = _padded("customer_id", 4), _padded("store_id", 2)
_PRODUCT, _ORDER = _padded("product_id", 3), _padded("order_id", 6)
_SP = "(store_id + product_id)"
_OP = "(order_id + product_id)"
_PROD = f"'PROD' || {_PRODUCT}"

# table -> (columns, [(condition for an extra copy, columns replaced in it)])
RAW: dict[str, tuple[dict[str, str], list[tuple[str, dict[str, str]]]]] = {
    "customers": (
        {
            "customer_id": f"""CASE WHEN customer_id % 89 = 0 THEN ' cust' || {_CUSTOMER} || ' '
                              ELSE 'CUST' || {_CUSTOMER} END""",
            "customer_name": """CASE WHEN customer_id % 97 = 0 THEN NULL
                WHEN customer_id % 101 = 0 THEN '   '
                WHEN customer_id % 7 = 1 THEN 'o' || chr(39) || 'NEIL anne-marie 3rd ' || CAST(customer_id AS STRING)
                ELSE customer_name END""",
            "city": """CASE WHEN customer_id % 41 = 0 THEN NULL
                WHEN customer_id % 13 = 0 THEN '  ' || lower(city) || ' ' ELSE city END""",
            "province": _PROVINCE.format(k="customer_id"),
            "signup_date": """CASE WHEN customer_id % 61 = 0 THEN 'not-a-date'
                WHEN customer_id % 67 = 0 THEN '2021-02-30'
                WHEN customer_id % 71 = 0 THEN NULL ELSE CAST(signup_date AS STRING) END""",
            "customer_segment": """CASE customer_id % 4 WHEN 0 THEN 'new' WHEN 1 THEN ' LOYAL '
                WHEN 2 THEN 'Regular' ELSE customer_segment END""",
        },
        [("customer_id % 157 = 0", {}), ("customer_id % 163 = 0", {"city": "'Elsewhere'"})],
    ),
    "products": (
        {
            "product_id": _PROD,
            "product_name": "CASE WHEN product_id % 79 = 0 THEN NULL ELSE product_name END",
            "category": """CASE WHEN product_id % 13 = 0 THEN lower(category) || ' '
                WHEN product_id % 113 = 0 THEN 'Mystery' ELSE category END""",
            "subcategory": "subcategory",
            "unit_cost": """CASE WHEN product_id % 83 = 0 THEN 'abc' ELSE CAST(unit_cost AS STRING) END""",
            "unit_price": """CASE WHEN product_id % 101 = 0 THEN '-5.00' ELSE CAST(unit_price AS STRING) END""",
            "supplier": "CASE WHEN product_id % 37 = 0 THEN NULL ELSE supplier END",
        },
        [("product_id % 157 = 0", {})],
    ),
    "stores": (
        {
            "store_id": f"""CASE WHEN store_id % 19 = 0 THEN 'store' || {_STORE} || ' '
                           ELSE 'STORE' || {_STORE} END""",
            "store_name": "store_name",
            "city": "city",
            "province": _PROVINCE.format(k="store_id"),
            "store_type": """CASE WHEN store_id % 29 = 0 THEN 'Kiosk'
                WHEN store_id % 3 = 0 THEN ' ' || lower(store_type) ELSE store_type END""",
            "opening_date": """CASE WHEN store_id % 17 = 0 THEN '13/40/2020'
                ELSE CAST(opening_date AS STRING) END""",
        },
        [("store_id % 31 = 0", {})],
    ),
    "sales": (
        {
            "order_id": f"'ORD' || {_ORDER}",
            "order_date": """CASE WHEN order_id % 97 = 0 THEN 'invalid-date'
                WHEN order_id % 103 = 0 THEN CAST(order_date AS STRING) || ' 00:00:00'
                WHEN order_id % 107 = 0 THEN CAST(order_date AS STRING) || 'T23:59:59.5Z'
                ELSE CAST(order_date AS STRING) END""",
            "customer_id": f"""CASE WHEN order_id % 67 = 0 THEN NULL
                WHEN order_id % 211 = 0 THEN 'CUST999999999'
                ELSE 'CUST' || {_CUSTOMER} END""",
            "store_id": f"'STORE' || {_STORE}",
            "product_id": f"""CASE WHEN {_OP} % 89 = 0 THEN ' prod' || {_PRODUCT} || ' '
                ELSE {_PROD} END""",
            "quantity": """CASE WHEN order_id % 101 = 0 THEN '-' || CAST(quantity AS STRING)
                WHEN order_id % 127 = 0 THEN CAST(quantity AS STRING) || '.5'
                WHEN order_id % 139 = 0 THEN CAST(quantity AS STRING) || '.0'
                ELSE CAST(quantity AS STRING) END""",
            "unit_price": """CASE WHEN product_id % 53 = 0 THEN NULL ELSE CAST(unit_price AS STRING) END""",
            "discount_pct": """CASE WHEN order_id % 131 = 0 THEN '1.5' ELSE CAST(discount_pct AS STRING) END""",
        },
        [("order_id % 157 = 0", {}), ("order_id % 149 = 0", {"quantity": "'99'"})],
    ),
    "inventory": (
        {
            "date": f"CASE WHEN {_SP} % 103 = 0 THEN '2025-99-99' ELSE CAST(date AS STRING) END",
            "store_id": f"""CASE WHEN {_SP} % 107 = 0 THEN NULL
                ELSE 'STORE' || {_STORE} END""",
            "product_id": f"""CASE WHEN {_SP} % 89 = 0 THEN ' prod' || {_PRODUCT} || ' '
                ELSE {_PROD} END""",
            "opening_stock": f"CASE WHEN {_SP} % 113 = 0 THEN '-4' ELSE CAST(opening_stock AS STRING) END",
            "units_received": "CAST(units_received AS STRING)",
            "units_sold": "CAST(units_sold AS STRING)",
            "closing_stock": f"""CASE WHEN {_SP} % 71 = 0 THEN '-5' WHEN {_SP} % 73 = 0 THEN NULL
                WHEN {_SP} % 79 = 0 THEN CAST(closing_stock + 3 AS STRING)
                ELSE CAST(closing_stock AS STRING) END""",
            "reorder_level": f"CASE WHEN {_SP} % 127 = 0 THEN 'many' ELSE CAST(reorder_level AS STRING) END",
        },
        [(f"{_SP} % 157 = 0", {})],
    ),
    "returns": (
        {
            "return_id": """CASE WHEN order_id % 53 = 0 THEN 'R-' ELSE 'RET' END
                || CAST(order_id * 1000000 + product_id AS STRING)""",
            "order_id": f"""CASE WHEN order_id % 31 = 0 THEN 'ORD999999999'
                ELSE 'ORD' || {_ORDER} END""",
            "product_id": f"CASE WHEN order_id % 37 = 0 THEN 'PROD999999999' ELSE {_PROD} END",
            "return_date": """CASE WHEN order_id % 29 = 0 THEN '1990-01-01'
                WHEN order_id % 59 = 0 THEN 'soon' ELSE CAST(return_date AS STRING) END""",
            "quantity_returned": """CASE WHEN order_id % 41 = 0 THEN '1000'
                WHEN order_id % 43 = 0 THEN '0' ELSE CAST(quantity_returned AS STRING) END""",
            "return_reason": """CASE WHEN order_id % 19 = 0 THEN NULL
                WHEN order_id % 23 = 0 THEN ' ' || lower(return_reason) || ' ' ELSE return_reason END""",
        },
        [("order_id % 47 = 0", {})],
    ),
}

SUSPECT: dict[str, tuple[dict[str, str], list[tuple[str, dict[str, str]]]]] = {
    "customers": (
        {
            "customer_id": "customer_id",
            "customer_name": "customer_name",
            "city": "CASE WHEN customer_id % 41 = 0 THEN NULL ELSE city END",
            "province": "province",
            "signup_date": "CASE WHEN customer_id % 71 = 0 THEN NULL ELSE signup_date END",
            "customer_segment": """CASE WHEN customer_id % 11 = 0 THEN 'Gold' WHEN customer_id % 2 = 0
                THEN 'New' ELSE 'Loyal' END""",
        },
        [("customer_id % 157 = 0", {})],
    ),
    "products": (
        {
            "product_id": "product_id",
            "product_name": "product_name",
            "category": "category",
            "subcategory": "subcategory",
            "unit_cost": "unit_cost",
            "unit_price": "CASE WHEN product_id % 101 = 0 THEN -unit_price ELSE unit_price END",
            "supplier": "CASE WHEN product_id % 37 = 0 THEN NULL ELSE supplier END",
        },
        [],
    ),
    "stores": (
        {
            "store_id": "store_id",
            "store_name": "store_name",
            "city": "city",
            "province": "province",
            "store_type": "CASE WHEN store_id % 29 = 0 THEN 'Kiosk' ELSE store_type END",
            "opening_date": "opening_date",
        },
        [],
    ),
    "sales": (
        {
            "order_id": "order_id",
            "order_date": "CASE WHEN order_id % 97 = 0 THEN NULL ELSE order_date END",
            "customer_id": """CASE WHEN order_id % 67 = 0 THEN NULL
                WHEN order_id % 211 = 0 THEN -1 ELSE customer_id END""",
            "store_id": "CASE WHEN order_id % 227 = 0 THEN -1 ELSE store_id END",
            "product_id": "CASE WHEN order_id % 223 = 0 THEN -1 ELSE product_id END",
            "quantity": "CASE WHEN order_id % 101 = 0 THEN -quantity ELSE quantity END",
            "unit_price": "unit_price",
            "discount_pct": "CASE WHEN order_id % 131 = 0 THEN 1.50 ELSE discount_pct END",
            "unit_cost": "unit_cost",
            "gross_revenue": "gross_revenue",
            "net_revenue": """CASE WHEN order_id % 229 = 0 THEN net_revenue + 5000.00
                WHEN order_id % 233 = 0 THEN net_revenue + 0.01 ELSE net_revenue END""",
            "cost": "cost",
            "profit": "CASE WHEN order_id % 239 = 0 THEN profit - 5000.00 ELSE profit END",
        },
        [("order_id % 157 = 0", {})],
    ),
    "inventory": (
        {
            "date": "date",
            "store_id": f"CASE WHEN {_SP} % 109 = 0 THEN -1 ELSE store_id END",
            "product_id": "product_id",
            "opening_stock": f"CASE WHEN {_SP} % 73 = 0 THEN NULL ELSE opening_stock END",
            "units_received": "units_received",
            "units_sold": "units_sold",
            "closing_stock": f"CASE WHEN {_SP} % 71 = 0 THEN -5 ELSE closing_stock END",
            "reorder_level": "reorder_level",
        },
        [(f"{_SP} % 157 = 0", {})],
    ),
    "returns": (
        {
            "return_id": "return_id",
            "order_id": "CASE WHEN order_id % 31 = 0 THEN -1 ELSE order_id END",
            "product_id": "product_id",
            "return_date": """CASE WHEN order_id % 29 = 0 THEN DATE '1990-01-01'
                WHEN order_id % 59 = 0 THEN NULL ELSE return_date END""",
            "quantity_returned": "CASE WHEN order_id % 41 = 0 THEN 1000 ELSE quantity_returned END",
            "return_reason": "return_reason",
        },
        [("order_id % 47 = 0", {})],
    ),
}


def _selects(spec) -> list[tuple[dict[str, str], str]]:
    columns, copies = spec
    return [(columns, "true")] + [({**columns, **changed}, where) for where, changed in copies]


def messy_frame(t: RetailTables, spec, name: str) -> DataFrame:
    """The Spark side of one messy table."""
    parts = [
        t.table(name).filter(where).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])
        for columns, where in _selects(spec[name])
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def messy_sql(spec, prefix: str) -> str:
    """CTEs ``<prefix>_<table>`` over the star."""
    ctes = []
    for name in spec:
        selects = [
            f"SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {name} WHERE {where}"
            for columns, where in _selects(spec[name])
        ]
        ctes.append(f"{prefix}_{name} AS ({' UNION ALL '.join(selects)})")
    return ",\n".join(ctes)
