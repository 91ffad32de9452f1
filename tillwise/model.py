"""The retail star: six tables, their keys, types and controlled values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

TABLES = ("customers", "products", "stores", "sales", "inventory", "returns")

PRICE = T.DecimalType(12, 2)
MONEY = T.DecimalType(14, 2)
RATE = T.DecimalType(8, 6)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_S, _D, _L = T.StringType(), T.DateType(), T.LongType()

# Column names, keys and controlled values below are fixed values of the data model.
CLEAN_SCHEMAS = {
    "customers": _schema(
        customer_id=_S, customer_name=_S, city=_S, province=_S, signup_date=_D, customer_segment=_S
    ),
    "products": _schema(
        product_id=_S, product_name=_S, category=_S, subcategory=_S,
        unit_cost=PRICE, unit_price=PRICE, supplier=_S,
    ),
    "stores": _schema(
        store_id=_S, store_name=_S, city=_S, province=_S, store_type=_S, opening_date=_D
    ),
    "sales": _schema(
        order_id=_S, order_date=_D, customer_id=_S, store_id=_S, product_id=_S, quantity=_L,
        unit_price=PRICE, discount_pct=RATE, unit_cost=PRICE, gross_revenue=MONEY,
        net_revenue=MONEY, cost=MONEY, profit=MONEY,
    ),
    "inventory": _schema(
        date=_D, store_id=_S, product_id=_S, opening_stock=_L, units_received=_L,
        units_sold=_L, closing_stock=_L, reorder_level=_L,
    ),
    "returns": _schema(
        return_id=_S, order_id=_S, product_id=_S, return_date=_D, quantity_returned=_L,
        return_reason=_S,
    ),
}

DERIVED_SALES = ("unit_cost", "gross_revenue", "net_revenue", "cost", "profit")
RAW_COLUMNS = {
    name: [c for c in schema.names if name != "sales" or c not in DERIVED_SALES]
    for name, schema in CLEAN_SCHEMAS.items()
}
STOCK_COLUMNS = ("opening_stock", "units_received", "units_sold", "closing_stock", "reorder_level")

PRIMARY_KEYS = {
    "customers": ["customer_id"],
    "products": ["product_id"],
    "stores": ["store_id"],
    "sales": ["order_id", "product_id"],
    "inventory": ["date", "store_id", "product_id"],
    "returns": ["return_id"],
}

# (child table, child columns, parent table); parent columns carry the same names.
FOREIGN_KEYS = (
    ("sales", ("customer_id",), "customers"),
    ("sales", ("product_id",), "products"),
    ("sales", ("store_id",), "stores"),
    ("inventory", ("product_id",), "products"),
    ("inventory", ("store_id",), "stores"),
    ("returns", ("order_id", "product_id"), "sales"),
)

DATE_COLUMNS = {
    "customers": "signup_date",
    "stores": "opening_date",
    "sales": "order_date",
    "inventory": "date",
    "returns": "return_date",
}

CATEGORIES = ("Electronics", "Grocery", "Home", "Personal Care", "Clothing", "Office")
SEGMENTS = ("New", "Regular", "Loyal")
STORE_TYPES = ("Urban", "Suburban")

# Prefix and least width; longer numbers are valid, so growing tables lose nothing.
ID_PATTERNS = {
    "customer_id": r"CUST\d{4,}",
    "product_id": r"PROD\d{3,}",
    "store_id": r"STORE\d{2,}",
    "order_id": r"ORD\d{6,}",
    "return_id": r"RET\d{6,}",
}
# The widths to the digit, for those who want anything else dropped.
EXACT_ID_PATTERNS = {
    "customer_id": r"CUST\d{4}",
    "product_id": r"PROD\d{3}",
    "store_id": r"STORE\d{2}",
    "order_id": r"ORD\d{6}",
    "return_id": r"RET\d{6}",
}

PROVINCES = {
    "ab": "Alberta",
    "alberta": "Alberta",
    "b.c.": "British Columbia",
    "bc": "British Columbia",
    "british columbia": "British Columbia",
    "manitoba": "Manitoba",
    "mb": "Manitoba",
    "nova scotia": "Nova Scotia",
    "ns": "Nova Scotia",
    "on": "Ontario",
    "ont": "Ontario",
    "ont.": "Ontario",
    "ontario": "Ontario",
    "qc": "Quebec",
    "quebec": "Quebec",
    "québec": "Quebec",
    "saskatchewan": "Saskatchewan",
    "sk": "Saskatchewan",
}

UNKNOWN_CUSTOMER = "CUST_UNKNOWN"
UNKNOWN_CUSTOMER_ROW = {
    "customer_id": UNKNOWN_CUSTOMER,
    "customer_name": "Unknown Customer",
    "city": "Unknown",
    "province": "Ontario",
    "signup_date": "2023-01-01",
    "customer_segment": "New",
}
DEFAULTS = {
    "segment": "Regular",
    "signup_date": "2023-01-01",
    "supplier": "Unknown Supplier",
    "opening_date": "2018-01-01",
    "return_reason": "Unknown",
}


class RetailTables:
    """The six tables of one star.

    Each table is a DataFrame or a zero-argument callable returning one, so a query
    that touches two tables never builds the other four.
    """

    def __init__(
        self,
        *,
        unknown_customer: object = UNKNOWN_CUSTOMER,
        **tables: DataFrame | Callable[[], DataFrame],
    ) -> None:
        stray = sorted(set(tables) - set(TABLES))
        if stray:
            raise ValueError(f"not tables of the star: {', '.join(stray)}")
        self.unknown_customer = unknown_customer
        self._tables = dict(tables)
        self._keep: Callable[[DataFrame, str], DataFrame] | None = None
        self._shared: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._tables:
            raise KeyError(f"this star has no table {name}")
        table = self._tables[name]
        if not isinstance(table, DataFrame):
            table = self._tables[name] = table()
        return table

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def names(self) -> list[str]:
        return [name for name in TABLES if name in self._tables]

    def replace(self, **tables: DataFrame | Callable[[], DataFrame]) -> RetailTables:
        """Same star with some tables swapped."""
        return RetailTables(unknown_customer=self.unknown_customer, **{**self._tables, **tables})

    def sharing(self, keep: Callable[[DataFrame, str], DataFrame]) -> RetailTables:
        """Same star for several analyses: totals that more than one asks for are written once by ``keep``."""
        out = self.replace()
        out._keep = keep
        return out

    @property
    def shares(self) -> bool:
        return self._keep is not None

    def shared(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """What ``build`` gives, kept under ``name`` if this star shares."""
        if self._keep is None:
            return build()
        if name not in self._shared:
            self._shared[name] = self._keep(build(), name)
        return self._shared[name]
