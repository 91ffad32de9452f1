"""Filtering a whole star by dimension values and dates."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.relations import union_all
from tillwise.model import RetailTables

# dimension table -> its key; fact table -> its date
KEYS = {"products": "product_id", "stores": "store_id", "customers": "customer_id"}
FACT_DATE = {"sales": "order_date", "inventory": "date", "returns": "return_date"}


def slice_star(
    t: RetailTables,
    date_from: datetime.date | str | None = None,
    date_to: datetime.date | str | None = None,
    province: str | None = None,
    store_id: object | None = None,
    category: str | None = None,
    subcategory: str | None = None,
    supplier: str | None = None,
    customer_segment: str | None = None,
) -> RetailTables:
    """Filter dimensions, and through them the facts they relate to.

    Province means the store's. Plain returns know neither store nor customer, so those
    filters reach them only after :func:`tillwise.plans.report.enrich_returns`.
    """
    picks = {
        "stores": {"province": province, "store_id": store_id},
        "products": {"category": category, "subcategory": subcategory, "supplier": supplier},
        "customers": {"customer_segment": customer_segment},
    }
    changed: dict[str, DataFrame] = {}
    for dim, wanted in picks.items():
        wanted = {c: v for c, v in wanted.items() if v is not None}
        if wanted:
            rows = t.table(dim)
            for c, v in wanted.items():
                rows = rows.filter(F.col(c) == F.lit(v))
            changed[dim] = rows
    for fact, date in FACT_DATE.items():
        rows = t.table(fact)
        if date_from is not None:
            rows = rows.filter(F.col(date) >= F.lit(date_from).cast("date"))
            if "month" in rows.columns:  # prunes partitions
                rows = rows.filter(F.col("month") >= F.lit(str(date_from)[:7]))
        if date_to is not None:
            rows = rows.filter(F.col(date) <= F.lit(date_to).cast("date"))
            if "month" in rows.columns:
                rows = rows.filter(F.col("month") <= F.lit(str(date_to)[:7]))
        for dim, key in KEYS.items():
            if dim in changed and key in rows.columns:
                rows = rows.join(changed[dim].select(key), key, "left_semi")
        changed[fact] = rows
    return t.replace(**changed)


def slice_totals(t: RetailTables) -> DataFrame:
    """Rows and units of each fact, one row per fact."""
    units = {"sales": "quantity", "inventory": "units_sold", "returns": "quantity_returned"}
    return union_all(
        [
            t.table(fact)
            .agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum(c), F.lit(0)).alias("units"))
            .select(F.lit(fact).alias("fact"), "row_count", "units")
            for fact, c in units.items()
        ]
    )
