"""Hand-made tables: a messy raw star with one row per defect, and a tiny typed star."""

from __future__ import annotations

import datetime
from decimal import Decimal

from tillwise import model
from tillwise.model import RetailTables

RAW = {
    "customers": [
        ("CUST0001", "maya o'brien-SINGH", " toronto ", "ON", "2022-09-14", "loyal"),
        ("CUST0002", None, "Montreal", "QC", "not-a-date", "Regular"),
        ("CUST0003", "Li Wei", "Vancouver", " B.C. ", "2021-02-30", "VIP"),
        ("CUST0004", "Ana", "Halifax", "ns", "2023-05-01", None),
        ("CUST0005", "Bo", "Atlantis", "Atlantis", "2023-05-01", "New"),  # unknown province
        ("CUST0006", "Cy", "  ", "ON", "2023-05-01", "New"),  # blank city
        ("CUST7", "Di", "Toronto", "ON", "2023-05-01", "New"),  # malformed id
        ("CUST0008\n", "Ed", "Toronto", "ontario", "2023-05-01", "New"),  # newline is stripped
        ("CUST0001", "maya o'brien-SINGH", " toronto ", "ON", "2022-09-14", "loyal"),  # exact copy
        ("CUST0004", "Ana B", "Halifax", "ns", "2023-05-01", None),  # same key, other row
    ],
    "products": [
        ("PROD001", "audio item", "electronics ", "audio", "10.00", "12.50", "Supplier A"),
        ("PROD002", "Milk", "Grocery", "Dairy", "1.10", "2.00", None),
        ("PROD003", "Desk", "Office", "Furniture", "40", "80", "Supplier B"),
        ("PROD004", "Ghost", "Mystery", "None such", "1", "2", "Supplier B"),  # unknown category
        ("PROD005", "Lamp", "Home", "Light", "abc", "2", "Supplier B"),  # unparsable cost
        ("PROD006", "Rug", "Home", "Floor", "5", "-2", "Supplier B"),  # negative price
        ("PROD007", "Never Sold", "Home", "Floor", "5", "9", "Supplier B"),
    ],
    "stores": [
        ("STORE01", "toronto centre", "Toronto", "on", "urban", "2015-11-12"),
        ("STORE02", "Halifax Mall", "Halifax", "Nova Scotia", "Suburban", "13/40/2020"),
        ("STORE03", "Kiosk", "Toronto", "ON", "Kiosk", "2019-01-01"),  # unknown type
    ],
    "sales": [
        ("ORD000001", "2024-01-05", "CUST0001", "STORE01", "PROD001", "2", "12.50", "0.10"),
        ("ORD000001", "2024-01-05", "CUST0001", "STORE01", "PROD002", "1", "1.25", "0.10"),  # half cent
        ("ORD000002", "2024-01-09", None, "STORE02", "PROD002", "3", "2.00", "0"),  # no customer
        ("ORD000003", "2024-02-01", "CUST9999", "STORE02", " prod003 ", "1", None, "0.2"),  # orphan, padded, no price
        ("ORD000004", "invalid-date", "CUST0001", "STORE01", "PROD001", "1", "12.50", "0"),
        ("ORD000005", "2024-02-02", "CUST0001", "STORE01", "PROD001", "-1", "12.50", "0"),
        ("ORD000006", "2024-02-02", "CUST0001", "STORE01", "PROD001", "1", "12.50", "1.5"),
        ("ORD000007", "2024-02-02", "CUST0001", "STORE03", "PROD001", "1", "12.50", "0"),  # store dropped
        ("ORD000008", "2024-02-02", "CUST0001", "STORE01", "PROD999", "1", "12.50", "0"),
        ("ORD000009", "2024-02-02", "CUST0001", "STORE01", "PROD001", "1.5", "12.50", "0"),
        ("ORD000010", "2024-04-30", "CUST0001", "STORE01", "PROD001", "4.0", "12.50", "0"),
        ("ORD000010", "2024-04-30", "CUST0001", "STORE01", "PROD001", "4.0", "12.50", "0"),  # exact copy
        ("ORD000010", "2024-04-30", "CUST0001", "STORE01", "PROD001", "5", "12.50", "0"),  # key copy
        ("ORDER11", "2024-02-02", "CUST0001", "STORE01", "PROD001", "1", "12.50", "0"),
    ],
    "inventory": [
        ("2024-01-31", "STORE01", "PROD001", "10", "5", "2", "13", "4"),
        ("2024-01-31", "STORE02", " prod002 ", "3", "0", "3", "-5", "4"),  # repaired to 0
        ("2024-02-29", "STORE01", "PROD001", "13", "0", "3", None, "4"),  # missing closing
        ("2024-02-29", "STORE02", "PROD002", "0", "8", "1", "9", "4"),  # off balance, repaired to 7
        ("2025-99-99", "STORE01", "PROD001", "1", "1", "1", "1", "1"),
        ("2024-03-31", None, "PROD001", "1", "1", "1", "1", "1"),
        ("2024-03-31", "STORE01", "PROD001", "1", "0", "3", "2", "1"),  # cannot be repaired, kept
        ("2024-03-31", "STORE01", "PROD002", "1", "0", "3", "-2", "1"),  # cannot be repaired, dropped
    ],
    "returns": [
        ("RET000001", "ORD000001", "PROD001", "2024-01-20", "1", None),
        ("RET000002", "ORD000001", "PROD001", "2024-01-21", "2", " defective "),  # with the first: 3 > 2 sold
        ("RET000003", "ORD000001", "PROD001", "2024-01-01", "1", "Damaged"),  # before the order
        ("RET000004", "ORD999999", "PROD001", "2024-02-01", "1", "Damaged"),
        ("RET000005", "ORD000002", "PROD002", "2024-02-01", "4", "Damaged"),  # more than sold
        ("RET000006", "ORD000002", "PROD002", "2024-02-01", "0", "Damaged"),
        ("RETURN7", "ORD000002", "PROD002", "2024-02-01", "1", "Damaged"),
        ("RET000008", "ORD000003", "PROD003", "2024-02-01", "1", "wrong item"),
    ],
}


def raw_tables(spark):
    return {
        name: spark.createDataFrame(
            rows, ", ".join(f"{c} string" for c in model.RAW_COLUMNS[name])
        )
        for name, rows in RAW.items()
    }


def d(text: str) -> datetime.date:
    return datetime.date.fromisoformat(text)


def money(x) -> Decimal:
    return Decimal(str(x))


def sale(order, date, customer, store, product, quantity, price, cost, discount="0"):
    gross = money(price) * quantity
    net = (gross * (1 - money(discount))).quantize(Decimal("0.01"), rounding="ROUND_HALF_UP")
    total = money(cost) * quantity
    return (
        order, d(date), customer, store, product, quantity, money(price), money(discount),
        money(cost), gross, net, total, net - total,
    )


PRODUCTS = [
    ("P1", "One", "Home", "A", money(4), money(10), "S1"),
    ("P2", "Two", "Home", "A", money(5), money(10), "S1"),
    ("P3", "Three", "Office", "B", money(1), money(2), "S2"),
    ("P4", "Unsold", "Office", "B", money(1), money(2), "S2"),
]
CUSTOMERS = [
    ("C1", "Ann", "Toronto", "Ontario", d("2020-01-01"), "New"),
    ("C2", "Bob", "Toronto", "Ontario", d("2020-01-01"), "Loyal"),
    ("CUST_UNKNOWN", "Unknown Customer", "Unknown", "Ontario", d("2023-01-01"), "New"),
]
STORES = [
    ("S1", "First", "Toronto", "Ontario", "Urban", d("2015-01-01")),
    ("S2", "Second", "Montreal", "Quebec", "Suburban", d("2016-01-01")),
]
SALES = [
    sale("O1", "2023-01-10", "C1", "S1", "P1", 1, 10, 4),
    sale("O1", "2023-01-10", "C1", "S1", "P2", 1, 10, 5),
    sale("O2", "2023-01-20", "C2", "S2", "P3", 5, 2, 1, "0.10"),
    sale("O3", "2023-03-05", "C1", "S1", "P1", 2, 10, 4, "0.25"),  # no February
    sale("O4", "2023-03-06", "CUST_UNKNOWN", "S2", "P2", 1, 10, 5),
    sale("O5", "2024-01-07", "C1", "S2", "P3", 10, 2, 1),
]
INVENTORY = [
    (d("2023-01-31"), "S1", "P1", 5, 0, 1, 4, 2),
    (d("2023-01-31"), "S2", "P3", 5, 0, 5, 0, 2),
    (d("2023-03-31"), "S1", "P1", 4, 0, 2, 2, 3),
    (d("2023-03-31"), "S2", "P3", 0, 4, 0, 4, 2),
]
RETURNS = [
    ("R1", "O1", "P1", d("2023-02-01"), 1, "Damaged"),
    ("R2", "O2", "P3", d("2023-03-01"), 2, "Defective"),
]


def tiny_star(spark) -> RetailTables:
    data = {
        "customers": CUSTOMERS, "products": PRODUCTS, "stores": STORES,
        "sales": SALES, "inventory": INVENTORY, "returns": RETURNS,
    }
    return RetailTables(
        **{n: spark.createDataFrame(rows, model.CLEAN_SCHEMAS[n]) for n, rows in data.items()}
    )
