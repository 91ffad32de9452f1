"""SQL for the cleaning operators over the messy tables."""

from __future__ import annotations

from tillcheck.defects import CATEGORIES, PATTERNS, RAW, messy_sql
from tillcheck.star import big, dbl, star_query
from tillwise.model import RAW_COLUMNS, STOCK_COLUMNS

RAW_CTES = messy_sql(RAW, "raw")
# What the province spellings of the messy data stand for.
PROVINCES = {
    "on": "Ontario",
    "ontario": "Ontario",
    "b.c.": "British Columbia",
    "qc": "Quebec",
    "québec": "Quebec",
    "nova scotia": "Nova Scotia",
    "sk": "Saskatchewan",
    "alberta": "Alberta",
}
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "stores": "store_id",
    "sales": "order_id, product_id",
    "inventory": "date, store_id, product_id",
    "returns": "return_id",
}


def _strip(x: str) -> str:
    return f"trim({x}, ' ' || chr(9) || chr(10) || chr(13))"


def _blank(x: str) -> str:
    return f"CASE WHEN {x} IN ('', 'Nan', 'NAN') THEN NULL ELSE {x} END"


def upper(x: str) -> str:
    return _blank(f"upper({_strip(x)})")


def title(x: str) -> str:
    runs = f"regexp_extract_all({_strip(x)}, '[A-Za-zé]+|[^A-Za-zé]+')"
    return _blank(
        f"array_to_string(list_transform({runs}, lambda w: upper(w[1]) || lower(w[2:])), '')"
    )


def province(x: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in PROVINCES.items())
    return f"CASE lower({_strip(x)}) {cases} END"


def date(x: str) -> str:
    form = r"\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?"
    return f"CASE WHEN regexp_full_match(trim({x}), '{form}') THEN TRY_CAST(substr(trim({x}), 1, 10) AS DATE) END"


def number(x: str, kind: str = "DOUBLE") -> str:
    return f"TRY_CAST(trim({x}) AS {kind})"


def match(x: str, column: str) -> str:
    return f"COALESCE(regexp_full_match({x}, '{PATTERNS[column]}'), false)"


def first(table: str) -> str:
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_COLUMNS[table])
    return (
        f"(SELECT * FROM raw_{table} "
        f"QUALIFY row_number() OVER (PARTITION BY {KEYS[table]} ORDER BY {order}) = 1)"
    )


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


CHECKED = f"""
{RAW_CTES},
chk_customers AS (
  SELECT *, {match('customer_id', 'customer_id')} AND city IS NOT NULL AND province IS NOT NULL AS valid
  FROM (SELECT {upper('customer_id')} AS customer_id,
          COALESCE({title('customer_name')},
                   'Unknown Customer ' || COALESCE({upper('customer_id')}, 'Record')) AS customer_name,
          {title('city')} AS city, {province('province')} AS province,
          COALESCE({date('signup_date')}, DATE '2023-01-01') AS signup_date,
          CASE WHEN {title('customer_segment')} IN ('New', 'Regular', 'Loyal')
               THEN {title('customer_segment')} ELSE 'Regular' END AS customer_segment
        FROM {first('customers')})),
cln_customers AS (
  SELECT * EXCLUDE (valid) FROM chk_customers WHERE valid
  UNION ALL SELECT 'CUST_UNKNOWN', 'Unknown Customer', 'Unknown', 'Ontario', DATE '2023-01-01', 'New'),
chk_products AS (
  SELECT *, COALESCE({match('product_id', 'product_id')} AND product_name IS NOT NULL
        AND category IN {_in(CATEGORIES)} AND subcategory IS NOT NULL
        AND unit_cost >= 0 AND unit_price >= 0, false) AS valid
  FROM (SELECT {upper('product_id')} AS product_id, {title('product_name')} AS product_name,
          {title('category')} AS category, {title('subcategory')} AS subcategory,
          CAST({number('unit_cost', 'DECIMAL(20,8)')} AS DECIMAL(12,2)) AS unit_cost,
          CAST({number('unit_price', 'DECIMAL(20,8)')} AS DECIMAL(12,2)) AS unit_price,
          COALESCE({title('supplier')}, 'Unknown Supplier') AS supplier
        FROM {first('products')})),
cln_products AS (SELECT * EXCLUDE (valid) FROM chk_products WHERE valid),
chk_stores AS (
  SELECT *, COALESCE({match('store_id', 'store_id')} AND store_name IS NOT NULL AND city IS NOT NULL
        AND province IS NOT NULL AND store_type IN ('Urban', 'Suburban'), false) AS valid
  FROM (SELECT {upper('store_id')} AS store_id, {title('store_name')} AS store_name,
          {title('city')} AS city, {province('province')} AS province,
          {title('store_type')} AS store_type,
          COALESCE({date('opening_date')}, DATE '2018-01-01') AS opening_date
        FROM {first('stores')})),
cln_stores AS (SELECT * EXCLUDE (valid) FROM chk_stores WHERE valid),
typ_sales AS (
  SELECT {upper('order_id')} AS order_id, {date('order_date')} AS order_date,
         {upper('customer_id')} AS raw_customer, {upper('store_id')} AS store_id,
         {upper('product_id')} AS product_id, {number('quantity')} AS quantity,
         {number('unit_price', 'DECIMAL(20,8)')} AS raw_price,
         {number('discount_pct', 'DECIMAL(20,10)')} AS discount_pct
  FROM {first('sales')}),
chk_sales AS (
  SELECT s.*, c.customer_id IS NULL AS to_unknown, COALESCE(c.customer_id, 'CUST_UNKNOWN') AS customer_id,
         COALESCE(s.raw_price, p.unit_price) AS unit_price, p.unit_cost AS unit_cost,
         COALESCE({match('order_id', 'order_id')} AND order_date IS NOT NULL AND t.store_id IS NOT NULL
           AND p.product_id IS NOT NULL AND quantity > 0 AND quantity = round(quantity)
           AND COALESCE(s.raw_price, p.unit_price) >= 0 AND discount_pct BETWEEN 0 AND 1, false) AS valid
  FROM typ_sales s LEFT JOIN cln_customers c ON s.raw_customer = c.customer_id
       LEFT JOIN cln_products p ON s.product_id = p.product_id
       LEFT JOIN cln_stores t ON s.store_id = t.store_id),
cln_sales AS (
  SELECT *, CAST(net_revenue - cost AS DECIMAL(14,2)) AS profit FROM (
    SELECT *, CAST(ROUND(gross_revenue * (1 - discount_pct), 2) AS DECIMAL(14,2)) AS net_revenue FROM (
      SELECT order_id, order_date, customer_id, store_id, product_id, CAST(quantity AS BIGINT) AS quantity,
             CAST(unit_price AS DECIMAL(12,2)) AS unit_price,
             CAST(discount_pct AS DECIMAL(9,6)) AS discount_pct, unit_cost,
             CAST(CAST(quantity AS DECIMAL(6,0)) * CAST(unit_price AS DECIMAL(12,2)) AS DECIMAL(14,2)) AS gross_revenue,
             CAST(CAST(quantity AS DECIMAL(6,0)) * unit_cost AS DECIMAL(14,2)) AS cost
      FROM chk_sales WHERE valid))),
chk_inventory AS (
  SELECT i.*, COALESCE(date IS NOT NULL AND t.store_id IS NOT NULL AND p.product_id IS NOT NULL
           AND opening_stock >= 0 AND units_received >= 0 AND units_sold >= 0
           AND closing_stock >= 0 AND reorder_level >= 0, false) AS valid
  FROM (SELECT * EXCLUDE (raw_closing), COALESCE(expected >= 0, false)
               AND (raw_closing IS NULL OR raw_closing < 0 OR raw_closing <> expected) AS repaired,
               CASE WHEN repaired THEN expected ELSE raw_closing END AS closing_stock
        FROM (SELECT *, opening_stock + units_received - units_sold AS expected
              FROM (SELECT {date('date')} AS date, {upper('store_id')} AS store_id,
                      {upper('product_id')} AS product_id, {number('opening_stock')} AS opening_stock,
                      {number('units_received')} AS units_received, {number('units_sold')} AS units_sold,
                      {number('closing_stock')} AS raw_closing, {number('reorder_level')} AS reorder_level
                    FROM {first('inventory')}))) i
       LEFT JOIN cln_products p ON i.product_id = p.product_id
       LEFT JOIN cln_stores t ON i.store_id = t.store_id),
cln_inventory AS (
  SELECT date, store_id, product_id, {', '.join(f'{big(c)} AS {c}' for c in STOCK_COLUMNS)}
  FROM chk_inventory WHERE valid),
chk_returns AS (
  SELECT r.*, COALESCE({match('return_id', 'return_id')} AND s.order_id IS NOT NULL
           AND r.return_date >= s.order_date AND quantity_returned > 0
           AND quantity_returned = round(quantity_returned)
           AND quantity_returned <= s.quantity, false) AS valid
  FROM (SELECT {upper('return_id')} AS return_id, {upper('order_id')} AS order_id,
          {upper('product_id')} AS product_id, {date('return_date')} AS return_date,
          {number('quantity_returned')} AS quantity_returned,
          COALESCE({title('return_reason')}, 'Unknown') AS return_reason
        FROM {first('returns')}) r
       LEFT JOIN cln_sales s ON r.order_id = s.order_id AND r.product_id = s.product_id),
cln_returns AS (
  SELECT * EXCLUDE (valid) REPLACE ({big('quantity_returned')} AS quantity_returned)
  FROM chk_returns WHERE valid)
"""

MONEY = ("unit_price", "unit_cost", "gross_revenue", "net_revenue", "cost", "profit", "discount_pct")


def _rows(table: str) -> str:
    money = {"sales": MONEY, "products": ("unit_price", "unit_cost")}.get(table, ())
    replaced = ", ".join(f"{dbl(c)} AS {c}" for c in money)
    return f"SELECT *{f' REPLACE ({replaced})' if money else ''} FROM cln_{table}"


def _missing(table: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", COUNT(*) FILTER ({c} IS NULL) AS missing FROM raw_{table}"
        for c in RAW_COLUMNS[table]
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE missing > 0"


def _summary(table: str) -> str:
    nulls = " + ".join(f"CAST({c} IS NULL AS INTEGER)" for c in RAW_COLUMNS[table])
    metrics = {
        "rows_before": f"(SELECT COUNT(*) FROM raw_{table})",
        "rows_after": f"(SELECT COUNT(*) FROM cln_{table})",
        "exact_duplicates_removed": f"(SELECT COUNT(*) FROM raw_{table})"
        f" - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{table}))",
        "primary_key_duplicates_removed": f"(SELECT COUNT(*) FROM (SELECT DISTINCT * FROM raw_{table}))"
        f" - (SELECT COUNT(*) FROM (SELECT DISTINCT {KEYS[table]} FROM raw_{table}))",
        "invalid_rows_removed": f"(SELECT COUNT(*) FROM chk_{table} WHERE NOT valid)",
        "missing_values_handled": f"(SELECT SUM({nulls}) FROM raw_{table})",
    }
    for c in RAW_COLUMNS[table]:
        metrics[f"missing_values:{c}"] = f"(SELECT COUNT(*) FROM raw_{table} WHERE {c} IS NULL)"
    if table == "sales":
        metrics["customer_ids_assigned_to_unknown"] = "(SELECT COUNT(*) FROM chk_sales WHERE to_unknown)"
    if table == "inventory":
        metrics["closing_balances_corrected"] = "(SELECT COUNT(*) FROM chk_inventory WHERE repaired)"
    return " UNION ALL ".join(
        f"SELECT '{table}' AS \"table\", '{m}' AS metric, {big(sql)} AS value"
        for m, sql in metrics.items()
    )


def clean_query(body: str) -> str:
    return star_query(body, CHECKED)


def all_cleaning() -> dict[str, str]:
    out = {f"clean_{t}": clean_query(_rows(t)) for t in KEYS}
    out["clean_all"] = clean_query(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM cln_{t}" for t in KEYS)
    )
    out["cleaning_summary"] = clean_query(" UNION ALL ".join(_summary(t) for t in KEYS))
    out["write_cleaning_summary"] = out["cleaning_summary"]
    out["count_missing"] = star_query(
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, * FROM ({_missing(t)})" for t in KEYS), RAW_CTES
    )
    out["drop_exact_duplicates"] = star_query(
        """SELECT product_id, COUNT(*) AS row_count FROM (SELECT DISTINCT * FROM raw_sales)
           GROUP BY product_id""",
        RAW_CTES,
    )
    out["dedupe_by_key"] = star_query(
        f"""SELECT order_id, product_id, quantity FROM {first('sales')}""", RAW_CTES
    )
    out["normalize_text"] = star_query(
        f"""SELECT customer_id AS raw_id, {upper('customer_id')} AS customer_id,
                   {title('customer_name')} AS customer_name, {title('city')} AS city
            FROM raw_customers""",
        RAW_CTES,
    )
    out["normalize_province"] = star_query(
        f"""SELECT province AS raw_province, {province('province')} AS province,
                   COUNT(*) AS row_count FROM raw_customers GROUP BY ALL""",
        RAW_CTES,
    )
    out["coerce_date"] = star_query(
        f"""SELECT {date('order_date')} AS order_date, COUNT(*) AS row_count
            FROM raw_sales GROUP BY ALL""",
        RAW_CTES,
    )
    out["coerce_numeric"] = star_query(
        f"""SELECT quantity AS raw_quantity, {number('quantity')} AS quantity,
                   COUNT(*) AS row_count FROM raw_sales GROUP BY ALL""",
        RAW_CTES,
    )
    out["fill_default"] = star_query(
        """SELECT COALESCE(supplier, 'Unknown Supplier') AS supplier, COUNT(*) AS row_count
           FROM raw_products GROUP BY ALL""",
        RAW_CTES,
    )
    out["domain_default"] = star_query(
        f"""SELECT customer_segment AS raw_segment,
                   CASE WHEN {title('customer_segment')} IN ('New', 'Regular', 'Loyal')
                        THEN {title('customer_segment')} ELSE 'Regular' END AS customer_segment,
                   COUNT(*) AS row_count FROM raw_customers GROUP BY ALL""",
        RAW_CTES,
    )
    out["impute_from_dim"] = clean_query(
        f"""SELECT s.product_id, COUNT(*) AS row_count,
                   {dbl('SUM(COALESCE(raw_price, p.unit_price))')} AS price_sum
            FROM typ_sales s LEFT JOIN cln_products p USING (product_id) GROUP BY s.product_id"""
    )
    out["map_unknown_member"] = clean_query(
        "SELECT customer_id, COUNT(*) AS row_count FROM chk_sales GROUP BY customer_id"
    )
    out["append_unknown_member"] = star_query(
        """SELECT customer_name, COUNT(*) AS row_count FROM
           (SELECT customer_name FROM raw_customers UNION ALL SELECT 'Unknown Customer') GROUP BY ALL""",
        RAW_CTES,
    )
    out["derive_measures"] = star_query(
        f"""SELECT order_id, product_id, {dbl('gross_revenue')} AS gross_revenue,
                   {dbl('net_revenue')} AS net_revenue, {dbl('cost')} AS cost, {dbl('profit')} AS profit
            FROM sales"""
    )
    half_even = """SELECT order_id, product_id, cost, CAST(CASE
          WHEN (exact * 100) % 1 = 0.5 AND floor(exact * 100) % 2 = 0 THEN floor(exact * 100) / 100
          ELSE ROUND(exact, 2) END AS DECIMAL(14,2)) AS net
        FROM (SELECT *, gross_revenue * (1 - discount_pct) AS exact FROM sales)"""
    out["derive_measures_half_even"] = star_query(
        f"""SELECT order_id, product_id, {dbl('net')} AS net_revenue, {dbl('(net - cost)')} AS profit
            FROM ({half_even})"""
    )
    out["repair_balance"] = clean_query(
        f"""SELECT store_id, COUNT(*) AS row_count, COUNT(*) FILTER (repaired) AS repaired,
                   {big('SUM(closing_stock)')} AS closing_stock
            FROM chk_inventory GROUP BY store_id"""
    )
    out["filter_valid"] = clean_query(
        """SELECT product_id, COUNT(*) AS row_count FROM typ_sales
           WHERE quantity > 0 AND discount_pct BETWEEN 0 AND 1 GROUP BY product_id"""
    )
    out["match_returns"] = star_query(
        """SELECT r.return_id, r.order_id, r.product_id
           FROM s_returns r JOIN sales s USING (order_id, product_id)
           WHERE r.return_date >= s.order_date AND r.quantity_returned > 0
             AND r.quantity_returned <= s.quantity""",
        messy_suspect(),
    )
    out["match_returns_stored"] = out["match_returns"]
    out["read_raw"] = star_query(" UNION ALL ".join(_read(t) for t in KEYS), RAW_CTES)
    out["read_raw_malformed"] = star_query(" UNION ALL ".join(_read_malformed(t) for t in KEYS), RAW_CTES)
    return out


def _read(table: str) -> str:
    cells = " || '|' || ".join(f"COALESCE({c}, '~')" for c in RAW_COLUMNS[table])
    digest = f"CAST('0x' || substr(md5({cells}), 1, 8) AS BIGINT)"
    return f"""SELECT '{table}' AS table_name, COUNT(*) AS row_count,
                      COUNT(DISTINCT {KEYS[table].split(',')[0]}) AS first_key_values,
                      {big(f'SUM({digest})')} AS content FROM raw_{table}"""


def _read_malformed(table: str) -> str:
    cells = " || '|' || ".join(f"COALESCE({c}, '~')" for c in RAW_COLUMNS[table])
    n = len(RAW_COLUMNS[table])
    return f"""SELECT '{table}' AS table_name, COUNT(*) FILTER (d % 40 > 1) AS row_count,
                      {big('SUM(d) FILTER (d % 40 > 1)')} AS content, COUNT(*) FILTER (d % 40 = 0) AS n_long,
                      COUNT(*) FILTER (d % 40 = 1) AS n_short,
                      {big(f'COALESCE(SUM(CASE d % 40 WHEN 0 THEN {n + 2} WHEN 1 THEN {n - 1} ELSE 0 END), 0)')} AS cells_apart
               FROM (SELECT CAST('0x' || substr(md5({cells}), 1, 8) AS BIGINT) AS d FROM raw_{table})"""


def messy_suspect() -> str:
    from tillcheck.defects import SUSPECT

    return messy_sql(SUSPECT, "s")
