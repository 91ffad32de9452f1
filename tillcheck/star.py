"""SQL text of the retail star over the benchmark tables (rules: FIXTURES.md)."""

from __future__ import annotations


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def r2(x: str) -> str:
    return f"CAST(ROUND(CAST({x} AS DECIMAL(28,10)), 2) AS DOUBLE)"


def ratio(a: str, b: str) -> str:
    return f"({dbl(a)} / NULLIF({dbl(b)}, 0))"


def pct(a: str, b: str) -> str:
    return r2(f"100e0 * {dbl(a)} / NULLIF({dbl(b)}, 0)")


def mean(x: str) -> str:
    return f"({dbl(f'SUM({x})')} / NULLIF(COUNT({x}), 0))"


def month(c: str) -> str:
    return f"strftime({c}, '%Y-%m')"


STAR = f"""
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         p_brand AS subcategory,
         CAST(ROUND(CAST(p_retailprice AS DECIMAL(12,2))
              * (0.40 + CAST(p_size % 40 AS DECIMAL(4,0)) * 0.01), 2) AS DECIMAL(12,2)) AS unit_cost,
         CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price,
         'Supplier ' || (p_size % 12) AS supplier
  FROM part),
places AS (
  SELECT n_nationkey AS place, n_name AS city, r_name AS province
  FROM nation JOIN region ON n_regionkey = r_regionkey),
customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, city, province,
         DATE '2020-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS signup_date,
         c_mktsegment AS customer_segment
  FROM customer JOIN places ON c_nationkey = place),
stores AS (
  SELECT s_suppkey AS store_id, s_name AS store_name, city, province,
         CASE s_suppkey % 2 WHEN 0 THEN 'Urban' ELSE 'Suburban' END AS store_type,
         DATE '2010-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS opening_date
  FROM supplier JOIN places ON s_nationkey = place),
picked AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_partkey
    ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice, l_shipdate,
             l_discount, l_tax, l_returnflag, l_linestatus) = 1),
priced AS (
  SELECT l_orderkey AS order_id, CAST(o_orderdate AS DATE) AS order_date,
         o_custkey AS customer_id, l_suppkey AS store_id, l_partkey AS product_id,
         CAST(l_quantity AS BIGINT) AS quantity, unit_price,
         CAST(l_discount AS DECIMAL(4,2)) AS discount_pct, unit_cost,
         CAST(CAST(l_quantity AS DECIMAL(6,0)) * unit_price AS DECIMAL(14,2)) AS gross_revenue,
         CAST(CAST(l_quantity AS DECIMAL(6,0)) * unit_cost AS DECIMAL(14,2)) AS cost,
         CAST(l_shipdate AS DATE) AS ship_date, l_returnflag AS return_flag,
         l_linenumber AS line_number
  FROM picked JOIN orders ON l_orderkey = o_orderkey
              JOIN products ON l_partkey = product_id),
lines AS (
  SELECT *, CAST(net_revenue - cost AS DECIMAL(14,2)) AS profit
  FROM (SELECT *, CAST(ROUND(gross_revenue * (1 - discount_pct), 2) AS DECIMAL(14,2)) AS net_revenue
        FROM priced)),
sales AS (
  SELECT order_id, order_date, customer_id, store_id, product_id, quantity, unit_price,
         discount_pct, unit_cost, gross_revenue, net_revenue, cost, profit,
         {month('order_date')} AS month
  FROM lines),
returns AS (
  SELECT 'RET-' || order_id || '-' || product_id AS return_id, order_id, product_id,
         ship_date AS return_date,
         1 + (order_id + product_id) % quantity AS quantity_returned,
         ['Defective', 'Wrong Item', 'Customer Changed Mind', 'Damaged', 'Size Issue',
          'Unknown'][line_number % 6 + 1] AS return_reason
  FROM lines WHERE return_flag = 'R' AND ship_date >= order_date),
stocked AS (
  SELECT last_day(order_date) AS date, store_id, product_id,
         CAST(SUM(quantity) AS BIGINT) AS units_sold,
         (store_id * 7 + product_id * 13) % 18 AS opening_stock
  FROM sales GROUP BY ALL),
inventory AS (
  SELECT date, store_id, product_id, opening_stock, units_received, units_sold,
         opening_stock + units_received - units_sold AS closing_stock,
         4 + (store_id * 3 + product_id * 5) % 11 AS reorder_level,
         {month('date')} AS month
  FROM (SELECT *, greatest(0, units_sold - opening_stock
            + CASE WHEN (store_id + product_id + month(date)) % 5 = 0 THEN 0
                   ELSE 1 + (store_id + product_id * 2) % 20 END) AS units_received
        FROM stocked))
""".strip()


def star_query(body: str, ctes: str = "") -> str:
    """``body`` with the star, and optionally further CTEs, in scope."""
    more = f",\n{ctes.strip()}" if ctes.strip() else ""
    return f"WITH {STAR}{more}\n{body.strip()}"
