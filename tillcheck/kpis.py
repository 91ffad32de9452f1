"""SQL for frames, measures, report tables, demand, sampling and file round trips."""

from __future__ import annotations

from tillcheck.analyses import all_analyses
from tillcheck.star import big, dbl, mean, month, ratio, star_query

KNOWN = "customer_id <> 0"
TABLES = ("customers", "products", "stores", "sales", "inventory", "returns")


def frames() -> dict[str, str]:
    def per(key: str, where: str = "true", more: str = "") -> str:
        return f"""(SELECT {key}, SUM(net_revenue) AS rev, SUM(profit) AS prof,
            COUNT(DISTINCT order_id) AS n, {big('SUM(quantity)')} AS units, COUNT(*) AS k,
            {mean('discount_pct')} AS disc, MIN(order_date) AS a, MAX(order_date) AS z
            FROM sales WHERE {where} GROUP BY {key})"""

    totals = f"{dbl('rev')} AS revenue, {dbl('prof')} AS profit"
    kpis = {
        "Total Revenue": "SELECT SUM(net_revenue) FROM sales",
        "Gross Profit": "SELECT SUM(profit) FROM sales",
        "Profit Margin": f"SELECT {ratio('SUM(profit)', 'SUM(net_revenue)')} FROM sales",
        "Orders": "SELECT COUNT(DISTINCT order_id) FROM sales",
        "Average Order Value": f"SELECT {ratio('SUM(net_revenue)', 'COUNT(DISTINCT order_id)')} FROM sales",
        "Units Sold": "SELECT SUM(quantity) FROM sales",
        "Customers": f"SELECT COUNT(DISTINCT customer_id) FROM sales WHERE {KNOWN}",
        "Return Rate": f"SELECT {ratio('(SELECT SUM(quantity_returned) FROM returns)', 'SUM(quantity)')} FROM sales",
        "Stockout Rate": f"SELECT {ratio('COUNT(*) FILTER (closing_stock = 0)', 'COUNT(*)')} FROM inventory",
        "Inventory Turnover": f"""SELECT {ratio('(SELECT SUM(cost) FROM sales)', mean('v'))}
            FROM (SELECT date, SUM(closing_stock * unit_cost) AS v
                  FROM inventory JOIN products USING (product_id) GROUP BY date)""",
    }
    return {
        "frame_monthly": star_query(
            f"""SELECT month, {totals}, n AS orders, units AS units_sold,
                       {dbl('prev')} AS previous_month_revenue,
                       {ratio('(rev - prev)', 'prev')} AS month_over_month_growth
                FROM (SELECT *, lag(rev) OVER (ORDER BY month) AS prev FROM {per('month')})"""
        ),
        "frame_stores": star_query(
            f"""SELECT {big('row_number() OVER (ORDER BY rev DESC, store_id)')} AS revenue_rank,
                       store_id, store_name, city, province, store_type, {totals}, n AS orders,
                       units AS units_sold, {ratio('prof', 'rev')} AS profit_margin,
                       {ratio('rev', 'n')} AS average_order_value
                FROM {per('store_id')} JOIN stores USING (store_id)"""
        ),
        "frame_products": star_query(
            f"""SELECT {big('row_number() OVER (ORDER BY rev DESC, product_id)')} AS revenue_rank,
                       product_id, product_name, category, subcategory, {totals},
                       units AS units_sold, k AS sales_lines, disc AS average_discount,
                       {ratio('prof', 'rev')} AS profit_margin
                FROM {per('product_id')} JOIN products USING (product_id)"""
        ),
        "frame_customers": star_query(
            f"""SELECT customer_id, customer_name, city, province, customer_segment, n AS orders,
                       {dbl('rev')} AS total_spend, {dbl('prof')} AS gross_profit,
                       strftime(a, '%Y-%m-%d') AS first_order, strftime(z, '%Y-%m-%d') AS latest_order,
                       {ratio('rev', 'n')} AS average_order_value,
                       CASE WHEN n >= 2 THEN 'Yes' ELSE 'No' END AS repeat_customer
                FROM {per('customer_id', KNOWN)} JOIN customers USING (customer_id)"""
        ),
        "frame_inventory": star_query(
            f"""SELECT product_id, product_name, category, n AS inventory_observations,
                       avg_stock AS average_closing_stock, units AS total_units_sold,
                       zero AS stockout_observations, low AS below_reorder_observations,
                       {ratio('zero', 'n')} AS stockout_rate
                FROM (SELECT product_id, COUNT(*) AS n, {mean('closing_stock')} AS avg_stock,
                             {big('SUM(units_sold)')} AS units, COUNT(*) FILTER (closing_stock = 0) AS zero,
                             COUNT(*) FILTER (closing_stock < reorder_level) AS low
                      FROM inventory GROUP BY product_id) JOIN products USING (product_id)"""
        ),
        "frame_returns_category": star_query(
            f"""SELECT category, s AS units_sold, COALESCE(r, 0) AS units_returned,
                       {ratio('COALESCE(r, 0)', 's')} AS return_rate
                FROM (SELECT category, {big('SUM(quantity)')} AS s
                      FROM sales JOIN products USING (product_id) GROUP BY category)
                LEFT JOIN (SELECT category, {big('SUM(quantity_returned)')} AS r
                      FROM returns JOIN products USING (product_id) GROUP BY category) USING (category)"""
        ),
        "frame_returns_reason": star_query(
            f"""SELECT return_reason, COUNT(*) AS return_records,
                       {big('SUM(quantity_returned)')} AS units_returned,
                       {ratio('SUM(quantity_returned)', '(SELECT SUM(quantity_returned) FROM returns)')}
                         AS share_of_returned_units
                FROM returns GROUP BY return_reason"""
        ),
        "executive_kpis": star_query(
            " UNION ALL ".join(
                f"SELECT '{m}' AS metric, COALESCE({dbl(f'({sql})')}, 0) AS value" for m, sql in kpis.items()
            )
        ),
    }


# ----------------------------------------------------------------- measures

SALES_BASE = """sales_base AS (
  SELECT s.*, year(order_date) AS yr, p.category, t.province, c.customer_segment
  FROM sales s JOIN products p USING (product_id) JOIN stores t USING (store_id)
       JOIN customers c USING (customer_id))"""
STOCK_BASE = """stock_base AS (
  SELECT i.*, year(date) AS yr, p.category, p.unit_cost, t.province
  FROM inventory i JOIN products p USING (product_id) JOIN stores t USING (store_id))"""
RETURN_BASE = """return_base AS (
  SELECT r.*, year(return_date) AS yr, p.category FROM returns r JOIN products p USING (product_id))"""
BASES = ",\n".join((SALES_BASE, STOCK_BASE, RETURN_BASE))

# measure -> (base, expression); all of these are evaluated by year and category
SIMPLE = {
    "total_revenue": ("sales", dbl("SUM(net_revenue)")),
    "total_profit": ("sales", dbl("SUM(profit)")),
    "profit_margin": ("sales", ratio("SUM(profit)", "SUM(net_revenue)")),
    "orders": ("sales", "COUNT(DISTINCT order_id)"),
    "units_sold": ("sales", big("SUM(quantity)")),
    "average_order_value": ("sales", ratio("SUM(net_revenue)", "COUNT(DISTINCT order_id)")),
    "customers": ("sales", f"COUNT(DISTINCT customer_id) FILTER ({KNOWN})"),
    "average_discount": ("sales", ratio("SUM(discount_pct)", "COUNT(*)")),
    "returned_units": ("return", big("SUM(quantity_returned)")),
    "inventory_observations": ("stock", "COUNT(*)"),
    "stockout_observations": ("stock", "COUNT(*) FILTER (closing_stock = 0)"),
    "stockout_rate": ("stock", ratio("COUNT(*) FILTER (closing_stock = 0)", "COUNT(*)")),
    "closing_inventory_value": ("stock", dbl("SUM(closing_stock * unit_cost)")),
}


def _average_value(keys: str) -> str:
    return f"""(SELECT {keys}, {mean('v')} AS v FROM
        (SELECT {keys}, month, SUM(closing_stock * unit_cost) AS v FROM stock_base GROUP BY ALL)
        GROUP BY ALL)"""


def _repeats(keys: str) -> str:
    return f"""(SELECT {keys}, COUNT(*) FILTER (n >= 2) AS again, COUNT(*) AS everyone FROM
        (SELECT {keys}, customer_id, COUNT(DISTINCT order_id) AS n FROM sales_base
         WHERE {KNOWN} GROUP BY ALL) GROUP BY ALL)"""


def measures() -> dict[str, str]:
    keys = "yr, category"
    named = "CAST(yr AS BIGINT) AS year, category"
    out = {
        f"measure_{name}": star_query(f"SELECT {named}, {sql} AS {name} FROM {base}_base GROUP BY {keys}", BASES)
        for name, (base, sql) in SIMPLE.items()
    }
    out["measure_return_rate"] = star_query(
        f"""SELECT {named}, {ratio('r', 's')} AS return_rate
            FROM (SELECT {keys}, SUM(quantity) AS s FROM sales_base GROUP BY ALL)
            FULL JOIN (SELECT {keys}, SUM(quantity_returned) AS r FROM return_base GROUP BY ALL)
            USING ({keys})""",
        BASES,
    )
    out["measure_avg_monthly_inventory_value"] = star_query(
        f"SELECT {named}, v AS avg_monthly_inventory_value FROM {_average_value(keys)}", BASES
    )
    out["measure_inventory_turnover_measure"] = star_query(
        f"""SELECT {named}, {ratio('c', 'v')} AS inventory_turnover_measure
            FROM (SELECT {keys}, SUM(cost) AS c FROM sales_base GROUP BY ALL)
            FULL JOIN {_average_value(keys)} USING ({keys})""",
        BASES,
    )
    out["measure_repeat_customers"] = star_query(
        f"SELECT {named}, again AS repeat_customers FROM {_repeats(keys)}", BASES
    )
    out["measure_repeat_customer_rate"] = star_query(
        f"SELECT {named}, {ratio('again', 'everyone')} AS repeat_customer_rate FROM {_repeats(keys)}",
        BASES,
    )
    monthly = """days AS (SELECT order_date AS x FROM sales UNION ALL SELECT date FROM inventory
          UNION ALL SELECT return_date FROM returns),
      axis AS (SELECT CAST(unnest(generate_series(date_trunc('month', MIN(x)), date_trunc('month', MAX(x)),
                 INTERVAL 1 MONTH)) AS DATE) AS m FROM days),
      monthly AS (SELECT category, CAST(month || '-01' AS DATE) AS m, SUM(net_revenue) AS rev
        FROM sales JOIN products USING (product_id) GROUP BY ALL),
      grid AS (SELECT category, m, year(m) AS yr, strftime(m, '%Y-%m') AS month, rev
        FROM (SELECT category, m FROM (SELECT DISTINCT category FROM monthly), axis)
        LEFT JOIN monthly USING (category, m))"""
    before = """grid a LEFT JOIN grid b
        ON a.category = b.category AND b.m = a.m - INTERVAL 1 MONTH"""
    out["measure_previous_month_revenue"] = star_query(
        f"""SELECT a.category, a.month, {dbl('b.rev')} AS previous_month_revenue FROM {before}""", monthly
    )
    out["measure_mom_growth"] = star_query(
        f"""SELECT a.category, a.month, {ratio('(a.rev - b.rev)', 'b.rev')} AS mom_growth FROM {before}""",
        monthly,
    )
    out["measure_ytd_revenue"] = star_query(
        f"""SELECT a.category, a.month, {dbl('SUM(b.rev)')} AS ytd_revenue
            FROM grid a JOIN grid b ON a.category = b.category AND a.yr = b.yr AND b.m <= a.m
            GROUP BY a.category, a.month""",
        monthly,
    )
    out["measure_by_month_segment"] = star_query(
        f"""SELECT month, customer_segment, {dbl('s.rev')} AS total_revenue, r.units AS returned_units
            FROM (SELECT month, customer_segment, SUM(net_revenue) AS rev FROM sales_base GROUP BY ALL) s
            FULL JOIN (SELECT g.month, k.customer_segment, g.units
                       FROM (SELECT {month('return_date')} AS month, {big('SUM(quantity_returned)')} AS units
                             FROM returns GROUP BY ALL) g,
                            (SELECT DISTINCT customer_segment FROM customers) k) r
            USING (month, customer_segment)""",
        BASES,
    )
    out["measure_by_segment_unrelated"] = star_query(
        f"""SELECT DISTINCT customer_segment, (SELECT {big('SUM(quantity_returned)')} FROM returns) AS returned_units
            FROM customers"""
    )
    out["measure_by_customer_product"] = star_query(
        f"""SELECT customer_id, product_id, {dbl('rev')} AS total_revenue, units AS returned_units,
                   {ratio('units', 'sold')} AS return_rate
            FROM (SELECT customer_id, product_id, SUM(net_revenue) AS rev, SUM(quantity) AS sold
                  FROM sales GROUP BY ALL)
            LEFT JOIN (SELECT product_id, {big('SUM(quantity_returned)')} AS units FROM returns GROUP BY ALL)
            USING (product_id)"""
    )
    out["measure_by_customer"] = star_query(
        f"""SELECT customer_id, province, {dbl('prof')} AS total_profit,
                   (SELECT {big('SUM(quantity_returned)')} FROM returns) AS returned_units
            FROM (SELECT customer_id, province, SUM(profit) AS prof FROM sales JOIN stores USING (store_id) GROUP BY ALL)
            RIGHT JOIN (SELECT * FROM (SELECT customer_id FROM customers), (SELECT DISTINCT province FROM stores))
            USING (customer_id, province)"""
    )
    out["measure_by_company"] = star_query(
        f"""SELECT {dbl('SUM(net_revenue)')} AS total_revenue, COUNT(DISTINCT order_id) AS orders,
                   {ratio('(SELECT SUM(quantity_returned) FROM returns)', 'SUM(quantity)')} AS return_rate,
                   (SELECT {ratio('COUNT(*) FILTER (closing_stock = 0)', 'COUNT(*)')} FROM inventory) AS stockout_rate,
                   (SELECT COUNT(*) FROM (SELECT customer_id FROM sales WHERE {KNOWN}
                     GROUP BY customer_id HAVING COUNT(DISTINCT order_id) >= 2)) AS repeat_customers
            FROM sales"""
    )
    out["measure_by_segment_province"] = star_query(
        f"""SELECT customer_segment, province, total_revenue, customers,
                   (SELECT {big('SUM(quantity_returned)')} FROM returns) AS returned_units
            FROM (SELECT customer_segment, province, {dbl('SUM(net_revenue)')} AS total_revenue,
                         COUNT(DISTINCT customer_id) FILTER ({KNOWN}) AS customers
                  FROM sales_base GROUP BY customer_segment, province)
            RIGHT JOIN (SELECT * FROM (SELECT DISTINCT customer_segment FROM customers),
                                      (SELECT DISTINCT province FROM stores))
            USING (customer_segment, province)""",
        BASES,
    )
    out["measure_by_province_category"] = star_query(
        f"""SELECT province, category, {dbl('prof')} AS total_profit, {dbl('worth')} AS closing_inventory_value,
                   v AS avg_monthly_inventory_value
            FROM (SELECT province, category, SUM(profit) AS prof FROM sales_base GROUP BY ALL)
            FULL JOIN (SELECT province, category, SUM(closing_stock * unit_cost) AS worth
                       FROM stock_base GROUP BY ALL) USING (province, category)
            FULL JOIN {_average_value('province, category')} USING (province, category)""",
        BASES,
    )
    out["measure_by_province_stock_and_sales"] = star_query(
        f"""SELECT province, {ratio('prof', 'rev')} AS profit_margin, {ratio('zero', 'seen')} AS stockout_rate
            FROM (SELECT province, SUM(profit) AS prof, SUM(net_revenue) AS rev FROM sales_base GROUP BY ALL)
            FULL JOIN (SELECT province, COUNT(*) FILTER (closing_stock = 0) AS zero, COUNT(*) AS seen
                       FROM stock_base GROUP BY ALL) USING (province)""",
        BASES,
    )
    return out


def report() -> dict[str, str]:
    types = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
    cells = ", ".join(
        f"{ratio(f'''COUNT(*) FILTER (closing_stock = 0 AND category = '{c}')''', f'''COUNT(*) FILTER (category = '{c}')''')}"
        f' AS "{c}"'
        for c in types
    )
    none = " AND ".join(f"category <> '{c}'" for c in types)
    cells += f""", {ratio(f'COUNT(*) FILTER (closing_stock = 0 AND {none})', f'COUNT(*) FILTER ({none})')} AS other"""
    sliced = """pick_p AS (SELECT product_id FROM products WHERE category = 'PROMO'),
      pick_s AS (SELECT store_id FROM stores WHERE province = 'EUROPE'),
      pick_c AS (SELECT customer_id FROM customers WHERE customer_segment = 'BUILDING')"""
    dates = "BETWEEN DATE '1997-03-15' AND DATE '1999-10-20'"
    return {
        "date_dimension": star_query(
            f"""SELECT CAST(d AS DATE) AS date, {big('year(d)')} AS year, {big('month(d)')} AS month_number,
                       strftime(d, '%b') AS month, {month('d')} AS year_month,
                       {big('year(d) * 100 + month(d)')} AS year_month_sort, 'Q' || quarter(d) AS quarter
                FROM (SELECT unnest(generate_series(MIN(x), MAX(x), INTERVAL 1 DAY)) AS d
                      FROM (SELECT order_date AS x FROM sales UNION ALL SELECT date FROM inventory
                            UNION ALL SELECT return_date FROM returns))"""
        ),
        "slice": star_query(
            f"""SELECT 'sales' AS fact, COUNT(*) AS row_count, {big('COALESCE(SUM(quantity), 0)')} AS units
                FROM sales WHERE order_date {dates} AND product_id IN (FROM pick_p)
                  AND store_id IN (FROM pick_s) AND customer_id IN (FROM pick_c)
                UNION ALL SELECT 'inventory', COUNT(*), {big('COALESCE(SUM(units_sold), 0)')}
                FROM inventory WHERE date {dates} AND product_id IN (FROM pick_p) AND store_id IN (FROM pick_s)
                UNION ALL SELECT 'returns', COUNT(*), {big('COALESCE(SUM(quantity_returned), 0)')}
                FROM returns WHERE return_date {dates} AND product_id IN (FROM pick_p)""",
            sliced,
        ),
        "slice_by_category": star_query(
            f"""SELECT category, {dbl('SUM(net_revenue)')} AS revenue, COUNT(DISTINCT order_id) AS orders
                FROM sales JOIN products USING (product_id)
                WHERE order_date {dates} AND store_id IN (FROM pick_s) GROUP BY category""",
            sliced,
        ),
        "enrich_returns": star_query(
            """SELECT r.return_id, r.order_id, r.product_id, r.return_date, r.quantity_returned,
                      r.return_reason, s.store_id, s.customer_id
               FROM returns r LEFT JOIN sales s USING (order_id, product_id)"""
        ),
        "enrichment_check": star_query(
            "SELECT COUNT(*) AS rows_before, COUNT(*) AS rows_after, CAST(0 AS BIGINT) AS unmatched FROM returns"
        ),
        "returned_units_by_store": star_query(
            f"""SELECT province, customer_segment, {big('SUM(quantity_returned)')} AS returned_units
                FROM returns JOIN sales USING (order_id, product_id) JOIN stores USING (store_id)
                JOIN (SELECT customer_id, customer_segment FROM customers) USING (customer_id)
                GROUP BY province, customer_segment"""
        ),
        "monthly_revenue_profit": star_query(
            f"""SELECT month, {dbl('SUM(net_revenue)')} AS total_revenue, {dbl('SUM(profit)')} AS total_profit
                FROM sales GROUP BY month"""
        ),
        "revenue_by_category": star_query(
            f"""SELECT category, {dbl('SUM(net_revenue)')} AS total_revenue
                FROM sales JOIN products USING (product_id) GROUP BY category"""
        ),
        "revenue_by_store": star_query(
            f"""SELECT store_id, store_name, {dbl('SUM(net_revenue)')} AS total_revenue
                FROM sales JOIN stores USING (store_id) GROUP BY ALL"""
        ),
        "product_ranking": star_query(
            f"""SELECT product_id, product_name, category, {dbl('rev')} AS total_revenue,
                       {dbl('prof')} AS total_profit, {ratio('prof', 'rev')} AS profit_margin,
                       units AS units_sold, {big('rank() OVER (ORDER BY rev DESC)')} AS revenue_rank
                FROM (SELECT product_id, SUM(net_revenue) AS rev, SUM(profit) AS prof,
                             {big('SUM(quantity)')} AS units FROM sales GROUP BY product_id)
                JOIN products USING (product_id)"""
        ),
        "margin_by_category": star_query(
            f"""SELECT category, {ratio('SUM(profit)', 'SUM(net_revenue)')} AS profit_margin
                FROM sales JOIN products USING (product_id) GROUP BY category"""
        ),
        "discount_vs_margin": star_query(
            f"""SELECT product_id, product_name, {ratio('SUM(discount_pct)', 'COUNT(*)')} AS average_discount,
                       {ratio('SUM(profit)', 'SUM(net_revenue)')} AS profit_margin,
                       {dbl('SUM(net_revenue)')} AS total_revenue
                FROM sales JOIN products USING (product_id) GROUP BY product_id, product_name"""
        ),
        "closing_value_by_category": star_query(
            f"""SELECT category, {dbl('SUM(closing_stock * unit_cost)')} AS closing_inventory_value
                FROM inventory JOIN products USING (product_id) GROUP BY category"""
        ),
        "stockout_matrix": star_query(
            f"""SELECT store_id, store_name, {cells}
                FROM inventory JOIN products USING (product_id) JOIN stores USING (store_id)
                GROUP BY store_id, store_name"""
        ),
        "customers_by_segment": star_query(
            f"""SELECT customer_segment, COUNT(DISTINCT customer_id) FILTER ({KNOWN}) AS customers,
                       {dbl('SUM(net_revenue)')} AS total_revenue
                FROM sales JOIN customers USING (customer_id) GROUP BY customer_segment"""
        ),
    }


def demand() -> dict[str, str]:
    u = "CAST('0x' || substr(md5('7|' || product_id), 1, 13) AS BIGINT)"
    v = "CAST('0x' || substr(md5('7|' || order_id || '|' || product_id), 1, 13) AS BIGINT)"
    return {
        "monthly_demand": star_query(
            f"""SELECT last_day(order_date) AS date, store_id, product_id, {big('SUM(quantity)')} AS units
                FROM sales GROUP BY ALL"""
        ),
        "densify_grid": star_query(
            f"""SELECT g.date, g.store_id, g.category, COALESCE(d.units, 0) AS units
                FROM (SELECT date, store_id, category
                      FROM (SELECT DISTINCT store_id, category FROM demand),
                           (SELECT last_day(CAST(unnest(generate_series(date_trunc('month', MIN(date)),
                              date_trunc('month', MAX(date)), INTERVAL 1 MONTH)) AS DATE)) AS date FROM demand)) g
                LEFT JOIN demand d USING (date, store_id, category)""",
            f"""demand AS (SELECT last_day(order_date) AS date, store_id, category,
                  {big('SUM(quantity)')} AS units
                FROM sales JOIN products USING (product_id) GROUP BY ALL)""",
        ),
        "inventory_rollforward": star_query(
            f"""SELECT date, store_id, product_id, {big('first0 + flows - f')} AS opening_stock, units_received,
                       units_sold, {big('first0 + flows')} AS closing_stock
                FROM (SELECT *, units_received - units_sold AS f,
                             SUM(units_received - units_sold) OVER w AS flows,
                             first_value(opening_stock) OVER w AS first0
                      FROM inventory
                      WINDOW w AS (PARTITION BY store_id, product_id ORDER BY date
                                   ROWS UNBOUNDED PRECEDING))"""
        ),
        "sample_rows": star_query(
            """SELECT product_id, product_name FROM products
               ORDER BY md5('42|' || product_id), product_id LIMIT 100"""
        ),
        "sample_tenth": star_query(
            """SELECT order_id, product_id FROM sales
               ORDER BY md5('42|' || order_id || '|' || product_id), order_id, product_id
               LIMIT (SELECT COUNT(*) // 10 FROM sales)"""
        ),
        "weighted_tenth": star_query(
            f"""SELECT order_id, product_id FROM sales WHERE quantity > 0
                ORDER BY -ln(({v} + 1e0) / 4503599627370496e0) / {dbl('quantity')}, order_id, product_id
                LIMIT (SELECT COUNT(*) // 10 FROM sales)"""
        ),
        "weighted_sample": star_query(
            f"""SELECT product_id, product_name FROM products WHERE unit_price > 0
                ORDER BY -ln(({u} + 1e0) / 4503599627370496e0) / {dbl('unit_price')}, product_id LIMIT 100"""
        ),
    }


# Columns of the star tables by name; money counts as cents.
CONTENT = {
    "customers": "city customer_id customer_name customer_segment province signup_date",
    "products": "category product_id product_name subcategory supplier unit_cost* unit_price*",
    "stores": "city opening_date province store_id store_name store_type",
    "sales": """cost* customer_id discount_pct* gross_revenue* month net_revenue* order_date order_id product_id
                profit* quantity store_id unit_cost* unit_price*""",
    "inventory": """closing_stock date month opening_stock product_id reorder_level store_id units_received
                    units_sold""",
    "returns": "order_id product_id quantity_returned return_date return_id return_reason",
}


def _content(table: str) -> str:
    values = [f"CAST({c[:-1]} * 100 AS BIGINT)" if c[-1] == "*" else c for c in CONTENT[table].split()]
    cells = " || '|' || ".join(f"COALESCE(CAST({v} AS VARCHAR), '~')" for v in values)
    digest = f"CAST('0x' || substr(md5({cells}), 1, 8) AS BIGINT)"
    return f"""SELECT '{table}' AS table_name, COUNT(*) AS row_count,
                      {big(f'SUM({digest})')} AS content FROM {table}"""


def files() -> dict[str, str]:
    contents = star_query(" UNION ALL ".join(_content(t) for t in CONTENT))
    counts = all_analyses()["table_row_counts"]
    exported = {
        "frame_monthly": "revenue", "frame_stores": "revenue", "frame_products": "revenue",
        "frame_customers": "total_spend", "frame_inventory": "total_units_sold",
        "frame_returns_category": "units_returned", "frame_returns_reason": "units_returned",
        "executive_kpis": "value",
    }
    sql = frames()
    money = ("unit_price", "discount_pct", "unit_cost", "gross_revenue", "net_revenue", "cost", "profit")
    return {
        "write_cleaned": star_query(
            f"""SELECT order_id, order_date, customer_id, store_id, product_id, quantity,
                       {', '.join(f'{dbl(c)} AS {c}' for c in money)} FROM sales"""
        ),
        "read_cleaned": star_query(
            f"""SELECT month, COUNT(*) AS row_count, {dbl('SUM(net_revenue)')} AS revenue
                FROM sales GROUP BY month"""
        ),
        "write_cleaned_content": contents,
        "stored_tables": contents,
        "stored_tables_by_name": star_query(
            f"""SELECT s.month, p.province, COUNT(*) AS row_count, {dbl('SUM(s.net_revenue)')} AS revenue
                FROM sales s JOIN stores p USING (store_id) GROUP BY ALL"""
        ),
        "stored_loads": star_query(
            """SELECT load_no, table_name, CASE load_no WHEN 1 THEN early ELSE n END AS offered,
                      CASE load_no WHEN 1 THEN early WHEN 2 THEN n - early ELSE 0 END AS added
               FROM counted, (SELECT unnest([1, 2, 3]) AS load_no)""",
            """early_sales AS (SELECT order_id, product_id FROM sales WHERE order_date <= DATE '1996-12-31'),
               counted AS ("""
            + " UNION ALL ".join(
                f"SELECT '{t}' AS table_name, COUNT(*) AS n, {early} AS early FROM {t}"
                for t, early in {
                    **dict.fromkeys(("customers", "products", "stores"), "COUNT(*)"),
                    "sales": "(SELECT COUNT(*) FROM early_sales)",
                    "inventory": "COUNT(*) FILTER (date <= DATE '1996-12-31')",
                    "returns": "(SELECT COUNT(*) FROM returns SEMI JOIN early_sales USING (order_id, product_id))",
                }.items()
            )
            + ")",
        ),
        "store_return_rate_stored": all_analyses()["store_return_rate"],
        "enrich_returns_stored": report()["enrich_returns"],
        "load_tables": star_tables()["star_products"],
        "load_tables_content": contents,
        "load_tables_counts": counts,
        "load_tables_customers": all_analyses()["customer_summary"],
        "export_results": " UNION ALL ".join(
            f"SELECT '{n}' AS name, COUNT(*) AS row_count, CAST(MAX({c}) AS DOUBLE) AS largest FROM ({sql[n]})"
            for n, c in exported.items()
        ),
        "verify_export": " UNION ALL ".join(
            f"SELECT '{n}' AS name, COUNT(*) > 0 AS has_rows FROM ({sql[n]})" for n in exported
        ),
    }


def suite() -> dict[str, str]:
    extra = {"month_over_month_calendar", "year_over_year_calendar"}
    parts = [
        f"SELECT '{name}' AS name, (SELECT COUNT(*) FROM ({sql})) AS row_count"
        for name, sql in all_analyses().items()
        if name not in extra and name != "discount_bands"
    ]
    bands = star_query(
        """SELECT COUNT(DISTINCT CASE WHEN discount_pct <= 0 THEN 0 WHEN discount_pct <= 0.10 THEN 1
                                 WHEN discount_pct <= 0.20 THEN 2 ELSE 3 END) FROM sales"""
    )
    parts.append(f"SELECT 'discount_bands' AS name, ({bands}) AS row_count")
    return {"run_suite": " UNION ALL ".join(parts)}


def star_tables() -> dict[str, str]:
    price = f"{dbl('unit_price')} AS unit_price, {dbl('unit_cost')} AS unit_cost"
    return {
        "star_products": star_query(f"SELECT * REPLACE ({price}) FROM products"),
        "star_customers": star_query("SELECT * FROM customers"),
        "star_stores": star_query("SELECT * FROM stores"),
        "star_inventory": star_query("SELECT * FROM inventory"),
        "star_returns": star_query("SELECT * FROM returns"),
    }


def all_kpis() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (frames, measures, report, demand, files, suite, star_tables):
        out.update(group())
    return out
