"""SQL for the business analyses."""

from __future__ import annotations

from tillcheck.star import big, dbl, mean, month, pct, r2, ratio, star_query

KNOWN = "customer_id <> 0"


def _units(fact: str, column: str, key: str) -> str:
    return f"(SELECT {key}, {big(f'SUM({column})')} AS u FROM {fact} GROUP BY ALL)"


def _category_units(fact: str, column: str) -> str:
    return (
        f"(SELECT category, {big(f'SUM({column})')} AS u "
        f"FROM {fact} JOIN products USING (product_id) GROUP BY ALL)"
    )


MONTHLY = "monthly AS (SELECT month, SUM(net_revenue) AS rev FROM sales GROUP BY month)"
PER_PRODUCT = """per_product AS (
  SELECT product_id, SUM(net_revenue) AS rev, SUM(profit) AS prof,
         CAST(SUM(quantity) AS BIGINT) AS units FROM sales GROUP BY product_id)"""
PER_CUSTOMER = f"""per_customer AS (
  SELECT customer_id, COUNT(DISTINCT order_id) AS n, SUM(net_revenue) AS spend,
         SUM(profit) AS prof, MIN(order_date) AS first_date, MAX(order_date) AS last_date
  FROM sales WHERE {KNOWN} GROUP BY customer_id)"""
PER_STORE = """per_store AS (
  SELECT store_id, SUM(net_revenue) AS rev, SUM(profit) AS prof,
         COUNT(DISTINCT order_id) AS n, CAST(SUM(quantity) AS BIGINT) AS units
  FROM sales GROUP BY store_id)"""
STORE_MONTH = """store_month AS (
  SELECT month, store_id, SUM(net_revenue) AS rev FROM sales GROUP BY ALL)"""


def basic() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, COUNT(*) AS row_count FROM {n}"
        for n in ("customers", "products", "stores", "sales", "inventory", "returns")
    )
    return {
        "table_row_counts": star_query(counts),
        "discounted_lines": star_query(
            f"""SELECT order_id, order_date, product_id, {dbl('net_revenue')} AS net_revenue,
                       {dbl('discount_pct')} AS discount_pct
                FROM sales WHERE discount_pct > 0 AND net_revenue >= 200
                ORDER BY sales.order_date DESC, sales.net_revenue DESC, order_id, product_id
                LIMIT 25"""
        ),
        "category_catalog": star_query(
            f"""SELECT category, COUNT(*) AS product_count,
                       {r2(mean('unit_price'))} AS average_list_price,
                       {r2(mean('(unit_price - unit_cost)'))} AS average_unit_margin
                FROM products GROUP BY category"""
        ),
        "large_suppliers": star_query(
            f"""SELECT supplier, COUNT(*) AS product_count,
                       {r2(mean('unit_price'))} AS average_price
                FROM products GROUP BY supplier HAVING product_count >= 10"""
        ),
        "lowest_revenue_products": star_query(
            f"""SELECT product_id, product_name, category, COALESCE(units, 0) AS units_sold,
                       {r2('COALESCE(rev, 0)')} AS revenue
                FROM products LEFT JOIN per_product USING (product_id)
                ORDER BY revenue, product_id LIMIT 20""",
            PER_PRODUCT,
        ),
    }


def sales() -> dict[str, str]:
    growth = pct("(rev - prev)", "prev")
    shift = "strftime(CAST(month || '-01' AS DATE) + INTERVAL {} MONTH, '%Y-%m')"
    return {
        "monthly_sales": star_query(
            f"""SELECT month, {dbl('SUM(net_revenue)')} AS revenue, {dbl('SUM(profit)')} AS profit,
                       COUNT(DISTINCT order_id) AS orders, {big('SUM(quantity)')} AS units_sold
                FROM sales GROUP BY month"""
        ),
        "month_over_month": star_query(
            f"""SELECT month, {dbl('rev')} AS revenue, {dbl('prev')} AS previous_month_revenue,
                       {growth} AS growth_pct
                FROM (SELECT *, lag(rev) OVER (ORDER BY month) AS prev FROM monthly)""",
            MONTHLY,
        ),
        "month_over_month_calendar": star_query(
            f"""SELECT m.month, {dbl('m.rev')} AS revenue, {dbl('p.rev')} AS previous_month_revenue,
                       {pct('(m.rev - p.rev)', 'p.rev')} AS growth_pct
                FROM monthly m LEFT JOIN
                     (SELECT {shift.format(1)} AS month, rev FROM monthly) p USING (month)""",
            MONTHLY,
        ),
        "calendar_month_strength": star_query(
            f"""SELECT {big('month(order_date)')} AS month_number,
                       strftime(order_date, '%B') AS month_name,
                       {dbl('SUM(net_revenue)')} AS revenue, COUNT(DISTINCT order_id) AS orders
                FROM sales GROUP BY ALL"""
        ),
        "discount_bands": star_query(
            f"""SELECT CASE WHEN discount_pct <= 0 THEN 'No discount'
                            WHEN discount_pct <= 0.03 THEN '1-3%'
                            WHEN discount_pct <= 0.07 THEN '4-7%' ELSE 'Over 7%' END AS discount_band,
                       COUNT(*) AS sales_lines,
                       {r2(mean('discount_pct') + ' * 100')} AS average_discount_pct,
                       {dbl('SUM(net_revenue)')} AS revenue, {dbl('SUM(profit)')} AS profit,
                       {pct('SUM(profit)', 'SUM(net_revenue)')} AS profit_margin_pct
                FROM sales GROUP BY discount_band"""
        ),
        "running_revenue": star_query(
            f"""SELECT a.month, {dbl('ANY_VALUE(a.rev)')} AS revenue,
                       {dbl('SUM(b.rev)')} AS running_revenue
                FROM monthly a JOIN monthly b ON b.month <= a.month GROUP BY a.month""",
            MONTHLY,
        ),
        "basket_size": star_query(
            f"""SELECT product_lines, COUNT(*) AS orders, {r2(mean('u'))} AS average_units,
                       {r2(mean('v'))} AS average_order_value
                FROM (SELECT order_id, COUNT(*) AS product_lines, SUM(quantity) AS u,
                             SUM(net_revenue) AS v FROM sales GROUP BY order_id, order_date)
                GROUP BY product_lines"""
        ),
        "year_over_year": star_query(
            f"""SELECT month, {dbl('rev')} AS revenue, {dbl('prev')} AS prior_year_revenue,
                       {growth} AS year_over_year_growth_pct
                FROM (SELECT *, lag(rev, 12) OVER (ORDER BY month) AS prev FROM monthly)
                WHERE prev IS NOT NULL""",
            MONTHLY,
        ),
        "year_over_year_calendar": star_query(
            f"""SELECT month, {dbl('rev')} AS revenue, {dbl('prev')} AS prior_year_revenue,
                       {growth} AS year_over_year_growth_pct
                FROM monthly JOIN
                     (SELECT {shift.format(12)} AS month, rev AS prev FROM monthly) USING (month)""",
            MONTHLY,
        ),
    }


def products() -> dict[str, str]:
    named = "per_product JOIN products USING (product_id)"
    desc = "ORDER BY rev DESC, product_id"
    so_far = f"SUM(rev) OVER ({desc} ROWS UNBOUNDED PRECEDING)"
    whole = "(SELECT SUM(net_revenue) FROM sales)"
    returned = "COALESCE(r.u, 0)"
    return {
        "top_products_by_revenue": star_query(
            f"""SELECT product_id, product_name, category, {dbl('rev')} AS revenue, units AS units_sold
                FROM {named} {desc} LIMIT 10""",
            PER_PRODUCT,
        ),
        "top_products_by_profit": star_query(
            f"""SELECT product_id, product_name, category, {dbl('prof')} AS profit,
                       {pct('prof', 'rev')} AS profit_margin_pct
                FROM {named} ORDER BY prof DESC, product_id LIMIT 10""",
            PER_PRODUCT,
        ),
        "slow_catalog_products": star_query(
            f"""SELECT product_id, product_name, category, COALESCE(units, 0) AS units_sold,
                       {r2('COALESCE(rev, 0)')} AS revenue, {r2('COALESCE(prof, 0)')} AS profit
                FROM products LEFT JOIN per_product USING (product_id)
                ORDER BY units_sold, revenue, product_id LIMIT 20""",
            PER_PRODUCT,
        ),
        "high_revenue_low_margin": star_query(
            f"""SELECT product_id, product_name, category, {dbl('rev')} AS revenue,
                       {pct('prof', 'rev')} AS profit_margin_pct
                FROM {named}
                WHERE {dbl('rev')} >= (SELECT {mean('rev')} FROM per_product)
                  AND {ratio('prof', 'rev')} < (SELECT {ratio('SUM(profit)', 'SUM(net_revenue)')} FROM sales)""",
            PER_PRODUCT,
        ),
        "category_performance": star_query(
            f"""SELECT category, {dbl('s.rev')} AS revenue, {dbl('s.prof')} AS profit,
                       {pct('s.prof', 's.rev')} AS profit_margin_pct, s.units AS units_sold,
                       {returned} AS units_returned, {pct(returned, 's.units')} AS return_rate_pct
                FROM (SELECT category, SUM(net_revenue) AS rev, SUM(profit) AS prof,
                             {big('SUM(quantity)')} AS units
                      FROM sales JOIN products USING (product_id) GROUP BY category) s
                LEFT JOIN {_category_units('returns', 'quantity_returned')} r USING (category)"""
        ),
        "product_contribution": star_query(
            f"""SELECT product_id, product_name, category, {dbl('rev')} AS revenue,
                       {big('rank() OVER (ORDER BY rev DESC)')} AS revenue_rank,
                       {pct('rev', whole)} AS revenue_share_pct,
                       {pct(so_far, whole)} AS cumulative_revenue_share_pct
                FROM {named}""",
            PER_PRODUCT,
        ),
        "top_products_per_category": star_query(
            f"""SELECT category, {big('p')} AS category_position, product_id, product_name,
                       {dbl('rev')} AS revenue
                FROM (SELECT *, row_number() OVER (PARTITION BY category {desc}) AS p FROM {named})
                WHERE p <= 3""",
            PER_PRODUCT,
        ),
        "abc_classification": star_query(
            f"""SELECT product_id, product_name, category, {dbl('rev')} AS revenue,
                       {r2('share * 100')} AS cumulative_revenue_share_pct,
                       CASE WHEN share <= 0.80 THEN 'A' WHEN share <= 0.95 THEN 'B' ELSE 'C' END AS abc_class
                FROM (SELECT product_id, rev, {ratio(so_far, whole)} AS share FROM per_product)
                JOIN products USING (product_id)""",
            PER_PRODUCT,
        ),
    }


def stores() -> dict[str, str]:
    company = f"(SELECT {ratio('SUM(profit)', 'SUM(net_revenue)')} FROM sales)"
    in_month = big("rank() OVER (PARTITION BY month ORDER BY rev DESC)")
    return {
        "store_scorecard": star_query(
            f"""SELECT store_id, store_name, city, province, store_type, {dbl('rev')} AS revenue,
                       {dbl('prof')} AS profit, {pct('prof', 'rev')} AS profit_margin_pct, n AS orders,
                       {r2(ratio('rev', 'n'))} AS average_order_value, units AS units_sold,
                       {big('rank() OVER (ORDER BY rev DESC)')} AS revenue_rank
                FROM stores JOIN per_store USING (store_id)""",
            PER_STORE,
        ),
        "province_performance": star_query(
            f"""SELECT province, COUNT(DISTINCT store_id) AS stores,
                       {dbl('SUM(net_revenue)')} AS revenue, {dbl('SUM(profit)')} AS profit,
                       COUNT(DISTINCT order_id) AS orders
                FROM sales JOIN stores USING (store_id) GROUP BY province"""
        ),
        "monthly_store_rank": star_query(
            f"""SELECT month, store_id, store_name, {dbl('rev')} AS revenue,
                       {in_month} AS monthly_revenue_rank
                FROM store_month JOIN stores USING (store_id)""",
            STORE_MONTH,
        ),
        "below_margin_stores": star_query(
            f"""SELECT store_name, {dbl('rev')} AS revenue,
                       {r2(ratio('prof', 'rev') + ' * 100')} AS store_margin_pct,
                       {r2(company + ' * 100')} AS company_margin_pct
                FROM per_store JOIN stores USING (store_id)
                WHERE {ratio('prof', 'rev')} < {company}""",
            PER_STORE,
        ),
        "monthly_store_change": star_query(
            f"""SELECT month, store_name, {dbl('rev')} AS revenue,
                       {dbl('prev')} AS previous_month_revenue,
                       {pct('(rev - prev)', 'prev')} AS growth_pct, store_rank
                FROM (SELECT *, lag(rev) OVER (PARTITION BY store_id ORDER BY month) AS prev,
                             {in_month} AS store_rank FROM store_month)
                JOIN stores USING (store_id)""",
            STORE_MONTH,
        ),
    }


def customers() -> dict[str, str]:
    named = "per_customer JOIN customers USING (customer_id)"
    average = f"(SELECT {mean('spend')} FROM per_customer)"
    return {
        "customer_summary": star_query(
            f"""SELECT COUNT(*) AS unique_customers, {r2(mean('spend'))} AS average_spend_per_customer,
                       {r2(mean('n'))} AS average_orders_per_customer,
                       {pct('COUNT(*) FILTER (n >= 2)', 'COUNT(*)')} AS repeat_customer_rate_pct
                FROM per_customer""",
            PER_CUSTOMER,
        ),
        "customer_frequency_value": star_query(
            f"""SELECT customer_id, customer_name, customer_segment, n AS purchase_frequency,
                       {dbl('spend')} AS total_spend, {r2(ratio('spend', 'n'))} AS average_order_value,
                       first_date AS first_order_date, last_date AS latest_order_date
                FROM {named}""",
            PER_CUSTOMER,
        ),
        "top_customers": star_query(
            f"""SELECT customer_id, customer_name, city, province, n AS orders,
                       {dbl('spend')} AS total_spend, {dbl('prof')} AS gross_profit
                FROM {named} ORDER BY spend DESC, customer_id LIMIT 20""",
            PER_CUSTOMER,
        ),
        "customer_value_segments": star_query(
            f"""SELECT customer_id, customer_name, n AS orders, {dbl('spend')} AS total_spend,
                       CASE WHEN {dbl('spend')} >= {average} * 2 THEN 'High Value'
                            WHEN {dbl('spend')} >= {average} THEN 'Core'
                            ELSE 'Occasional' END AS value_segment
                FROM {named}""",
            PER_CUSTOMER,
        ),
        "new_vs_repeat_orders": star_query(
            f"""SELECT {month('d')} AS month, COUNT(*) FILTER (seq = 1) AS new_customer_orders,
                       COUNT(*) FILTER (seq > 1) AS repeat_customer_orders,
                       {pct('COUNT(*) FILTER (seq > 1)', 'COUNT(*)')} AS repeat_order_share_pct
                FROM (SELECT d, row_number() OVER (PARTITION BY customer_id ORDER BY d, order_id) AS seq
                      FROM (SELECT customer_id, order_id, MIN(order_date) AS d
                            FROM sales WHERE {KNOWN} GROUP BY ALL))
                GROUP BY 1"""
        ),
        "rfm_segments": star_query(
            f"""SELECT customer_id, customer_name, days AS recency_days, n AS frequency,
                       {dbl('spend')} AS monetary_value,
                       CASE WHEN days <= 60 AND n >= 10 THEN 'Champions'
                            WHEN days <= 120 AND n >= 5 THEN 'Active'
                            WHEN days > 180 THEN 'At Risk'
                            ELSE 'Developing' END AS behavioral_segment
                FROM (SELECT *, {big("(SELECT MAX(order_date) FROM sales) - last_date")} AS days
                      FROM per_customer) JOIN customers USING (customer_id)""",
            PER_CUSTOMER,
        ),
    }


def inventory() -> dict[str, str]:
    zero = "COUNT(*) FILTER (closing_stock = 0)"
    return {
        "stockout_rate_by_store": star_query(
            f"""SELECT store_id, store_name, COUNT(*) AS inventory_observations,
                       {zero} AS stockout_observations, {pct(zero, 'COUNT(*)')} AS stockout_rate_pct
                FROM inventory JOIN stores USING (store_id) GROUP BY store_id, store_name"""
        ),
        "stock_by_category": star_query(
            f"""SELECT category, {r2(mean('closing_stock'))} AS average_closing_units,
                       {r2(mean('reorder_level'))} AS average_reorder_level,
                       {big('SUM(units_sold)')} AS recorded_units_sold
                FROM inventory JOIN products USING (product_id) GROUP BY category"""
        ),
        "slow_movers": star_query(
            f"""SELECT product_id, product_name, category, {big('SUM(i.units_sold)')} AS units_sold,
                       {r2(mean('closing_stock'))} AS average_closing_stock,
                       COUNT(*) FILTER (i.units_sold = 0) AS zero_sales_periods
                FROM inventory i JOIN products USING (product_id)
                GROUP BY product_id, product_name, category
                ORDER BY SUM(i.units_sold), average_closing_stock DESC, product_id LIMIT 20"""
        ),
        "high_demand": star_query(
            f"""SELECT product_id, product_name, category, u AS units_sold, demand_rank
                FROM (SELECT *, {big('rank() OVER (ORDER BY u DESC)')} AS demand_rank
                      FROM {_units('inventory', 'units_sold', 'product_id')})
                JOIN products USING (product_id) ORDER BY demand_rank, product_id LIMIT 20"""
        ),
        "below_reorder_latest": star_query(
            """SELECT date, store_name, product_id, product_name, category, closing_stock,
                      reorder_level, reorder_level - closing_stock AS units_below_reorder
               FROM inventory JOIN stores USING (store_id) JOIN products USING (product_id)
               WHERE closing_stock < reorder_level AND date = (SELECT MAX(date) FROM inventory)"""
        ),
        "inventory_turnover": star_query(
            f"""SELECT category, {dbl('cogs')} AS cost_of_goods_sold,
                       {r2('v')} AS average_inventory_value,
                       {r2(ratio('cogs', 'v'))} AS inventory_turnover
                FROM (SELECT category, SUM(cost) AS cogs FROM sales JOIN products USING (product_id)
                      GROUP BY category)
                JOIN (SELECT category, {mean('m')} AS v
                      FROM (SELECT category, date, SUM(closing_stock * unit_cost) AS m
                            FROM inventory JOIN products USING (product_id) GROUP BY ALL)
                      GROUP BY category) USING (category)"""
        ),
    }


def returns() -> dict[str, str]:
    got = "COALESCE(r.u, 0)"
    rate = f"s.u AS units_sold, {got} AS units_returned, {pct(got, 's.u')} AS return_rate_pct"
    return {
        "overall_return_rate": star_query(
            f"""SELECT s.u AS units_sold, r.u AS units_returned, {pct('r.u', 's.u')} AS return_rate_pct
                FROM (SELECT {big('SUM(quantity)')} AS u FROM sales) s,
                     (SELECT {big('SUM(quantity_returned)')} AS u FROM returns) r"""
        ),
        "product_returns": star_query(
            f"""SELECT product_id, product_name, category, {rate}
                FROM products JOIN {_units('sales', 'quantity', 'product_id')} s USING (product_id)
                LEFT JOIN {_units('returns', 'quantity_returned', 'product_id')} r USING (product_id)
                ORDER BY units_returned DESC, return_rate_pct DESC, product_id LIMIT 25"""
        ),
        "category_return_rate": star_query(
            f"""SELECT category, {rate} FROM {_category_units('sales', 'quantity')} s
                LEFT JOIN {_category_units('returns', 'quantity_returned')} r USING (category)"""
        ),
        "return_reasons": star_query(
            f"""SELECT return_reason, COUNT(*) AS return_records,
                       {big('SUM(quantity_returned)')} AS units_returned,
                       {pct('SUM(quantity_returned)', '(SELECT SUM(quantity_returned) FROM returns)')}
                         AS share_of_returned_units_pct
                FROM returns GROUP BY return_reason"""
        ),
        "store_return_rate": star_query(
            f"""SELECT store_name, {rate}
                FROM stores JOIN {_units('sales', 'quantity', 'store_id')} s USING (store_id)
                LEFT JOIN (SELECT store_id, {big('SUM(quantity_returned)')} AS u
                           FROM returns JOIN sales USING (order_id, product_id) GROUP BY store_id) r
                  USING (store_id)"""
        ),
    }


def all_analyses() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (basic, sales, products, stores, customers, inventory, returns):
        out.update(group())
    return out
