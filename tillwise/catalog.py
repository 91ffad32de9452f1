"""Every analysis by name: ``op(tables) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from tillwise.model import RetailTables
from tillwise.operators import basic, customers, inventory, products, returns, sales, stores

Analysis = Callable[[RetailTables], DataFrame]

ANALYSES: dict[str, Analysis] = {
    op.__name__: op
    for op in (
        basic.table_row_counts,
        basic.discounted_lines,
        basic.category_catalog,
        basic.large_suppliers,
        basic.lowest_revenue_products,
        sales.monthly_sales,
        sales.month_over_month,
        sales.calendar_month_strength,
        sales.discount_bands,
        sales.running_revenue,
        sales.basket_size,
        products.top_products_by_revenue,
        products.top_products_by_profit,
        products.slow_catalog_products,
        products.high_revenue_low_margin,
        products.category_performance,
        products.product_contribution,
        stores.store_scorecard,
        stores.province_performance,
        stores.monthly_store_rank,
        stores.below_margin_stores,
        customers.customer_summary,
        customers.customer_frequency_value,
        customers.top_customers,
        customers.customer_value_segments,
        customers.new_vs_repeat_orders,
        inventory.stockout_rate_by_store,
        inventory.stock_by_category,
        inventory.slow_movers,
        inventory.high_demand,
        inventory.below_reorder_latest,
        inventory.inventory_turnover,
        returns.overall_return_rate,
        returns.product_returns,
        returns.category_return_rate,
        returns.return_reasons,
        returns.store_return_rate,
        products.top_products_per_category,
        stores.monthly_store_change,
        products.abc_classification,
        sales.year_over_year,
        customers.rfm_segments,
    )
}
