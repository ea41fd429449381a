"""The analyst questions (Q1-Q10) as Spark SQL over the gold views.

Same answers as ``plans.analyst`` (a test holds them equal), for users who
keep their questions as SQL text. Rounded figures use the same exact
half-up integer arithmetic: ``(2 * n + d) DIV (2 * d)`` on the scaled
numerator. Shares of a total use a scalar subquery, not a window over the
whole relation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.sources.io import register_views


def _pct(part: str, whole: str, scale: int) -> str:
    """SQL for round(part * 100 / whole, scale), half-up, for non-negative integral inputs."""
    factor = 100 * 10 ** scale
    return (f"CAST((2 * {factor} * {part} + {whole}) DIV NULLIF(2 * {whole}, 0) AS DOUBLE)"
            f" / {10 ** scale}")


_CENTS = "CAST({} AS DECIMAL(38,2))"
_TOTAL_REVENUE = "(SELECT SUM(CAST(revenue AS DECIMAL(38,2))) FROM category_performance)"

QUESTION_SQL = {
    "q01_order_totals": f"""
        SELECT SUM(total_orders) AS total_orders,
               SUM(cancelled_orders) AS total_cancelled_orders,
               {_pct('SUM(cancelled_orders)', 'SUM(total_orders)', 2)} AS cancel_rate_pct,
               CAST((2 * SUM({_CENTS.format('avg_order_value')}) * 100 + COUNT(avg_order_value))
                    DIV NULLIF(2 * COUNT(avg_order_value), 0) AS DOUBLE) / 100 AS overall_avg_order_value
        FROM daily_orders""",
    "q02_daily_trend": """
        SELECT order_date, total_orders, cancelled_orders, avg_order_value
        FROM daily_orders
        ORDER BY order_date ASC NULLS LAST
        LIMIT 10""",
    "q03_top_products": """
        SELECT product_id, product_name, category, units_sold, revenue
        FROM product_performance
        ORDER BY revenue DESC NULLS LAST, product_id ASC NULLS LAST
        LIMIT 10""",
    "q04_category_share": f"""
        SELECT category, units_sold, revenue,
               CAST((2 * 1000 * {_CENTS.format('revenue')} + {_TOTAL_REVENUE})
                    DIV NULLIF(2 * {_TOTAL_REVENUE}, 0) AS DOUBLE) / 10 AS pct_of_total_revenue
        FROM category_performance
        ORDER BY revenue DESC NULLS LAST, category ASC NULLS LAST""",
    "q05_stockout_rate": f"""
        SELECT COUNT(*) AS total_products,
               COUNT_IF(is_stock_out) AS stocked_out_products,
               {_pct('COUNT_IF(is_stock_out)', 'COUNT(*)', 2)} AS stock_out_rate_pct
        FROM inventory_health""",
    "q06_urgent_restock": """
        SELECT product_id, product_name, category, total_stock, total_demand
        FROM inventory_health
        WHERE is_low_stock
        ORDER BY total_demand DESC NULLS LAST, product_id ASC NULLS LAST
        LIMIT 10""",
    "q07_store_delivery": """
        SELECT store_id, total_orders, avg_delivery_minutes, late_deliveries, late_delivery_pct
        FROM delivery_performance
        ORDER BY avg_delivery_minutes DESC NULLS LAST, store_id ASC NULLS LAST""",
    "q08_late_rate": f"""
        SELECT SUM(total_orders) AS total_orders,
               SUM(late_deliveries) AS total_late_deliveries,
               {_pct('SUM(late_deliveries)', 'SUM(total_orders)', 2)} AS overall_late_pct
        FROM delivery_performance""",
    "q09_top_areas": """
        SELECT city, area, total_orders, total_revenue
        FROM location_insights
        ORDER BY total_revenue DESC NULLS LAST, city ASC NULLS LAST, area ASC NULLS LAST
        LIMIT 10""",
    "q10_city_revenue": f"""
        SELECT city, SUM(total_orders) AS total_orders,
               CAST(SUM(total_revenue) AS DECIMAL(38,2)) AS total_revenue
        FROM location_insights
        GROUP BY city
        ORDER BY total_revenue DESC NULLS LAST, city ASC NULLS LAST""",
}


def ask(spark: SparkSession, name: str) -> DataFrame:
    """One question as Spark SQL; the gold tables must be registered as views."""
    return spark.sql(QUESTION_SQL[name])


def ask_all(spark: SparkSession, gold: dict[str, DataFrame] | None = None) -> dict[str, DataFrame]:
    """Every question as Spark SQL, registering ``gold`` as views first when given."""
    if gold is not None:
        register_views(spark, gold)
    return {name: ask(spark, name) for name in QUESTION_SQL}
