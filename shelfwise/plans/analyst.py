"""Analyst questions over the gold tables (Q1-Q10).

Each function takes gold DataFrames and returns a small answer DataFrame.
Top-k answers end with the table key as a tie-break so the cut is
deterministic; percentages and means are exact half-up (see
``shelfwise.functions.rounding``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import TOTAL_MONEY, count_when, half_up_mean, percent, with_total
from shelfwise.functions.rounding import cents

TOP_K = 10


def order_totals(daily: DataFrame) -> DataFrame:
    """Q1: total and cancelled orders, cancel rate, mean of the daily mean order values.

    The last figure is the unweighted mean of the rounded daily means, as
    the daily table publishes it; x07 gives the order-weighted one.
    """
    return daily.agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("cancelled_orders").alias("total_cancelled_orders"),
        percent(F.sum("cancelled_orders"), F.sum("total_orders"), 2).alias("cancel_rate_pct"),
        half_up_mean(F.sum(cents("avg_order_value")), F.count("avg_order_value"), 2)
        .alias("overall_avg_order_value"),
    )


def daily_trend(daily: DataFrame, days: int = TOP_K) -> DataFrame:
    """Q2: the first ``days`` days."""
    return (
        daily.select("order_date", "total_orders", "cancelled_orders", "avg_order_value")
        .orderBy(F.asc_nulls_last("order_date"))
        .limit(days)
    )


def top_products(perf: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q3: top products by revenue."""
    return (
        perf.select("product_id", "product_name", "category", "units_sold", "revenue")
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("product_id"))
        .limit(k)
    )


def category_share(categories: DataFrame) -> DataFrame:
    """Q4: categories with their share of total revenue (1 dp).

    The total comes from the category rows themselves, so the tables under
    them are read once.
    """
    return (
        with_total(categories.select("category", "units_sold", "revenue"), "revenue").select(
            "category", "units_sold", "revenue",
            percent("revenue", "_total", 1).alias("pct_of_total_revenue"),
        )
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_last("category"))
    )


def stockout_rate(health: DataFrame) -> DataFrame:
    """Q5: products, stocked-out products and their share (2 dp)."""
    return health.agg(
        F.count(F.lit(1)).alias("total_products"),
        count_when(F.col("is_stock_out")).alias("stocked_out_products"),
        percent(count_when(F.col("is_stock_out")), F.count(F.lit(1)), 2).alias("stock_out_rate_pct"),
    )


def urgent_restock(health: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q6: low-stock products with the highest demand."""
    return (
        health.filter(F.col("is_low_stock"))
        .select("product_id", "product_name", "category", "total_stock", "total_demand")
        .orderBy(F.desc_nulls_last("total_demand"), F.asc_nulls_last("product_id"))
        .limit(k)
    )


def store_delivery(delivery: DataFrame) -> DataFrame:
    """Q7: stores, slowest first."""
    return (
        delivery.select("store_id", "total_orders", "avg_delivery_minutes",
                        "late_deliveries", "late_delivery_pct")
        .orderBy(F.desc_nulls_last("avg_delivery_minutes"), F.asc_nulls_last("store_id"))
    )


def late_rate(delivery: DataFrame) -> DataFrame:
    """Q8: overall late-delivery share (2 dp)."""
    return delivery.agg(
        F.sum("total_orders").alias("total_orders"),
        F.sum("late_deliveries").alias("total_late_deliveries"),
        percent(F.sum("late_deliveries"), F.sum("total_orders"), 2).alias("overall_late_pct"),
    )


def top_areas(locations: DataFrame, k: int = TOP_K) -> DataFrame:
    """Q9: top areas by revenue."""
    return (
        locations.select("city", "area", "total_orders", "total_revenue")
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("city"), F.asc_nulls_last("area"))
        .limit(k)
    )


def city_revenue(locations: DataFrame) -> DataFrame:
    """Q10: revenue rolled up from areas to cities."""
    return (
        locations.groupBy("city")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.sum("total_revenue").cast(TOTAL_MONEY).alias("total_revenue"),
        )
        .orderBy(F.desc_nulls_last("total_revenue"), F.asc_nulls_last("city"))
    )


QUESTIONS = {
    "q01_order_totals": ("daily_orders", order_totals),
    "q02_daily_trend": ("daily_orders", daily_trend),
    "q03_top_products": ("product_performance", top_products),
    "q04_category_share": ("category_performance", category_share),
    "q05_stockout_rate": ("inventory_health", stockout_rate),
    "q06_urgent_restock": ("inventory_health", urgent_restock),
    "q07_store_delivery": ("delivery_performance", store_delivery),
    "q08_late_rate": ("delivery_performance", late_rate),
    "q09_top_areas": ("location_insights", top_areas),
    "q10_city_revenue": ("location_insights", city_revenue),
}


def answer_all(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every analyst question over a dict of gold tables (lazy)."""
    return {name: fn(gold[table]) for name, (table, fn) in QUESTIONS.items()}
