"""Declared schemas for the bronze CSVs and the published gold tables.

Declaring types avoids the inference pass and its surprises: ``order_time``
would infer as a timestamp dated on the run day, and ``store_id`` is written
as ``3.0`` because nulls make it float, so it is read as double and cast to
int during cleaning (reading it as int would null every value).
"""

from __future__ import annotations

from pyspark.sql import types as T

BRONZE = {
    "customers": T.StructType([
        T.StructField("customer_id", T.LongType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("area", T.StringType()),
        T.StructField("signup_date", T.DateType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.LongType()),
        T.StructField("product_name", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("brand", T.StringType()),
        T.StructField("price", T.DecimalType(22, 4)),
    ]),
    "orders": T.StructType([
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("order_date", T.DateType()),
        T.StructField("order_time", T.StringType()),
        T.StructField("store_id", T.DoubleType()),
        T.StructField("delivery_time_minutes", T.IntegerType()),
        T.StructField("order_status", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_item_id", T.LongType()),
        T.StructField("order_id", T.LongType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("quantity", T.LongType()),
        T.StructField("unit_price", T.DecimalType(22, 4)),
    ]),
    "inventory": T.StructType([
        T.StructField("inventory_date", T.DateType()),
        T.StructField("store_id", T.IntegerType()),
        T.StructField("product_id", T.LongType()),
        T.StructField("stock_quantity", T.LongType()),
    ]),
}

TABLES = tuple(BRONZE)

GOLD_TABLES = (
    "daily_orders",
    "product_performance",
    "category_performance",
    "inventory_health",
    "delivery_performance",
    "location_insights",
)

# The gold quality rules (table -> key columns that must not be
# null, numeric columns that must not be negative).
GOLD_RULES = {
    "daily_orders": (["order_date"], ["total_orders", "cancelled_orders"]),
    "product_performance": (["product_id", "product_name", "category"], ["units_sold", "revenue"]),
    "category_performance": (["category"], ["units_sold", "revenue"]),
    "inventory_health": (["product_id", "product_name"], ["total_stock", "total_demand"]),
    "delivery_performance": (["store_id"], ["total_orders", "avg_delivery_minutes", "late_deliveries"]),
    "location_insights": (["city", "area"], ["total_orders", "total_revenue"]),
}
