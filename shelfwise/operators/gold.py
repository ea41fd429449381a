"""Gold layer: business metric tables.

Shape rules used throughout, chosen for fact tables far larger than memory:

* aggregate before joining: facts are reduced to one row per join key
  (map-side partial aggregation collapses hot keys before any shuffle), so
  no join ever sees a skewed key from the fact side;
* no broadcast hints: with AQE a side is broadcast only when its measured
  size is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; larger
  sides stay a sort-merge join, and skewed partitions are split by AQE;
* money stays exact decimal, in the written gold tables too, and rounded
  averages and percentages use exact half-up integer arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import TOTAL_MONEY, count_when, half_up_mean, line_total, percent

# Stock below this (summed over stores) is low; deliveries
# over this many minutes are late.
LOW_STOCK_THRESHOLD = 10
LATE_DELIVERY_MINUTES = 45


def order_value(order_items: DataFrame) -> DataFrame:
    """order_id -> exact sum(quantity * unit_price) (DECIMAL)."""
    return order_items.groupBy("order_id").agg(F.sum(line_total()).alias("order_value"))


def orders_with_value(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every order with its value; orders without items keep a NULL value.

    Both sides are hash-partitioned on order_id, so the left join needs no
    further exchange after the item aggregate.
    """
    return join_order_values(orders, order_value(order_items))


def daily_orders(orders_valued: DataFrame) -> DataFrame:
    """G1: per order date: orders, cancellations, mean order value (2 dp).

    Cancelled and returned orders count everywhere; an order without items
    counts as an order but not in the mean.
    """
    return (
        orders_valued.groupBy("order_date")
        .agg(
            F.count("order_id").alias("total_orders"),
            count_when(F.col("order_status") == "Cancelled").alias("cancelled_orders"),
            F.sum("order_value").alias("_value"),
            F.count("order_value").alias("_valued"),
        )
        .select(
            "order_date", "total_orders", "cancelled_orders",
            half_up_mean("_value", "_valued", 2).alias("avg_order_value"),
        )
    )


def product_sales(order_items: DataFrame) -> DataFrame:
    """Per product: units sold and exact revenue. Shared by G2, G3 and G4."""
    return order_items.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum(line_total()).alias("revenue"),
    )


def join_order_values(orders: DataFrame, values: DataFrame) -> DataFrame:
    """Orders with their value (NULL without items), from a per-order value table."""
    cols = ["order_id", "customer_id", "order_date", "order_status", "store_id", "delivery_time_minutes"]
    return orders.select(*cols).join(values, on="order_id", how="left")


def product_performance(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Product sales with product attributes.

    Items whose product is missing keep NULL attributes (the gate's
    not-null rule on product_name catches them).
    """
    dims = products.select("product_id", "product_name", "category", "brand")
    return sales.join(dims, on="product_id", how="left").select(
        "product_id", "product_name", "category", "brand", "units_sold",
        F.col("revenue").cast(TOTAL_MONEY).alias("revenue"))


def category_performance(product_perf: DataFrame) -> DataFrame:
    """Roll-up of product performance by category, by revenue.

    Revenue is still exact decimal money here, so the result does not depend
    on the order in which partial sums arrive.
    """
    return (
        product_perf.groupBy("category")
        .agg(
            F.sum("units_sold").alias("units_sold"),
            F.sum("revenue").cast(TOTAL_MONEY).alias("revenue"),
        )
    )


def latest_snapshot(inventory: DataFrame, latest: str | None = None) -> DataFrame:
    """Inventory rows on the single latest snapshot date.

    ``latest`` is that date where it is known already, as from the partitions
    of a written layer: the comparison is then with a literal, so the plan
    lists one partition and opens no other. Without it the date is an
    uncorrelated scalar subquery evaluated inside the plan (no driver round
    trip). NULL dates are no snapshot; a table without a date gives no rows.
    """
    day = inventory.agg(F.max("inventory_date")).scalar() if latest is None else F.lit(latest).cast("date")
    return inventory.filter(F.col("inventory_date") == day)


def inventory_health(inventory: DataFrame, sales: DataFrame, products: DataFrame,
                     low_stock: int = LOW_STOCK_THRESHOLD, latest: str | None = None) -> DataFrame:
    """Stock on the latest snapshot vs total demand, with stock flags.

    Stock is summed over all stores; pairs absent on the latest date are
    not included (see x12 for them). ``is_low_stock`` includes stock-outs.
    ``latest`` is the latest snapshot's date where it is known.
    """
    stock = latest_snapshot(inventory, latest).groupBy("product_id").agg(
        F.sum("stock_quantity").alias("total_stock"))
    demand = sales.select("product_id", F.col("units_sold").alias("total_demand"))
    dims = products.select("product_id", "product_name", "category")
    return (
        stock.join(demand, on="product_id", how="left")
        .join(dims, on="product_id", how="left")
        .fillna({"total_demand": 0})
        .select(
            "product_id", "product_name", "category", "total_stock", "total_demand",
            (F.col("total_stock") < low_stock).alias("is_low_stock"),
            (F.col("total_stock") == 0).alias("is_stock_out"),
        )
    )


def delivery_performance(orders: DataFrame, late_after: int = LATE_DELIVERY_MINUTES) -> DataFrame:
    """Per store: orders, mean delivery minutes (1 dp), late count and share.

    Late means strictly over ``late_after`` minutes; the share's denominator
    is every order of the store.
    """
    minutes = F.col("delivery_time_minutes")
    return (
        orders.groupBy("store_id")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(minutes).alias("_minutes"),
            F.count(minutes).alias("_timed"),
            count_when(minutes > late_after).alias("late_deliveries"),
        )
        .select(
            "store_id", "total_orders",
            half_up_mean("_minutes", "_timed", 1).alias("avg_delivery_minutes"),
            "late_deliveries",
            percent("late_deliveries", "total_orders", 1).alias("late_delivery_pct"),
        )
    )


def location_insights(orders_valued: DataFrame, customers: DataFrame) -> DataFrame:
    """Per (city, area): orders and revenue.

    Orders are first reduced to one row per customer, then joined to the
    customer dimension: a customer holding a third of all orders is
    collapsed map-side instead of skewing the join. Counts and sums
    distribute over the join, so duplicate customer rows still fan out
    exactly as a row-level join would.
    """
    per_customer = orders_valued.groupBy("customer_id").agg(
        F.count("order_id").alias("_orders"),
        F.sum("order_value").alias("_value"),
    )
    return _locations(per_customer, customers)


def _locations(per_customer: DataFrame, customers: DataFrame) -> DataFrame:
    """Per-customer order counts and values rolled up to (city, area)."""
    dims = customers.select("customer_id", "city", "area")
    return (
        per_customer.join(dims, on="customer_id", how="left")
        .groupBy("city", "area")
        .agg(
            F.sum("_orders").alias("total_orders"),
            F.sum("_value").cast(TOTAL_MONEY).alias("total_revenue"),
        )
    )


# Grouping-set ids of ``order_rollups``: grouping_id over (order_date,
# customer_id, store_id), one bit per column left out of the set.
_BY_DATE, _BY_CUSTOMER, _BY_STORE = 0b011, 0b101, 0b110


def order_rollups(orders_valued: DataFrame, late_after: int = LATE_DELIVERY_MINUTES) -> DataFrame:
    """Order counts, values and delivery times per date, per customer and per store, in one pass.

    G1, G5 and G6 all aggregate the orders; grouping sets compute the three
    groupings from a single scan of the orders joined to their values, so
    the file pipeline reads orders once and caches this aggregate (one row
    per date, customer and store) instead of a row per order.
    """
    minutes = F.col("delivery_time_minutes")
    return (
        orders_valued.groupingSets([["order_date"], ["customer_id"], ["store_id"]],
                                   "order_date", "customer_id", "store_id")
        .agg(
            F.count("order_id").alias("_orders"),
            count_when(F.col("order_status") == "Cancelled").alias("_cancelled"),
            F.sum("order_value").alias("_value"),
            F.count("order_value").alias("_valued"),
            F.sum(minutes).alias("_minutes"),
            F.count(minutes).alias("_timed"),
            count_when(minutes > late_after).alias("_late"),
            F.grouping_id().alias("_set"),
        )
    )


def daily_orders_from_rollups(rollups: DataFrame) -> DataFrame:
    """G1 from :func:`order_rollups` (same rows as :func:`daily_orders`)."""
    return rollups.filter(F.col("_set") == _BY_DATE).select(
        "order_date",
        F.col("_orders").alias("total_orders"),
        F.col("_cancelled").alias("cancelled_orders"),
        half_up_mean("_value", "_valued", 2).alias("avg_order_value"),
    )


def delivery_performance_from_rollups(rollups: DataFrame) -> DataFrame:
    """G5 from :func:`order_rollups` (same rows as :func:`delivery_performance`)."""
    return rollups.filter(F.col("_set") == _BY_STORE).select(
        "store_id",
        F.col("_orders").alias("total_orders"),
        half_up_mean("_minutes", "_timed", 1).alias("avg_delivery_minutes"),
        F.col("_late").alias("late_deliveries"),
        percent("_late", "_orders", 1).alias("late_delivery_pct"),
    )


def location_insights_from_rollups(rollups: DataFrame, customers: DataFrame) -> DataFrame:
    """G6 from :func:`order_rollups` (same rows as :func:`location_insights`)."""
    per_customer = rollups.filter(F.col("_set") == _BY_CUSTOMER).select("customer_id", "_orders", "_value")
    return _locations(per_customer, customers)


# Presentation order of each published gold table, applied once at the sink
# (the key comes last so the order is total): (column, descending).
GOLD_ORDER = {
    "daily_orders": [("order_date", False)],
    "product_performance": [("revenue", True), ("product_id", False)],
    "category_performance": [("revenue", True), ("category", False)],
    "inventory_health": [("total_stock", False), ("product_id", False)],
    "delivery_performance": [("avg_delivery_minutes", True), ("store_id", False)],
    "location_insights": [("total_revenue", True), ("city", False), ("area", False)],
}


def presented(name: str, df: DataFrame) -> DataFrame:
    """A gold table in its published order (NULLs last)."""
    return df.orderBy(*[F.desc_nulls_last(c) if desc else F.asc_nulls_last(c)
                        for c, desc in GOLD_ORDER[name]])


def build_gold(silver: dict[str, DataFrame], rollups: DataFrame | None = None,
               sales: DataFrame | None = None, latest: str | None = None) -> dict[str, DataFrame]:
    """All six gold tables from the silver ones (lazy, unordered).

    ``rollups`` (:func:`order_rollups`) and ``sales`` (:func:`product_sales`)
    are the two shared intermediates; pass persisted copies so the item
    table is scanned and shuffled once per intermediate instead of once per
    consumer. ``latest`` is the latest snapshot's date where it is known.
    """
    if rollups is None:
        rollups = order_rollups(orders_with_value(silver["orders"], silver["order_items"]))
    if sales is None:
        sales = product_sales(silver["order_items"])
    return {
        "daily_orders": daily_orders_from_rollups(rollups),
        "product_performance": product_performance(sales, silver["products"]),
        "category_performance": category_performance(product_performance(sales, silver["products"])),
        "inventory_health": inventory_health(silver["inventory"], sales, silver["products"], latest=latest),
        "delivery_performance": delivery_performance_from_rollups(rollups),
        "location_insights": location_insights_from_rollups(rollups, silver["customers"]),
    }
