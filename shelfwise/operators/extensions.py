"""Extensions (X1-X12): metrics the source pipeline names or implies but does
not compute (README targets, patterns its data simulator plants, and gaps in
its gold logic). All are ordinary DataFrame work over silver tables; facts
are pre-aggregated to the join key before any join, and what depends on
ranks needs the rows at a few of them only (see ``cuts``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions import count_when, half_up_mean, half_up_ratio, percent, published, with_total
from shelfwise.operators.cuts import cut_keys, key_of, keyed, segment, whole_part
from shelfwise.operators.gold import LATE_DELIVERY_MINUTES
from shelfwise.operators.repeats import may_be_in, set_of

# The simulator's delay cut-off for cancellations and the
# default parameters of the concentration and slow-store rules.
CANCEL_DELAY_MINUTES = 55
TOP_SHARE_PCT = 20
SLOW_STORE_SIGMAS = 2.0
DECILES = 10


def demand_concentration(sales: DataFrame, top_pct: int = TOP_SHARE_PCT) -> DataFrame:
    """Units sold by the top ``top_pct``% of products vs the rest.

    Products are ordered by (units desc, product_id); the top segment is the
    first floor(n * top_pct / 100) of them. The number of units at its end is
    found by histograms (:mod:`shelfwise.operators.cuts`), so nothing is
    sorted; products with just that number are alike here, whichever of them
    are in the top segment.
    """
    rows = keyed(sales.select("units_sold"), [("units_sold", True)])
    last = cut_keys(rows, 1, lambda cut, n: whole_part(n * top_pct, F.lit(100))).select(F.struct("key", "taken").alias("x")).scalar()
    side = F.when(key_of(rows) < last["key"], 0).when(key_of(rows) == last["key"], 1).otherwise(2)
    name, n, units, one = F.lit(f"top_{top_pct}pct"), F.col("_n"), F.col("_units"), F.col("_one")

    def part(segment: Column, products: Column, units: Column) -> Column:
        return F.struct(segment.alias("segment"), products.alias("products"), units.alias("units"))

    taken = last["taken"]
    shares = (F.when(F.col("_side") == 0, F.array(part(name, n, units)))
              .when(F.col("_side") == 1, F.array(part(name, taken, taken * one), part(F.lit("other"), n - taken, (n - taken) * one)))
              .otherwise(F.array(part(F.lit("other"), n, units))))
    segments = (
        rows.groupBy(side.alias("_side"))
        .agg(F.count(F.lit(1)).alias("_n"), F.sum("units_sold").alias("_units"), F.max("units_sold").alias("_one"))
        .select(F.explode(shares).alias("x")).select("x.*").filter(F.col("products") > 0)
        .groupBy("segment").agg(F.sum("products").alias("products"), F.sum("units").alias("units"))
    )
    return with_total(segments, "units").select("segment", "products", "units", percent("units", "_total", 2).alias("units_share_pct"))


def hour_of_day(time: Column, dtype: T.DataType) -> Column:
    """Hour from a timestamp, or from an ``H:MM[:SS]`` string column.

    A string that is not a time of day gives NULL (``try_cast``) rather
    than failing the job under ANSI mode.
    """
    if isinstance(dtype, T.StringType):
        hour = F.split(F.trim(time), ":").getItem(0).try_cast("int")
        return F.when(hour.between(0, 23), hour)
    return F.hour(time)


def orders_by_hour(orders: DataFrame, time_col: str = "order_time") -> DataFrame:
    """Orders per hour of day with their share (1 dp); unknown times excluded."""
    hour = hour_of_day(F.col(time_col), orders.schema[time_col].dataType)
    hourly = orders.select(hour.alias("hour")).filter(F.col("hour").isNotNull())
    return (
        with_total(hourly.groupBy("hour").agg(F.count(F.lit(1)).alias("orders")), "orders")
        .select("hour", "orders", percent("orders", "_total", 1).alias("pct_of_orders"))
        .orderBy("hour")
    )


def slow_stores(orders: DataFrame, sigmas: float = SLOW_STORE_SIGMAS) -> DataFrame:
    """Stores whose mean delivery time exceeds the mean of store means + k sd.

    Two-step aggregate; the threshold is a scalar subquery, not a join.
    """
    minutes = F.col("delivery_time_minutes")
    per_store = orders.groupBy("store_id").agg(F.sum(minutes).alias("_s"), F.count(minutes).alias("_c"))
    per_store = per_store.withColumn("_mean", F.col("_s") / F.col("_c"))
    threshold = per_store.agg(F.avg("_mean") + F.lit(sigmas) * F.stddev_samp("_mean")).scalar()
    return (
        per_store.filter(F.col("_mean") > threshold)
        .select("store_id", half_up_mean("_s", "_c", 1).alias("avg_delivery_minutes"))
        .orderBy(F.desc("avg_delivery_minutes"), "store_id")
    )


def cancel_by_delay(orders: DataFrame, cutoff: int = CANCEL_DELAY_MINUTES) -> DataFrame:
    """Cancellation rate (2 dp) for deliveries up to and over ``cutoff`` minutes."""
    minutes = F.col("delivery_time_minutes")
    band = F.when(minutes > cutoff, F.lit(f">{cutoff}")).when(minutes.isNotNull(), F.lit(f"<={cutoff}"))
    return (
        orders.select(band.alias("delay_band"), "order_status")
        .filter(F.col("delay_band").isNotNull())
        .groupBy("delay_band")
        .agg(F.count(F.lit(1)).alias("orders"),
             count_when(F.col("order_status") == "Cancelled").alias("cancelled"))
        .select("delay_band", "orders", "cancelled",
                percent("cancelled", "orders", 2).alias("cancel_rate_pct"))
    )


def duplicate_keys(customers: DataFrame, products: DataFrame) -> DataFrame:
    """Ids that repeat, and ids whose rows differ (would fan out a join).

    Customers are compared after the silver fill of ``area``, since rows
    equal after filling collapse in cleaning.
    """
    frames = []
    for name, df, key in (("customers", customers.fillna({"area": "Unknown"}), "customer_id"),
                          ("products", products, "product_id")):
        # a key of one row needs no look at it: the large shuffle moves keys and counts alone
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        often = set_of(per_key.filter(F.col("_n") > 1).select(F.xxhash64(key).alias("_h")), "_h")
        rows = df.filter(may_be_in(often, F.xxhash64(key))).groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_c"))
        conflicting = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_different")).agg(
            count_when(F.col("_different") > 1).alias("conflicting_keys"))
        counts = per_key.agg(F.count(F.lit(1)).alias("keys"), count_when(F.col("_n") > 1).alias("repeated_keys"))
        frames.append(counts.select(F.lit(name).alias("table_name"), "keys", "repeated_keys",
                                    conflicting.scalar().alias("conflicting_keys")))
    return frames[0].unionByName(frames[1])


def latest_per_pair(inventory: DataFrame) -> DataFrame:
    """Stock on each (store, product)'s own latest snapshot, summed per product.

    All rows of a pair on its latest date count (a pair can repeat within a
    snapshot). Two aggregates, both with map-side combine: stock per
    (pair, date), then the latest date's stock per pair via ``max_by``
    (fixed-width buffers, so it stays a hash aggregate). Rows without a
    snapshot date never count as the latest.
    """
    dated = inventory.filter(F.col("inventory_date").isNotNull())
    per_day = dated.groupBy("store_id", "product_id", "inventory_date").agg(
        F.sum("stock_quantity").alias("_stock"))
    per_pair = per_day.groupBy("store_id", "product_id").agg(
        F.max_by("_stock", "inventory_date").alias("_stock"))
    return per_pair.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("stores"),
        F.sum("_stock").alias("total_stock"),
    )


def weighted_aov(orders_valued: DataFrame) -> DataFrame:
    """Order-weighted average order value over all orders with items."""
    return orders_valued.agg(
        F.count("order_id").alias("orders"),
        F.count("order_value").alias("valued_orders"),
        published(F.sum("order_value")).alias("revenue"),
        half_up_mean(F.sum("order_value"), F.count("order_value"), 2).alias("avg_order_value"),
    )


def delivery_by_location(orders: DataFrame, customers: DataFrame,
                         late_after: int = LATE_DELIVERY_MINUTES) -> DataFrame:
    """Delivery performance per (city, area); orders pre-aggregated per customer."""
    minutes = F.col("delivery_time_minutes")
    per_customer = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("_o"), F.sum(minutes).alias("_s"),
        F.count(minutes).alias("_c"), count_when(minutes > late_after).alias("_l"))
    dims = customers.select("customer_id", "city", "area")
    return (
        per_customer.join(dims, on="customer_id", how="left")
        .groupBy("city", "area")
        .agg(F.sum("_o").alias("total_orders"), F.sum("_s").alias("_s"),
             F.sum("_c").alias("_c"), F.sum("_l").alias("late_deliveries"))
        .select("city", "area", "total_orders",
                half_up_mean("_s", "_c", 1).alias("avg_delivery_minutes"),
                "late_deliveries",
                percent("late_deliveries", "total_orders", 1).alias("late_delivery_pct"))
    )


def demand_by_area(order_items: DataFrame, orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Units sold per (city, area), items of orders that survived cleaning only.

    Units are reduced per order, then per customer, before meeting the
    customer dimension.
    """
    per_order = order_items.groupBy("order_id").agg(F.sum("quantity").alias("_u"))
    per_customer = (
        per_order.join(orders.select("order_id", "customer_id"), on="order_id")
        .groupBy("customer_id").agg(F.sum("_u").alias("_u"))
    )
    dims = customers.select("customer_id", "city", "area")
    return (
        per_customer.join(dims, on="customer_id", how="left")
        .groupBy("city", "area").agg(F.sum("_u").alias("units_sold"))
    )


def demand_stock_ratio(health: DataFrame) -> DataFrame:
    """Demand vs current stock per product (2 dp; NULL when stock is 0)."""
    return health.select(
        "product_id", "product_name", "total_stock", "total_demand",
        half_up_ratio("total_demand", "total_stock", 2).alias("demand_to_stock"),
    )


def stockout_by_decile(health: DataFrame, buckets: int = DECILES) -> DataFrame:
    """X11: stock-out rate per popularity decile (decile 1 = highest demand)."""
    rows = keyed(health.select("product_id", "total_demand", "is_stock_out"), [("total_demand", True), ("product_id", False)])
    # as ntile: the first n % buckets of them hold one row more than the others
    ends = cut_keys(rows, buckets - 1, lambda cut, n: cut * whole_part(n, F.lit(buckets)) + F.least(cut, n % buckets))
    return (
        rows.groupBy(segment(rows, ends, buckets - 1).alias("decile"))
        .agg(F.count(F.lit(1)).alias("products"),
             count_when(F.col("is_stock_out")).alias("stocked_out"))
        .select("decile", "products", "stocked_out",
                percent("stocked_out", "products", 2).alias("stock_out_rate_pct"))
        .orderBy("decile")
    )


def missing_snapshots(inventory: DataFrame) -> DataFrame:
    """(store, product) pairs seen before but absent from the latest snapshot.

    These are the rows the gold stock metric silently drops. A pair is absent
    on the latest date exactly when its own last (dated) snapshot is earlier,
    so this is one aggregate and a scalar comparison: no grid, no join. NULL
    keys form pairs of their own; rows without a date are not snapshots.
    """
    latest = inventory.agg(F.max("inventory_date")).scalar()
    return (
        inventory.groupBy("store_id", "product_id")
        .agg(F.max("inventory_date").alias("last_seen"))
        .filter(F.col("last_seen") < latest)
    )


__all__ = [
    "demand_concentration", "orders_by_hour", "slow_stores", "cancel_by_delay", "duplicate_keys",
    "latest_per_pair", "weighted_aov", "delivery_by_location", "demand_by_area",
    "demand_stock_ratio", "stockout_by_decile", "missing_snapshots",
]
