"""Mergeable state of the aggregates: partial sums that new bronze rows are added to.

The gold metrics of orders and items (G1 to G6) and the latest stock per
pair (X6, X12) are sums, counts and maxima. Their state is a small table each,
a row a date, customer, store, product or (store, product) pair, and holds
what merges: exact sums and counts instead of means, the last date and its
stock instead of a list of snapshots. Adding a batch of new rows is an
aggregate of that batch and one aggregate of state rows; no earlier fact is
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import gold

#: State tables and their keys; all other columns of the first two are added up.
STATE_KEYS = {
    "order_sums": ["order_date", "customer_id", "store_id", "_set"],
    "product_sums": ["product_id"],
    "pair_stock": ["store_id", "product_id"],
}


def order_sums(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders, values and delivery times per date, per customer and per store (:func:`gold.order_rollups`)."""
    return gold.order_rollups(gold.orders_with_value(orders, order_items))


def pair_stock(inventory: DataFrame) -> DataFrame:
    """(store_id, product_id, last_seen, stock): each pair's last dated snapshot; rows of one date add up."""
    dated = inventory.filter(F.col("inventory_date").isNotNull())
    return _last(dated.groupBy("store_id", "product_id", F.col("inventory_date").alias("day")).agg(F.sum("stock_quantity").alias("stock")))


def _last(per_day: DataFrame) -> DataFrame:
    return per_day.groupBy("store_id", "product_id").agg(F.max("day").alias("last_seen"), F.max_by("stock", "day").alias("stock"))


def state_of(silver: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The state tables of whole silver tables."""
    return {
        "order_sums": order_sums(silver["orders"], silver["order_items"]),
        "product_sums": gold.product_sales(silver["order_items"]),
        "pair_stock": pair_stock(silver["inventory"]),
    }


def merged(name: str, *parts: DataFrame) -> DataFrame:
    """The state of all rows of ``parts``, states of disjoint rows.

    A sum of nothing is NULL and stays so unless another part has a number,
    as it would be over all rows at once.
    """
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    if name == "pair_stock":
        return _last(rows.groupBy("store_id", "product_id", F.col("last_seen").alias("day")).agg(F.sum("stock").alias("stock")))
    keys = STATE_KEYS[name]
    sums = [c for c in parts[0].columns if c not in keys]
    types = {f.name: f.dataType for f in parts[0].schema}
    return rows.groupBy(*keys).agg(*[F.sum(c).cast(types[c]).alias(c) for c in sums]).select(*parts[0].columns)


def late_values(new_orders: DataFrame, new_items: DataFrame) -> DataFrame:
    """(order_id, order_value) of items whose order isn't among ``new_orders``: it is an earlier one, or none at all."""
    return gold.order_value(new_items).join(new_orders.select("order_id"), "order_id", "left_anti")


def late_order_sums(late: DataFrame, earlier_orders: DataFrame, earlier_items: DataFrame) -> DataFrame:
    """What items that come after their order add to the order sums.

    Values add up. An order with a value counts as one once, however many
    deliveries its items come in. Of the earlier tables only keys are read,
    and only rows of these orders go on.
    """
    had = (earlier_items.select("order_id").join(late.select("order_id"), "order_id", "left_semi").distinct()
           .withColumn("_had", F.lit(1)))
    orders = earlier_orders.select("order_id", "order_date", "customer_id", "store_id").join(late, "order_id").join(had, "order_id", "left")
    return (
        orders.groupingSets([["order_date"], ["customer_id"], ["store_id"]], "order_date", "customer_id", "store_id")
        .agg(F.lit(0).cast("long").alias("_orders"), F.lit(0).cast("long").alias("_cancelled"), F.sum("order_value").alias("_value"),
             F.sum(F.when(F.col("_had").isNull() & F.col("order_value").isNotNull(), 1).otherwise(0)).alias("_valued"),
             F.lit(None).cast("long").alias("_minutes"), F.lit(0).cast("long").alias("_timed"), F.lit(0).cast("long").alias("_late"),
             F.grouping_id().alias("_set"))
    )


def latest_per_pair(stock: DataFrame) -> DataFrame:
    """X6 from the state: stock on each pair's own latest snapshot, summed per product."""
    return stock.groupBy("product_id").agg(F.count(F.lit(1)).alias("stores"), F.sum("stock").alias("total_stock"))


def missing_snapshots(stock: DataFrame) -> DataFrame:
    """X12 from the state: pairs that are absent from the latest snapshot."""
    latest = stock.agg(F.max("last_seen")).scalar()
    return stock.filter(F.col("last_seen") < latest).select("store_id", "product_id", "last_seen")
