"""Silver layer: one cleaning function per bronze table.

Each is ``DataFrame -> DataFrame`` and keeps every input column. All rules
are built-in expressions; the only shuffles are the two de-duplications.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions import MONEY


def clean_customers(df: DataFrame) -> DataFrame:
    """Fill a missing area with 'Unknown', then drop whole-row duplicates.

    The fill runs first, so rows equal only after filling collapse too.
    ``distinct`` is a hash aggregate with a map-side partial step, so a row
    copied millions of times is collapsed before the shuffle.
    """
    return df.fillna({"area": "Unknown"}).distinct()


def clean_orders(df: DataFrame) -> DataFrame:
    """Drop orders without a store, repair the sign of delivery time.

    ``store_id`` arrives as double (``3.0`` in the CSV) and leaves as int; a
    value that is not a valid int id counts as no store. One bad raw row must
    not fail the job under ANSI mode, so the cast is a ``try_cast`` and the
    one delivery time whose absolute value has no int (-2147483648) becomes
    NULL instead of overflowing.
    """
    minutes = F.col("delivery_time_minutes")
    return (
        df.withColumn("store_id", F.col("store_id").try_cast("int"))
        .dropna(subset=["store_id"])
        .withColumn("delivery_time_minutes", F.abs(minutes.cast("long")).try_cast("int"))
    )


def clean_order_items(df: DataFrame) -> DataFrame:
    """Keep positive quantities and non-negative prices (NULL fails both).

    Duplicate business rows are kept, as in the source pipeline; the
    duplicate check reports them. Prices become cents, rounded half-up.
    """
    return (df.filter(F.col("quantity") > 0).filter(F.col("unit_price") >= 0)
            .withColumn("unit_price", F.round("unit_price", 2).cast(MONEY)))


def dedup_by_key(df: DataFrame, key: str, better: Column | None = None) -> DataFrame:
    """One row per ``key``: of those for which ``better`` holds, if any, the smallest under the order of the other columns.

    Written as ``min(struct)`` per key rather than ``row_number`` over a
    window, so it is an aggregate with a partial (map-side) step (Spark
    plans it sort-based because the row holds strings): a key repeated
    across a third of the table is reduced on each mapper before the
    shuffle instead of being sorted in one task. The survivor is
    deterministic, unlike ``dropDuplicates([key])``.
    """
    others = [c for c in df.columns if c != key]
    worse = F.lit(False) if better is None else ~F.coalesce(better, F.lit(False))
    survivor = F.min(F.struct(worse.alias("_worse"), *[F.col(c) for c in others])).alias("_row")
    return df.groupBy(key).agg(survivor).select(key, *[F.col(f"_row.{c}").alias(c) for c in others])


def clean_products(df: DataFrame) -> DataFrame:
    """C4: one row per product id, then drop negative prices.

    The source keeps an arbitrary row of a repeated id before it filters
    prices. Here a row with a valid price is kept if the id has one, so only
    ids without any valid price disappear.
    """
    valid = F.col("price") >= 0
    return dedup_by_key(df.withColumn("price", F.round("price", 2).cast(MONEY)), "product_id", valid).filter(valid)


def clean_inventory(df: DataFrame) -> DataFrame:
    """Floor negative stock at 0; a NULL stock stays NULL."""
    q = F.col("stock_quantity")
    return df.withColumn("stock_quantity", F.when(q < 0, F.lit(0)).otherwise(q))


CLEANERS = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "inventory": clean_inventory,
}


def build_silver(bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All five silver tables from the bronze ones (lazy)."""
    return {name: CLEANERS[name](df) for name, df in bronze.items()}
