"""Adapter: the driver's TPC-H-style tables as the five bronze retail tables.

The driver's tables are clean and have no inventory or delivery time, so the
retail columns and the planted dirt are derived deterministically from keys
(see FIXTURES.md). Everything is a projection of the given tables, so the
work grows with them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _null_when(cond: Column, value: Column) -> Column:
    return F.when(cond, F.lit(None)).otherwise(value)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation (25 rows) and region (5 rows) are fixed by the TPC-H schema at
    # every scale factor: a proven bound, so they are broadcast.
    base = (
        c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
        .join(F.broadcast(r), n.n_regionkey == r.r_regionkey, "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("r_name").alias("city"),
            _null_when(F.col("c_custkey") % 200 == 7, F.col("n_name")).alias("area"),
        )
    )
    # exact duplicate customer rows
    return base.unionByName(base.filter(F.col("customer_id") % 50 == 7))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("price"),
    )


def repeated_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``products`` with ids that repeat with a negative or no price, and ids that only have a negative one."""
    base = products(spark, sf_dir)
    bad = base.filter(F.col("product_id") % 20 == 3).withColumn("price", F.lit(-5).cast("decimal(12,2)"))
    none = base.filter(F.col("product_id") % 20 == 4).withColumn("price", F.lit(None).cast("decimal(12,2)"))
    only = (base.filter(F.col("product_id") % 50 == 5).withColumn("product_id", F.col("product_id") + 1000000)
            .withColumn("price", F.lit(-1).cast("decimal(12,2)")))
    return base.unionByName(bad).unionByName(none).unionByName(only)


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    sign = F.when(key % 333 == 5, F.lit(-1)).otherwise(F.lit(1))
    slow_store = F.when(cust % 50 < 5, F.lit(20)).otherwise(F.lit(0))
    return o.select(
        key.alias("order_id"),
        cust.alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        _null_when(key % 500 == 3, (cust % 50 + 1).cast("int")).alias("store_id"),
        (sign * (F.lit(8) + (key * 37) % 50 + slow_store)).cast("int").alias("delivery_time_minutes"),
        F.when(F.col("o_orderstatus") == "F", "Delivered")
        .when(F.col("o_orderstatus") == "O", "Cancelled")
        .otherwise("Returned").alias("order_status"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_orderkey") % 1000 == 11, F.lit(0))
        .otherwise(F.col("l_quantity").cast("int")).alias("quantity"),
        F.col("l_extendedprice").cast("decimal(12,2)").alias("unit_price"),
    )


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.date_trunc("month", F.col("l_shipdate")).cast("date").alias("inventory_date"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_quantity").cast("int") - 25).alias("stock_quantity"),
    )


def dirty_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """order_items with orphan product ids and duplicate business rows (checks only)."""
    b = order_items(spark, sf_dir)
    shifted = b.withColumn(
        "product_id",
        F.when(F.col("order_id") % 700 == 9, F.col("product_id") + 1000000).otherwise(F.col("product_id")),
    )
    return shifted.unionByName(b.filter(F.col("order_id") % 1000 == 13))


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders with orphan customer ids (checks only)."""
    return orders(spark, sf_dir).withColumn(
        "customer_id",
        F.when(F.col("order_id") % 400 == 17, F.col("customer_id") + 1000000).otherwise(F.col("customer_id")),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order placement times: purchase events stand in for orders, so other events are none (FIXTURES.md)."""
    ev = _read(spark, sf_dir, "events")
    return ev.filter(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("order_id"), F.col("ts").alias("order_time"))


class LazyTables(Mapping):
    """Read-only mapping of table name -> DataFrame, each built on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def bronze(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The five bronze tables the pipeline cleans (built on first access)."""
    return LazyTables({
        "customers": lambda: customers(spark, sf_dir),
        "products": lambda: products(spark, sf_dir),
        "orders": lambda: orders(spark, sf_dir),
        "order_items": lambda: order_items(spark, sf_dir),
        "inventory": lambda: inventory(spark, sf_dir),
    })


def bronze_for_checks(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze with referential dirt planted, for the profiling checks."""
    return LazyTables({
        "customers": lambda: customers(spark, sf_dir),
        "products": lambda: products(spark, sf_dir),
        "orders": lambda: dirty_orders(spark, sf_dir),
        "order_items": lambda: dirty_order_items(spark, sf_dir),
        "inventory": lambda: inventory(spark, sf_dir),
    })


def bronze_with_all_columns(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Bronze with every declared CSV column, for staging files in tests.

    Columns no metric uses are filled: signup_date NULL, order_time a
    ``HH:MM:00`` string derived from the order key, order_item_id a unique id.
    """
    tables = dict(bronze(spark, sf_dir))
    tables["customers"] = tables["customers"].withColumn("signup_date", F.lit(None).cast("date"))
    key = F.col("order_id")
    order_time = F.format_string("%02d:%02d:00", (key * 7) % 24, (key * 13) % 60)
    o = tables["orders"]
    tables["orders"] = o.select("order_id", "customer_id", "order_date", order_time.alias("order_time"),
                                "store_id", "delivery_time_minutes", "order_status")
    tables["order_items"] = tables["order_items"].select(
        F.monotonically_increasing_id().alias("order_item_id"), "*")
    return tables
