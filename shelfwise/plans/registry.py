"""Registry of runnable queries over the driver's test tables.

Every entry is ``(spark, sf_dir) -> DataFrame``: bronze is derived from the
given tables by the fixture adapter, then cleaned and aggregated by the same
functions the file pipeline uses. Nothing is collected, and only the tables
a query depends on are built. Each query is one lazy plan over whole tables,
but for X1 and X11: building them runs the job that ranks the products and
checkpoints the ranked rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.operators import extensions, gate, gold, profile, silver
from shelfwise.plans import analyst
from shelfwise.sources import fixtures

Query = Callable[[SparkSession, str], DataFrame]


def publish(df: DataFrame) -> DataFrame:
    """Cast exact decimal money columns to double for the published result."""
    return df.select(*[
        F.col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else F.col(f.name)
        for f in df.schema.fields
    ])


class Layers:
    """Lazily built bronze, silver and gold tables over one test-data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._bronze: dict[str, DataFrame] = {}
        self._silver: dict[str, DataFrame] = {}

    def bronze(self, name: str) -> DataFrame:
        if name not in self._bronze:
            self._bronze[name] = getattr(fixtures, name)(self.spark, self.sf_dir)
        return self._bronze[name]

    def silver(self, name: str) -> DataFrame:
        if name not in self._silver:
            self._silver[name] = silver.CLEANERS[name](self.bronze(name))
        return self._silver[name]

    @cached_property
    def valued(self) -> DataFrame:
        return gold.orders_with_value(self.silver("orders"), self.silver("order_items"))

    @cached_property
    def sales(self) -> DataFrame:
        return gold.product_sales(self.silver("order_items"))

    def gold(self, name: str) -> DataFrame:
        if name == "daily_orders":
            return gold.daily_orders(self.valued)
        if name == "product_performance":
            return gold.product_performance(self.sales, self.silver("products"))
        if name == "category_performance":
            return gold.category_performance(gold.product_performance(self.sales, self.silver("products")))
        if name == "inventory_health":
            return gold.inventory_health(self.silver("inventory"), self.sales, self.silver("products"))
        if name == "delivery_performance":
            return gold.delivery_performance(self.silver("orders"))
        if name == "location_insights":
            return gold.location_insights(self.valued, self.silver("customers"))
        raise KeyError(name)

    def all_gold(self) -> dict[str, DataFrame]:
        return {name: self.gold(name) for name in GOLD_NAMES}

    def checks_input(self) -> dict[str, DataFrame]:
        return fixtures.bronze_for_checks(self.spark, self.sf_dir)


GOLD_NAMES = ("daily_orders", "product_performance", "category_performance",
              "inventory_health", "delivery_performance", "location_insights")
SILVER_NAMES = ("customers", "orders", "order_items", "products", "inventory")


def silver_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    layers = Layers(spark, sf_dir)
    return {name: layers.silver(name) for name in SILVER_NAMES}


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Layers(spark, sf_dir).all_gold()


def broken_gate(layers: Layers) -> DataFrame:
    """The gate over gold from items with orphans, with an empty and a missing table: V1 to V3 must fail."""
    items = silver.clean_order_items(layers.checks_input()["order_items"])
    tables: dict[str, DataFrame | None] = dict(gold.build_gold(
        {**{name: layers.silver(name) for name in SILVER_NAMES}, "order_items": items}))
    tables["daily_orders"] = tables["daily_orders"].filter(F.lit(False))
    tables["delivery_performance"] = None
    return gate.gate(layers.spark, tables)


def _q(build: Callable[[Layers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(Layers(spark, sf_dir))


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for name in SILVER_NAMES:
        out[f"silver_{name}"] = _q(lambda L, n=name: publish(L.silver(n)))
    out["order_value"] = _q(lambda L: publish(gold.order_value(L.silver("order_items"))))
    for name in GOLD_NAMES:
        out[name] = _q(lambda L, n=name: publish(L.gold(n)))
    for name, (table, fn) in analyst.QUESTIONS.items():
        out[name] = _q(lambda L, t=table, f=fn: publish(f(L.gold(t))))
    for name, fn in profile.CHECKS.items():
        out[name] = _q(lambda L, f=fn: f(L.checks_input()))
    out["gold_gate"] = _q(lambda L: gate.gate(L.spark, L.all_gold()))
    out["gold_gate_broken"] = _q(broken_gate)
    out["silver_products_repeated"] = _q(lambda L: publish(
        silver.clean_products(fixtures.repeated_products(L.spark, L.sf_dir))))
    out.update({
        "x01_demand_concentration": _q(lambda L: extensions.demand_concentration(L.sales)),
        "x02_orders_by_hour": _q(lambda L: extensions.orders_by_hour(fixtures.order_events(L.spark, L.sf_dir))),
        "x03_slow_stores": _q(lambda L: extensions.slow_stores(L.silver("orders"))),
        "x04_cancel_by_delay": _q(lambda L: extensions.cancel_by_delay(L.silver("orders"))),
        "x05_duplicate_keys": _q(lambda L: extensions.duplicate_keys(L.bronze("customers"), L.bronze("products"))),
        "x06_latest_snapshot": _q(lambda L: extensions.latest_per_pair(L.silver("inventory"))),
        "x07_weighted_aov": _q(lambda L: extensions.weighted_aov(L.valued)),
        "x08_delivery_by_location": _q(
            lambda L: extensions.delivery_by_location(L.silver("orders"), L.silver("customers"))),
        "x09_demand_by_area": _q(lambda L: extensions.demand_by_area(
            L.silver("order_items"), L.silver("orders"), L.silver("customers"))),
        "x10_demand_stock_ratio": _q(lambda L: extensions.demand_stock_ratio(L.gold("inventory_health"))),
        "x11_stockout_by_decile": _q(lambda L: extensions.stockout_by_decile(L.gold("inventory_health"))),
        "x12_missing_snapshots": _q(lambda L: extensions.missing_snapshots(L.silver("inventory"))),
    })
    return out
