"""Runs that don't start anew: new bronze rows added to the layers, and snapshot dates replaced.

:func:`add_increment` takes a folder with bronze CSVs of new rows. They are
staged and cleaned like others and appended to the layers, and the state
tables (:mod:`shelfwise.operators.state`) are merged with those of the new
rows; gold comes from the state. Facts that were there are not read.

:func:`rerun_dates` replaces single snapshot dates of the inventory: only
their folders are written, all others stay the files they are.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import gold as gold_ops
from shelfwise.operators import state as state_ops
from shelfwise.operators.silver import CLEANERS
from shelfwise.plans import layers
from shelfwise.plans.layers import LayerPaths, RunSummary
from shelfwise.sources import io
from shelfwise.sources.schemas import TABLES
from shelfwise.sources.versions import Commit, Layer

#: Tables that grow by rows; the others are small and come whole where a folder has them.
FACTS = ("orders", "order_items", "inventory")
DIMENSIONS = tuple(t for t in TABLES if t not in FACTS)


def build_state(spark: SparkSession, out_dir: str) -> list[str]:
    """Write the state tables of the silver layer as it is."""
    paths = LayerPaths(out_dir)
    silver = Layer(spark, paths.silver)
    manifest = silver.manifest()
    tables = state_ops.state_of({name: silver.read(name, manifest) for name in FACTS})
    with Layer(spark, paths.state).commit() as change:
        for name, df in tables.items():
            change.write(df, name)
        change.notes["silver"] = str(manifest.number)
    return list(tables)


def gold_of_state(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """The six gold tables from state tables, dimensions and the latest snapshot."""
    paths = LayerPaths(out_dir)
    state = Layer(spark, paths.state)
    manifest = state.manifest()
    silver = {name: io.read_layer(spark, paths.silver, name) for name in (*DIMENSIONS, "inventory")}
    return gold_ops.build_gold(silver, rollups=state.read("order_sums", manifest), sales=state.read("product_sums", manifest),
                               latest=layers.latest_date(spark, paths.silver))


def _bronze(spark: SparkSession, bronze_dir: str, null_value: str | None) -> dict[str, DataFrame]:
    """The bronze tables that a folder has."""
    there = Layer(spark, bronze_dir).files.names(bronze_dir)
    return {name: io.read_bronze_csv(spark, bronze_dir, name, null_value) for name in TABLES if f"{name}.csv" in there}


def _stage(spark: SparkSession, staged_dir: str, bronze: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Append facts and replace dimensions in the staged layer; the new rows alone, as staged."""
    layer = Layer(spark, staged_dir)
    metrics = layers.staged_metrics(spark, staged_dir)
    with layer.commit() as change:
        for name, df in bronze.items():
            seen = layers.staged_write(df, name, lambda df, n=name: (change.append if n in FACTS else change.write)(df, n))
            if metrics:
                before = metrics[name] if name in FACTS else {}
                metrics[name] = {k: before.get(k, 0) + n for k, n in seen.items()}
        if metrics:
            change.notes["metrics"] = json.dumps(metrics)
    return {name: written_by(layer, change, name).drop(io.MALFORMED) for name in bronze}


def written_by(layer: Layer, change: Commit, name: str) -> DataFrame:
    """The rows of a table that one commit wrote."""
    manifest = layer.manifest()
    table = manifest.tables[name]
    own = tuple(f for f in table.folders if f[0] == change.version)
    return layer.read(name, type(manifest)(manifest.number, {name: type(table)(table.schema, table.by, own)}))


def add_increment(spark: SparkSession, bronze_dir: str, out_dir: str, null_value: str | None = None) -> RunSummary:
    """Add the bronze rows of a folder to the layers of a finished run.

    The folder may have any of the five tables. Orders, order items and
    inventory are new rows; customers and products replace the table. An
    order comes before its items or with them; items that come later are
    found and counted with their order, for which the keys of the earlier
    orders and items are read. Rows that were added already would count
    twice: a snapshot is delivered again through :func:`rerun_dates`.

    The silver commit names the increment it holds, and the state the silver
    commit that it covers; a run that died between the two is caught up by
    building the state from silver.
    """
    paths = LayerPaths(out_dir)
    bronze = _bronze(spark, bronze_dir, null_value)
    before = Layer(spark, paths.silver)
    earlier = {name: io.read_layer(spark, paths.silver, name) for name in ("orders", "order_items")}
    state_layer = Layer(spark, paths.state)
    if state_layer.manifest().notes.get("silver") != str(before.manifest().number):
        build_state(spark, out_dir)
    staged = _stage(spark, paths.staged, bronze)
    summary = RunSummary()
    with before.commit() as change:
        for name, df in staged.items():
            append = (lambda clean, n=name: change.append(clean, n)) if name in FACTS else None
            summary.silver_rows.append(io.observed_write(df, CLEANERS[name], change, name, layers.PARTITION_COLUMNS.get(name), append))
    silver = Layer(spark, paths.silver)
    new = {name: written_by(silver, change, name) for name in staged if name in FACTS}
    for name in FACTS:
        if name not in new:
            new[name] = silver.read(name).limit(0)
    parts = {name: [df] for name, df in state_ops.state_of(new).items()}
    late = state_ops.late_values(new["orders"], new["order_items"])
    if not late.isEmpty():
        parts["order_sums"].append(state_ops.late_order_sums(late, earlier["orders"], earlier["order_items"]))
    with state_layer.commit() as change:
        for name, own in parts.items():
            change.write(state_ops.merged(name, state_layer.read(name), *own), name)
        change.notes["silver"] = str(silver.manifest().number)
    layers.write_gold(spark, gold_of_state(spark, out_dir), paths.gold)
    summary.gate_rules = layers.validate_gold(spark, paths.gold, paths.reports)
    return summary


def rerun_dates(spark: SparkSession, bronze_dir: str, out_dir: str, dates: list[str], null_value: str | None = None) -> RunSummary:
    """Replace the snapshots of ``dates`` in the inventory by those in a bronze folder, and what depends on them.

    A date without rows there has no snapshot any more. Other dates in the
    folder are left out. Stock health is computed anew from the latest date;
    the state of pairs, in which a snapshot can't be taken back, from silver.
    """
    paths = LayerPaths(out_dir)
    own = io.read_bronze_csv(spark, bronze_dir, "inventory", null_value).drop(io.MALFORMED).filter(
        F.col("inventory_date").isin([F.lit(d).cast("date") for d in dates]))
    summary = RunSummary()
    layer = Layer(spark, paths.silver)
    with layer.commit() as change:
        summary.silver_rows.append(io.observed_write(own, CLEANERS["inventory"], change, "inventory",
                                                     write=lambda clean: change.replace(clean, "inventory", dates)))
        change.notes["replaced"] = ",".join(sorted({*filter(None, change.notes.get("replaced", "").split(",")), *dates}))
    inventory, products = layer.read("inventory"), layer.read("products")
    state = Layer(spark, paths.state)
    if "pair_stock" in state.manifest().tables:
        with state.commit() as change:
            change.write(state_ops.pair_stock(inventory), "pair_stock")
            change.notes["silver"] = str(layer.manifest().number)
        sales = state.read("product_sums")
    else:
        sales = gold_ops.product_sales(layer.read("order_items"))
    health = gold_ops.inventory_health(inventory, sales, products, latest=layers.latest_date(spark, paths.silver))
    layers.write_gold(spark, {"inventory_health": health}, paths.gold)
    summary.gate_rules = layers.validate_gold(spark, paths.gold, paths.reports)
    return summary
