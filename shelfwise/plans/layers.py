"""The layer run (R1): validate bronze, build silver, build gold, validate
gold, in strict order, stopping at the first failure.

Each bronze CSV is parsed once, with its declared schema, into a Parquet
staging copy; the bronze checks and the silver cleaning then read that
columnar copy (pruned to the columns each needs) instead of re-parsing text
for every check. Data crosses steps as Parquet tables under one output base,
which is also what makes a rerun after a lost executor or a failed step
cheap: each step reads only the previous step's written tables. A step's
tables become visible in one commit when all of them are written, so a step
that dies leaves the tables of the run before, to readers and to a resumed
run alike. No scheduler is involved; call :func:`run_layers` from whatever
orchestrates jobs.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import extensions as ext
from shelfwise.operators import gate as gate_ops
from shelfwise.operators import gold as gold_ops
from shelfwise.operators import state as state_ops
from shelfwise.operators.profile import profile_bronze, table_metrics
from shelfwise.operators.silver import CLEANERS
from shelfwise.plans.analyst import answer_all
from shelfwise.sources import io
from shelfwise.sources.schemas import GOLD_TABLES, TABLES
from shelfwise.sources.versions import Layer

PARTITION_COLUMNS = {"inventory": "inventory_date"}


@dataclass
class LayerPaths:
    base: str

    @property
    def staged(self) -> str:
        return f"{self.base.rstrip('/')}/bronze_staged"

    @property
    def silver(self) -> str:
        return f"{self.base.rstrip('/')}/silver"

    @property
    def gold(self) -> str:
        return f"{self.base.rstrip('/')}/gold"

    @property
    def reports(self) -> str:
        return f"{self.base.rstrip('/')}/reports"

    @property
    def state(self) -> str:
        return f"{self.base.rstrip('/')}/state"

    @property
    def extensions(self) -> str:
        return f"{self.base.rstrip('/')}/extensions"


@dataclass
class RunSummary:
    silver_rows: list[io.RowReport] = field(default_factory=list)
    malformed: dict[str, int] = field(default_factory=dict)
    gate_rules: list[str] = field(default_factory=list)


def stage_bronze(spark: SparkSession, bronze_dir: str, staged_dir: str,
                 null_value: str | None = None) -> dict[str, DataFrame]:
    """Parse every bronze CSV once into Parquet (declared types, nothing cleaned), all tables in one commit.

    What the profile needs to know of single columns (rows, NULLs, negative
    values, malformed lines) is observed on the write itself and kept with
    the commit (:func:`staged_metrics`).
    """
    with Layer(spark, staged_dir).commit() as change:
        metrics = {}
        for name, df in io.read_bronze(spark, bronze_dir, null_value).items():
            metrics[name] = staged_write(df, name, lambda df, n=name: change.write(df, n))
        change.notes["metrics"] = json.dumps(metrics)
    return read_staged(spark, staged_dir)


def staged_write(df: DataFrame, name: str, write) -> dict[str, int]:
    """Write a bronze table with ``write``; the metrics of its rows."""
    seen = Observation(f"staged_{name}")
    columns = [c for c in df.columns if c != io.MALFORMED]
    write(df.observe(seen, *table_metrics(name, columns), F.count(io.MALFORMED).alias("malformed")))
    return {k: int(v) for k, v in seen.get.items()}


def staged_metrics(spark: SparkSession, staged_dir: str) -> dict[str, dict[str, int]] | None:
    """Per table what was observed when it was staged; None for a folder that others have staged."""
    notes = Layer(spark, staged_dir).manifest().notes
    return json.loads(notes["metrics"]) if "metrics" in notes else None


def read_staged(spark: SparkSession, staged_dir: str) -> dict[str, DataFrame]:
    """The staged tables, without the column for malformed lines."""
    return {name: io.read_layer(spark, staged_dir, name).drop(io.MALFORMED) for name in TABLES}


def malformed_lines(spark: SparkSession, staged_dir: str) -> DataFrame:
    """Per table: staged lines that had a value which does not fit its declared type."""
    if metrics := staged_metrics(spark, staged_dir):
        return spark.createDataFrame([(name, m["malformed"]) for name, m in metrics.items()], "table_name string, n long")
    frames = [io.read_layer(spark, staged_dir, name).select(F.lit(name).alias("table_name"), io.MALFORMED)
              .groupBy("table_name").agg(F.count(io.MALFORMED).alias("n")) for name in TABLES]
    return reduce(DataFrame.unionByName, frames)


def validate_bronze(bronze: dict[str, DataFrame], report_dir: str, staged_dir: str | None = None) -> dict[str, DataFrame]:
    """Profile bronze (B1-B7, malformed lines) and write the reports in one commit; report-only, never fails.

    Of a layer that :func:`stage_bronze` wrote, B1, B2, B7 and the malformed
    lines are known from staging; only B3 to B6 read the tables.
    """
    spark = next(iter(bronze.values())).sparkSession
    checks = profile_bronze(bronze, staged_metrics(spark, staged_dir) if staged_dir else None)
    if staged_dir:
        checks["check_malformed"] = malformed_lines(spark, staged_dir)
    with Layer(spark, report_dir).commit() as change:
        for name, df in checks.items():
            change.write(df, name)
    return {name: io.read_layer(spark, report_dir, name) for name in checks}


def build_silver_layer(bronze: dict[str, DataFrame], silver_dir: str) -> list[io.RowReport]:
    """Clean every bronze table and write it, all in one commit; rows before/after counted in the write job."""
    with Layer(next(iter(bronze.values())).sparkSession, silver_dir).commit() as change:
        change.notes.pop("replaced", None)
        return [io.observed_write(bronze[name], CLEANERS[name], change, name, PARTITION_COLUMNS.get(name)) for name in TABLES]


def latest_date(spark: SparkSession, silver_dir: str) -> str | None:
    """The latest snapshot date, from the partitions that the silver layer's manifest names; no file is opened."""
    values = Layer(spark, silver_dir).partitions("inventory") or []
    return max((v for v in values if v is not None), default=None)


def cached_gold(silver: dict[str, DataFrame], latest: str | None = None) -> tuple[dict[str, DataFrame], list[DataFrame]]:
    """The six gold tables over persisted shared aggregates; returns (tables, cached).

    The items are aggregated per order and per product, each from its own
    column-pruned scan: the order values feed the join with the orders on
    the same key, one exchange of the items; the product sales serve three
    tables. One grouping-sets pass over the joined orders gives the
    per-date, per-store and per-customer figures. Only the product sales and
    those figures are persisted (memory, spilling to disk), never a row per
    item or order; a lost block is recomputed from lineage. Unpersist the
    returned frames when the tables are written.
    """
    sales = gold_ops.product_sales(silver["order_items"]).persist(StorageLevel.MEMORY_AND_DISK)
    valued = gold_ops.orders_with_value(silver["orders"], silver["order_items"])
    rollups = gold_ops.order_rollups(valued).persist(StorageLevel.MEMORY_AND_DISK)
    return gold_ops.build_gold(silver, rollups=rollups, sales=sales, latest=latest), [rollups, sales]


def build_gold_layer(spark: SparkSession, silver_dir: str, gold_dir: str) -> list[str]:
    """Compute the six gold tables from silver Parquet (see :func:`cached_gold`) and write them in one commit."""
    silver = {name: io.read_layer(spark, silver_dir, name) for name in TABLES}
    tables, cached = cached_gold(silver, latest_date(spark, silver_dir))
    try:
        write_gold(spark, tables, gold_dir)
    finally:
        for df in cached:
            df.unpersist()
    return list(tables)


def write_gold(spark: SparkSession, tables: dict[str, DataFrame], gold_dir: str) -> None:
    """Gold tables in their published order, all in one commit; tables that aren't given stay."""
    with Layer(spark, gold_dir).commit() as change:
        for name, df in tables.items():
            change.write(gold_ops.presented(name, df), name)


def validate_gold(spark: SparkSession, gold_dir: str, report_dir: str | None = None) -> list[str]:
    """Gate the gold tables (V1-V5); raises ``GateFailure`` when a rule fails."""
    tables = {name: io.read_if_exists(spark, gold_dir, name) for name in GOLD_TABLES}
    rules = gate_ops.gate(spark, tables)
    if report_dir:
        io.write_table(rules, report_dir, "gold_gate")  # one row a rule
        rules = io.read_layer(spark, report_dir, "gold_gate")
    return gate_ops.enforce(rules)


STEPS = ("stage", "check_bronze", "silver", "gold", "gate")


def run_layers(spark: SparkSession, bronze_dir: str, out_dir: str,
               null_value: str | None = None, start_at: str = "stage") -> RunSummary:
    """Stage bronze -> bronze checks -> silver -> gold -> gate, stopping on the first failure.

    ``start_at`` resumes a failed run at one of :data:`STEPS`: earlier steps
    are not repeated, their written tables are read instead.
    """
    if start_at not in STEPS:
        raise ValueError(f"start_at must be one of {STEPS}")
    todo = set(STEPS[STEPS.index(start_at):])
    paths = LayerPaths(out_dir)
    summary = RunSummary()
    if "silver" in todo and "stage" not in todo and (dates := Layer(spark, paths.silver).manifest().notes.get("replaced")):
        raise ValueError(f"silver holds snapshots of {dates} that the staged tables don't: stage again, or resume at gold")
    if "stage" in todo:
        bronze = stage_bronze(spark, bronze_dir, paths.staged, null_value)
    elif todo & {"check_bronze", "silver"}:
        bronze = read_staged(spark, paths.staged)
    if "check_bronze" in todo:
        reports = validate_bronze(bronze, paths.reports, paths.staged)
        summary.malformed = {r["table_name"]: r["n"] for r in reports["check_malformed"].collect()}  # five rows
    if "silver" in todo:
        summary.silver_rows = build_silver_layer(bronze, paths.silver)
    if "gold" in todo:
        build_gold_layer(spark, paths.silver, paths.gold)
    summary.gate_rules = validate_gold(spark, paths.gold, paths.reports)
    for base in (paths.staged, paths.silver, paths.gold, paths.reports):
        Layer(spark, base).clean()  # readers of the run before can still end
    return summary


def answer_questions(spark: SparkSession, gold_dir: str) -> dict[str, DataFrame]:
    """Q1-Q10 over the written gold tables (also registered as SQL views)."""
    gold = {name: io.read_layer(spark, gold_dir, name) for name in GOLD_TABLES}
    io.register_views(spark, gold)
    return answer_all(gold)


def extension_tables(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """X1-X12 over a finished layer run (staged bronze, silver and gold), lazily."""
    paths = LayerPaths(out_dir)
    bronze = read_staged(spark, paths.staged)
    silver = {name: io.read_layer(spark, paths.silver, name) for name in TABLES}
    health = io.read_layer(spark, paths.gold, "inventory_health")
    sales = gold_ops.product_sales(silver["order_items"])
    valued = gold_ops.orders_with_value(silver["orders"], silver["order_items"])
    state = Layer(spark, paths.state).manifest()
    covered = state.notes.get("silver") == str(Layer(spark, paths.silver).manifest().number)
    stock = Layer(spark, paths.state).read("pair_stock", state) if covered else state_ops.pair_stock(silver["inventory"])
    return {
        "x01_demand_concentration": ext.demand_concentration(sales),
        "x02_orders_by_hour": ext.orders_by_hour(silver["orders"]),
        "x03_slow_stores": ext.slow_stores(silver["orders"]),
        "x04_cancel_by_delay": ext.cancel_by_delay(silver["orders"]),
        "x05_duplicate_keys": ext.duplicate_keys(bronze["customers"], bronze["products"]),
        "x06_latest_snapshot": state_ops.latest_per_pair(stock),
        "x07_weighted_aov": ext.weighted_aov(valued),
        "x08_delivery_by_location": ext.delivery_by_location(silver["orders"], silver["customers"]),
        "x09_demand_by_area": ext.demand_by_area(silver["order_items"], silver["orders"], silver["customers"]),
        "x10_demand_stock_ratio": ext.demand_stock_ratio(health),
        "x11_stockout_by_decile": ext.stockout_by_decile(health),
        "x12_missing_snapshots": state_ops.missing_snapshots(stock),
    }


def build_extensions(spark: SparkSession, out_dir: str) -> list[str]:
    """Write every extension table under ``<out_dir>/extensions``; returns their names."""
    tables = extension_tables(spark, out_dir)
    with Layer(spark, LayerPaths(out_dir).extensions).commit() as change:
        for name, df in tables.items():
            change.write(df, name)
    return list(tables)
