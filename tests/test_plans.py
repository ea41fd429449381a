"""Plan audit: no cartesian or nested-loop joins, no Python UDFs, no global windows."""

import contextlib
import io
import re

import pytest

from shelfwise.plans.registry import queries as core_queries
from tests.conftest import SF_SMALL

FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "PythonUDF", "localCheckpoint"]
# X1/X11 rank through ranking.global_row_number: its only window runs over
# the per-partition offsets (one row per partition), not over the data, and
# they read the checkpointed ranking input rather than a file scan.
RANKED = {"x01_demand_concentration", "x11_stockout_by_decile"}


def global_windows(plan: str) -> list[str]:
    """Window specs with no partition key (their first argument is an order or the frame)."""
    specs = re.findall(r"windowspecdefinition\(([^,)]*)", plan)
    return [x for x in specs if " ASC" in x or " DESC" in x or x.startswith("specifiedwindowframe")]


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_plan_shape(spark, name):
    plan = _plan(core_queries()[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"
    if name not in RANKED:
        assert not global_windows(plan), f"{name}: window without partition key"
        assert "ReadSchema" in plan


def test_global_window_detector(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    df = spark.range(10)
    assert global_windows(_plan(df.withColumn("r", F.row_number().over(Window.orderBy("id")))))
    assert global_windows(_plan(df.withColumn("s", F.sum("id").over(Window.partitionBy()))))
    assert not global_windows(_plan(df.withColumn(
        "r", F.row_number().over(Window.partitionBy(F.col("id") % 2).orderBy("id")))))


def test_scan_prunes_columns(spark):
    plan = _plan(core_queries()["daily_orders"](spark, SF_SMALL))
    lineitem = [line for line in plan.splitlines() if "ReadSchema: struct<l_" in line]
    assert lineitem and all("l_comment" not in x and "l_shipdate" not in x for x in lineitem)


def test_latest_snapshot_prunes_partitions(spark, workdir):
    """On date-partitioned silver inventory the latest-date filter is a partition filter."""
    from shelfwise.operators import gold, silver
    from shelfwise.sources import fixtures
    from shelfwise.sources import io as layer_io

    inv = silver.clean_inventory(fixtures.inventory(spark, SF_SMALL))
    layer_io.write_table(inv, workdir, "inventory", partition_by="inventory_date")
    plan = _plan(gold.latest_snapshot(layer_io.read_layer(spark, workdir, "inventory")))
    filters = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert any("inventory_date" in f and "Subquery" in f for f in filters), filters
