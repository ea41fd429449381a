"""Gold quality gate: passes on good gold, fails on each broken variant."""

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import gate, gold, silver
from shelfwise.plans.registry import gold_tables
from shelfwise.sources import fixtures
from tests.conftest import SF_SMALL


def _failed(rows):
    return {(r.table_name, r.rule, r.column_name) for r in rows.collect() if not r.passed}


def test_gate_passes_on_fixture(spark):
    rules = gate.gate(spark, gold_tables(spark, SF_SMALL))
    assert _failed(rules) == set()
    assert rules.count() == 35
    assert len(gate.enforce(rules)) == 35


def test_gate_catches_orphan_product(spark):
    bronze = dict(fixtures.bronze(spark, SF_SMALL))
    bronze["order_items"] = fixtures.dirty_order_items(spark, SF_SMALL)
    g = gold.build_gold(silver.build_silver(bronze))
    failed = _failed(gate.gate(spark, g))
    assert ("product_performance", "not_null", "product_name") in failed
    assert ("product_performance", "not_null", "category") in failed


def test_gate_missing_empty_negative(spark):
    g = gold_tables(spark, SF_SMALL)
    g["daily_orders"] = None
    g["category_performance"] = g["category_performance"].limit(0)
    g["delivery_performance"] = g["delivery_performance"].withColumn("late_deliveries", F.lit(-1).cast("long"))
    rules = gate.gate(spark, g)
    failed = _failed(rules)
    assert ("daily_orders", "exists", None) in failed
    assert ("category_performance", "not_empty", None) in failed
    assert ("delivery_performance", "non_negative", "late_deliveries") in failed
    names = {(r.table_name, r.rule) for r in rules.collect()}
    # a missing or empty table skips its other rules
    assert ("daily_orders", "not_null") not in names
    assert ("category_performance", "not_null") not in names
    with pytest.raises(gate.GateFailure) as err:
        gate.enforce(rules)
    assert len(err.value.failures) == 3
