"""Hot keys: one customer, one product and one store each hold a third of the rows.

A skewed copy of the sf0.001 tables is derived with DuckDB; every registered
query must still match its oracle on it exactly.
"""

import tempfile

import duckdb
import pytest

from oracle_sql import oracle_sql as core_sql
from shelfwise.plans.registry import queries as core_queries
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows

SKEW = {
    # every third order belongs to customer 1 (and so to store 2)
    "orders": "SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE o_custkey END AS o_custkey) FROM src",
    # every third line item is part 1
    "lineitem": "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 1 THEN 1 ELSE l_partkey END AS l_partkey) FROM src",
}
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def skewed_dir():
    out = tempfile.mkdtemp(prefix="shelfwise-skew-")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE OR REPLACE VIEW src AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
        body = SKEW.get(t, "SELECT * FROM src")
        con.execute(f"COPY ({body}) TO '{out}/{t}.parquet' (FORMAT parquet)")
    return out


@pytest.fixture(scope="module")
def duck(skewed_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{skewed_dir}/{t}.parquet')")
    return con


def test_skew_is_planted(duck):
    share = duck.execute("SELECT AVG(CASE WHEN o_custkey = 1 THEN 1.0 ELSE 0 END) FROM orders").fetchone()[0]
    assert share > 0.33


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_query_matches_oracle_under_skew(spark, duck, skewed_dir, name):
    df = core_queries()[name](spark, skewed_dir)
    rel = duck.execute(core_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert _rows(df.columns, df.collect()) == _rows(d_cols, rel.fetchall())


def test_gold_step_rollups_under_skew(spark, skewed_dir):
    """The file pipeline's grouping-sets path equals the direct gold queries on hot keys."""
    from shelfwise.operators import gold
    from shelfwise.plans.registry import silver_tables

    s = silver_tables(spark, skewed_dir)
    valued = gold.orders_with_value(s["orders"], s["order_items"])
    rollups = gold.order_rollups(valued)
    for direct, rolled in [
        (gold.daily_orders(valued), gold.daily_orders_from_rollups(rollups)),
        (gold.delivery_performance(s["orders"]), gold.delivery_performance_from_rollups(rollups)),
        (gold.location_insights(valued, s["customers"]),
         gold.location_insights_from_rollups(rollups, s["customers"])),
    ]:
        assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0
