"""Every registered query against its DuckDB oracle at sf0.001 (exact values)."""

import datetime as dt
import decimal
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from oracle_sql import oracle_sql as core_sql
from shelfwise.plans.registry import queries as core_queries
from tests.conftest import SF_SMALL

NAMES = sorted(core_queries())


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, (float, decimal.Decimal)):
        return repr(float(v))
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return repr(v)


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in records)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in os.listdir(SF_SMALL):
        name = path.split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_SMALL}/{path}')")
    return con


def test_every_query_has_an_oracle():
    assert set(core_sql()) == set(core_queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = core_queries()[name](spark, SF_SMALL)
    rel = duck.execute(core_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, rel.fetchall())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "total_orders", "cancelled_orders", "avg_order_value"]
    assert df.count() == 1091
