"""Every registered query against its oracle on seeded random inputs.

The random tables have the driver's schema but none of its tidiness: NULLs
in keys, dates, quantities and prices, orphan keys on both sides, exact
duplicate line items, a hot customer and a hot part, and statuses outside
the usual set. Values keep the same precision as the real data (integral
quantities, two-decimal prices) so the two engines' casts agree.
"""

import datetime as dt
import tempfile

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from oracle_sql import oracle_sql as core_sql
from shelfwise.plans.registry import queries as core_queries
from tests.conftest import SF_SMALL
from tests.test_oracle import _rows

SEEDS = [3, 11, "empty-facts", "empty-orders", "empty-dims", "null-measures", "single-key"]
EMPTIED = {"empty-facts": {"lineitem"}, "empty-orders": {"orders"}, "empty-dims": {"customer", "part"}}


def _maybe_null(rng, values, p):
    return [None if rng.random() < p else v for v in values]


def _write(table: pa.Table, path: str, empty: bool) -> None:
    pq.write_table(table.slice(0, 0) if empty else table, path)


def _make_tables(seed) -> str:
    emptied = EMPTIED.get(seed, set())
    all_null = seed == "null-measures"  # every quantity, price and date is NULL
    hot_share = 1.0 if seed == "single-key" else 0.33  # one customer / one part holds this share
    rng = np.random.default_rng(seed if isinstance(seed, int) else 0)
    out = tempfile.mkdtemp(prefix=f"shelfwise-random-{seed}-")
    # region/nation/events: the real small tables
    for t in ("region", "nation", "events", "supplier"):
        pq.write_table(pq.read_table(f"{SF_SMALL}/{t}.parquet"), f"{out}/{t}.parquet")

    n_cust, n_part, n_orders, n_items = 60, 40, 300, 1200
    cust_keys = [int(k) for k in rng.choice(np.arange(0, 80), n_cust, replace=False)]
    _write(pa.table({
        "c_custkey": pa.array(_maybe_null(rng, cust_keys, 0.03), pa.int64()),
        "c_name": pa.array([f"Customer#{k}" for k in cust_keys], pa.string()),
        "c_nationkey": pa.array(_maybe_null(rng, [int(x) for x in rng.integers(0, 27, n_cust)], 0.05), pa.int32()),
        "c_acctbal": pa.array(rng.normal(size=n_cust), pa.float64()),
        "c_mktsegment": pa.array(["X"] * n_cust, pa.string()),
    }), f"{out}/customer.parquet", "customer" in emptied)

    part_keys = list(range(n_part))
    _write(pa.table({
        "p_partkey": pa.array(part_keys + [3, 5], pa.int64()),  # two duplicated product ids
        "p_name": pa.array(_maybe_null(rng, [f"part {k}" for k in part_keys], 0.05) + ["zz", "aa"], pa.string()),
        "p_brand": pa.array([f"B{k % 4}" for k in part_keys] + ["B9", "B9"], pa.string()),
        "p_type": pa.array(_maybe_null(rng, [f"T{k % 5}" for k in part_keys], 0.1) + ["T1", "T2"], pa.string()),
        "p_size": pa.array([1] * (n_part + 2), pa.int32()),
        "p_retailprice": pa.array(
            _maybe_null(rng, [round(float(x), 2) for x in rng.uniform(1, 500, n_part)], 0.05)
            + [-1.0, 2.5], pa.float64()),
    }), f"{out}/part.parquet", "part" in emptied)

    base = dt.datetime(2024, 1, 1)
    okeys = [int(k) for k in rng.choice(np.arange(0, 400), n_orders, replace=False)]
    cust = [1 if rng.random() < hot_share else int(k) for k in rng.integers(-5, 90, n_orders)]  # hot customer 1
    _write(pa.table({
        "o_orderkey": pa.array(_maybe_null(rng, okeys, 0.02), pa.int64()),
        "o_custkey": pa.array(_maybe_null(rng, cust, 0.05), pa.int64()),
        "o_orderstatus": pa.array(_maybe_null(rng, list(rng.choice(["F", "O", "P", "X"], n_orders)), 0.05),
                                  pa.string()),
        "o_totalprice": pa.array(rng.uniform(size=n_orders), pa.float64()),
        "o_orderdate": pa.array(_maybe_null(
            rng, [base + dt.timedelta(days=int(d)) for d in rng.integers(0, 40, n_orders)],
            1.0 if all_null else 0.03), pa.timestamp("us")),
        "o_orderpriority": pa.array(["1-URGENT"] * n_orders, pa.string()),
    }), f"{out}/orders.parquet", "orders" in emptied)

    lok = [int(k) for k in rng.choice(okeys + [1000, 1001, 1011], n_items)]  # some orphan orders
    lpk = [0 if rng.random() < hot_share else int(k) for k in rng.integers(0, n_part + 5, n_items)]  # hot part 0
    qty = [float(q) for q in rng.integers(1, 51, n_items)]
    price = [round(float(x), 2) for x in rng.uniform(0, 1000, n_items)]
    ship = [base + dt.timedelta(days=int(d)) for d in rng.integers(0, 120, n_items)]
    cols = {
        "l_orderkey": _maybe_null(rng, lok, 0.02),
        "l_partkey": _maybe_null(rng, lpk, 0.02),
        "l_suppkey": _maybe_null(rng, [int(s) for s in rng.integers(0, 6, n_items)], 0.02),
        "l_linenumber": [1] * n_items,
        "l_quantity": _maybe_null(rng, qty, 1.0 if all_null else 0.03),
        "l_extendedprice": _maybe_null(rng, price, 1.0 if all_null else 0.03),
        "l_discount": [0.0] * n_items,
        "l_tax": [0.0] * n_items,
        "l_returnflag": ["N"] * n_items,
        "l_linestatus": ["O"] * n_items,
        "l_shipdate": _maybe_null(rng, ship, 1.0 if all_null else 0.03),
    }
    dup = [int(i) for i in rng.choice(n_items, 40)]  # exact duplicate line items
    for name in cols:
        cols[name] = cols[name] + [cols[name][i] for i in dup]
    types = {"l_orderkey": pa.int64(), "l_partkey": pa.int64(), "l_suppkey": pa.int64(),
             "l_linenumber": pa.int32(), "l_quantity": pa.float64(), "l_extendedprice": pa.float64(),
             "l_discount": pa.float64(), "l_tax": pa.float64(), "l_returnflag": pa.string(),
             "l_linestatus": pa.string(), "l_shipdate": pa.timestamp("us")}
    _write(pa.table({k: pa.array(v, types[k]) for k, v in cols.items()}), f"{out}/lineitem.parquet",
           "lineitem" in emptied)
    return out


@pytest.fixture(scope="module", params=SEEDS)
def random_dir(request):
    return _make_tables(request.param)


@pytest.fixture(scope="module")
def duck(random_dir):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{random_dir}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_query_matches_oracle_on_random_data(spark, duck, random_dir, name):
    df = core_queries()[name](spark, random_dir)
    rel = duck.execute(core_sql()[name])
    d_cols = [d[0] for d in rel.description]
    assert sorted(df.columns) == sorted(d_cols)
    assert _rows(df.columns, df.collect()) == _rows(d_cols, rel.fetchall())


def test_pipeline_gold_path_on_random_data(spark, random_dir):
    """The file pipeline's grouping-sets gold step equals the standalone gold queries."""
    from shelfwise.plans.layers import cached_gold
    from shelfwise.plans.registry import gold_tables, silver_tables

    tables, cached = cached_gold(silver_tables(spark, random_dir))
    try:
        for name, direct in gold_tables(spark, random_dir).items():
            rolled = tables[name]
            assert direct.dtypes == rolled.dtypes, name
            assert direct.exceptAll(rolled).count() == 0 and rolled.exceptAll(direct).count() == 0, name
    finally:
        for df in cached:
            df.unpersist()
