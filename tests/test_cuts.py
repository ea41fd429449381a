"""Cuts by histograms against row_number and ntile."""

import random

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import extensions as ext
from shelfwise.operators.cuts import cut_keys, keyed, segment

LONGS = [0, 1, -1, 2**63 - 1, -(2**63), 2**44, 2**22 - 1, 2**22, -(2**22), -(2**44) - 1, None]


def ordered(rows, down):
    big = lambda x: (x is None, 0 if x is None else (-x if down else x))
    return sorted(rows, key=lambda r: (big(r[0]), (r[1] is None, r[1] if r[1] is not None else 0)))


@pytest.mark.parametrize("seed", range(2))
def test_keys_at_ranks(spark, seed):
    rng = random.Random(seed)
    ids = rng.sample([*range(-30, 30), *LONGS[3:-1]], 50) + [None]
    rows = [(rng.choice(LONGS + [5] * 8), i) for i in ids]
    down = bool(seed % 2)
    df = keyed(spark.createDataFrame(rows, "units long, id long"), [("units", down), ("id", False)])
    ranks = [1, 2, 7, 26, 50, 51, 0, 52]
    pick = F.array(*[F.lit(r) for r in ranks])
    keys = cut_keys(df, len(ranks), lambda cut, n: pick[cut - 1])
    assert {r["taken"] for r in keys.collect()} == {1}
    found = {r["cut"]: tuple(r["key"]) for r in keys.collect()}
    by_key = {(r["_n1"], r["_k1"], r["_n2"], r["_k2"]): (r["units"], r["id"]) for r in df.collect()}
    want = ordered(rows, down)
    assert {c: by_key[k] for c, k in found.items()} == {c + 1: want[r - 1] for c, r in enumerate(ranks) if 0 < r <= 51}


@pytest.mark.parametrize("n", [0, 3, 10, 25])
def test_tiles(spark, n):
    rows = [(i * 7 % 5, i, i % 3 == 0) for i in range(n)]
    health = spark.createDataFrame(rows, "total_demand long, product_id long, is_stock_out boolean")
    tiles = health.selectExpr("ntile(10) OVER (ORDER BY total_demand DESC, product_id) AS decile", "is_stock_out")
    want = {r["decile"]: (r["n"], r["k"]) for r in tiles.groupBy("decile").agg(
        F.count("*").alias("n"), F.count_if("is_stock_out").alias("k")).collect()}
    got = {r["decile"]: (r["products"], r["stocked_out"]) for r in ext.stockout_by_decile(health).collect()}
    assert got == want


@pytest.mark.parametrize("n", [0, 4, 23])
def test_top_share(spark, n):
    sales = spark.createDataFrame([(i, i * 3 % 4) for i in range(n)], "product_id long, units_sold long")
    got = {r["segment"]: (r["products"], r["units"]) for r in ext.demand_concentration(sales).collect()}
    order = sorted(((-(i * 3 % 4), i) for i in range(n)))
    top, rest = order[:n * 20 // 100], order[n * 20 // 100:]
    assert got == {name: (len(own), -sum(u for u, _ in own)) for name, own in (("top_20pct", top), ("other", rest)) if own}


def test_nothing_is_sorted_by_range_or_run_early(spark):
    sales = spark.range(1000).selectExpr("id AS product_id", "id % 17 AS units_sold")
    health = sales.selectExpr("product_id", "units_sold AS total_demand", "false AS is_stock_out")
    for df in (ext.demand_concentration(sales), ext.stockout_by_decile(health).select("decile", "products")):
        plan = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
        assert "checkpoint" not in plan.lower()
        # the report's ten rows are put in order at the end, nothing else is
        assert plan.count("rangepartitioning") <= (1 if "decile" in df.columns else 0)


def test_rows_with_one_key(spark):
    df = keyed(spark.createDataFrame([(u,) for u in [5] * 4 + [3] * 3 + [None] * 2], "units long"), [("units", True)])
    found = {r["cut"]: (r["key"]["_n1"], ~r["key"]["_k1"], r["taken"]) for r in cut_keys(df, 9, lambda cut, n: cut).collect()}
    assert [found[c][2] for c in range(1, 10)] == [1, 2, 3, 4, 1, 2, 3, 1, 2]
    assert [found[c][1] if not found[c][0] else None for c in (1, 4, 5, 7, 8)] == [5, 5, 3, 3, None]


def test_segments(spark):
    df = keyed(spark.range(10).selectExpr("id", "0L AS units"), [("units", True), ("id", False)])
    cuts = cut_keys(df, 3, lambda cut, n: cut * 3)
    got = sorted((r["id"], r["s"]) for r in df.select("id", segment(df, cuts, 3).alias("s")).collect())
    assert got == [(i, 1 + min(i // 3, 3)) for i in range(10)]
