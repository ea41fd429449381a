"""Exact rounding helpers and the distributed ranking operator."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfwise.functions import half_up_mean, half_up_ratio, percent
from shelfwise.operators.ranking import global_row_number, ntile_of


def _expected(num: Decimal, den: int, scale: int) -> float:
    q = (num / Decimal(den)).quantize(Decimal(1).scaleb(-scale), rounding=ROUND_HALF_UP) if den else None
    return None if q is None else float(q)


def test_half_up_on_ties(spark):
    # 1.005 is a tie in decimal but below it as a double; exact rounding goes up.
    rows = [(Decimal("2.01"), 2), (Decimal("0.05"), 2), (Decimal("1.15"), 2), (Decimal("-2.01"), 2),
            (Decimal("10.00"), 3), (Decimal("5.00"), 0)]
    df = spark.createDataFrame(rows, "v decimal(12,2), n long")
    got = [r[0] for r in df.select(half_up_mean("v", "n", 2)).collect()]
    assert got == [1.01, 0.03, 0.58, -1.01, 3.33, None]


def test_percent_tenths(spark):
    df = spark.createDataFrame([(1, 8), (1, 16), (45, 1000), (0, 5)], "a long, b long")
    got = [r[0] for r in df.select(percent("a", "b", 1)).collect()]
    assert got == [12.5, 6.3, 4.5, 0.0]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**6)), min_size=1, max_size=20),
       st.integers(0, 3))
def test_half_up_ratio_matches_decimal(spark, pairs, scale):
    df = spark.createDataFrame(pairs, "a long, b long")
    got = [r[0] for r in df.select(half_up_ratio("a", "b", scale)).collect()]
    assert got == [_expected(Decimal(a), b, scale) for a, b in pairs]


def test_global_row_number_matches_window(spark):
    df = spark.range(0, 5000).select(
        F.col("id"), (F.col("id") % 7).alias("k"))  # heavy ties on k, broken by id
    order = [F.desc("k"), F.asc("id")]
    ours = global_row_number(df, order, "rn", partitions=6)
    ref = df.withColumn("rn_ref", F.row_number().over(Window.orderBy(*order)))
    joined = ours.join(ref, on=["id", "k"])
    assert joined.count() == 5000
    assert joined.filter(F.col("rn") != F.col("rn_ref")).count() == 0


def test_ntile_matches_sql(spark):
    for n in (1, 3, 9, 10, 11, 25, 97):
        df = spark.range(1, n + 1).select(F.col("id").alias("rn"))
        got = df.select("rn", ntile_of("rn", F.lit(n), 10).alias("t"))
        ref = df.select("rn", F.ntile(10).over(Window.orderBy("rn")).alias("t"))
        assert sorted(got.collect()) == sorted(ref.collect()), n


def test_rank_with_many_partitions(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "600")
    try:
        df = spark.range(0, 3000).select(F.col("id"))
        ranked = global_row_number(df, [F.asc("id")], "rn")
        assert ranked.filter(F.col("rn") != F.col("id") + 1).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
