"""Bronze profiling checks against the counts planted in the sf0.001 fixture."""

from shelfwise.operators import profile
from shelfwise.sources import fixtures
from tests.conftest import SF_SMALL


def _as_dict(df, key, value="n"):
    return {r[key]: r[value] for r in df.collect()}


def test_checks_on_fixture(spark):
    tables = fixtures.bronze_for_checks(spark, SF_SMALL)
    counts = _as_dict(profile.row_counts(tables), "table_name")
    assert counts["customers"] == 153 and counts["orders"] == 1500 and counts["products"] == 200
    assert counts["TOTAL"] == sum(v for k, v in counts.items() if k != "TOTAL")

    nulls = {(r.table_name, r.column_name): r.n for r in profile.null_counts(tables).collect()}
    assert nulls == {("customers", "area"): 2, ("orders", "store_id"): 3}

    orphans = _as_dict(profile.orphan_counts(tables), "fk")
    assert orphans["orders.customer_id"] == 4
    assert orphans["order_items.product_id"] == 10
    assert orphans["inventory.product_id"] == 0

    dups = _as_dict(profile.duplicate_counts(tables), "table_name")
    assert dups["customers"] == 3 and dups["order_items"] == 6

    invalid = _as_dict(profile.invalid_values(tables), "rule")
    assert invalid["negative_delivery_time"] == 5
    assert invalid["negative_stock_quantity"] == 2878
    assert invalid["negative_unit_price"] == 0

    dist = profile.status_distribution(tables).collect()
    assert sum(r.n for r in dist) == 1500
    assert [r.n for r in dist] == sorted((r.n for r in dist), reverse=True)

    slow = profile.slow_stores(tables).collect()
    assert len(slow) == 5
    # stores 1-5 are the planted slow ones
    assert sorted(r.store_id for r in slow) == [1, 2, 3, 4, 5]


def test_orphan_counts_null_keys(spark):
    orders = spark.createDataFrame([(1, None), (2, 7), (3, 8), (4, 8)], "order_id long, customer_id long")
    customers = spark.createDataFrame([(7,)], "customer_id long")
    items = spark.createDataFrame([(1, 1)], "order_id long, product_id long")
    products = spark.createDataFrame([(1,)], "product_id long")
    inventory = spark.createDataFrame([(1,)], "product_id long")
    got = _as_dict(profile.orphan_counts({"orders": orders, "customers": customers, "order_items": items,
                                          "products": products, "inventory": inventory}), "fk")
    assert got["orders.customer_id"] == 3  # NULL and both rows of the unknown id 8


def test_slow_stores_survive_a_store_id_that_is_no_int(spark):
    """B5 reports; it must not fail on one bad raw row under ANSI casts."""
    rows = [(1e12, 50), (3.0, 20), (3.0, 31), (None, 90), (float("nan"), 70)]
    orders = spark.createDataFrame(rows, "store_id double, delivery_time_minutes int")
    assert [tuple(r) for r in profile.slow_stores({"orders": orders}).collect()] == [(3, 25.5)]
