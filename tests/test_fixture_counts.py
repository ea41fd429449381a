"""Row counts of the registered queries at sf0.001 equal those FIXTURES.md §4 lists."""

import pytest

import __spark_entry__ as entry
from tests.conftest import SF_SMALL

EXPECTED = {
    "silver_customers": 150, "silver_orders": 1497, "silver_order_items": 5996,
    "silver_products": 200, "silver_inventory": 6000, "order_value": 1472,
    "daily_orders": 1091, "product_performance": 200, "category_performance": 6,
    "inventory_health": 8, "delivery_performance": 50, "location_insights": 26,
    "x01_demand_concentration": 2, "x02_orders_by_hour": 24, "x03_slow_stores": 5,
    "x04_cancel_by_delay": 2, "x06_latest_snapshot": 200, "x08_delivery_by_location": 26,
    "x09_demand_by_area": 26, "x10_demand_stock_ratio": 8, "x11_stockout_by_decile": 8,
    "x12_missing_snapshots": 1897,
}


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_row_count(spark, name):
    assert entry.queries()[name](spark, SF_SMALL).count() == EXPECTED[name]


def test_planted_totals(spark):
    q = entry.queries()
    assert q["q01_order_totals"](spark, SF_SMALL).first().total_cancelled_orders == 513
    health = {r.is_low_stock: r for r in q["inventory_health"](spark, SF_SMALL)
              .groupBy("is_low_stock").count().collect()}
    assert health[True]["count"] == 2
    assert q["inventory_health"](spark, SF_SMALL).filter("is_stock_out").count() == 2
