"""Silver cleaning rules on hand-written rows (one per hazard)."""

import datetime as dt
import os
from decimal import Decimal

from shelfwise.operators import silver
from shelfwise.sources import io
from shelfwise.sources.schemas import BRONZE

D = dt.date(2024, 1, 1)


def test_customers_fill_then_dedup(spark):
    rows = [(1, "a", "X", None, D), (1, "a", "X", "Unknown", D), (2, "b", "Y", "P", D), (2, "b", "Y", "P", D)]
    out = silver.clean_customers(spark.createDataFrame(rows, BRONZE["customers"]))
    got = sorted((r.customer_id, r.area) for r in out.collect())
    # rows equal only after filling collapse; exact duplicates collapse
    assert got == [(1, "Unknown"), (2, "P")]


def test_orders_store_and_sign(spark):
    rows = [
        (1, 10, D, "10:00:00", 3.0, -12, "Delivered"),
        (2, 10, D, "11:00:00", None, 20, "Cancelled"),
        (3, 11, D, "12:00:00", 7.0, 46, "Returned"),
    ]
    out = silver.clean_orders(spark.createDataFrame(rows, BRONZE["orders"]))
    got = sorted((r.order_id, r.store_id, r.delivery_time_minutes) for r in out.collect())
    assert got == [(1, 3, 12), (3, 7, 46)]
    assert dict(out.dtypes)["store_id"] == "int"


def test_order_items_filters_keep_duplicates(spark):
    p = Decimal("2.50")
    rows = [
        (1, 1, 100, 2, p), (2, 1, 100, 2, p),  # duplicate business rows: kept
        (3, 1, 101, 0, p), (4, 1, 102, None, p), (5, 1, 103, 1, Decimal("-1.00")), (6, 1, 104, 1, None),
    ]
    out = silver.clean_order_items(spark.createDataFrame(rows, BRONZE["order_items"]))
    assert sorted(r.order_item_id for r in out.collect()) == [1, 2]


def test_products_keep_a_row_with_a_valid_price(spark):
    rows = [
        (1, "apple", "fruit", "b1", Decimal("-1.00")),
        (1, "banana", "fruit", "b1", Decimal("3.00")),
        (3, "plum", "fruit", "b1", None),
        (3, "plum", "fruit", "b1", Decimal("7.00")),
        (4, "fig", "fruit", "b1", Decimal("-2.00")),  # no valid row: the id goes
        (2, "pear", "fruit", "b2", Decimal("1.00")),
        (2, "pear", "fruit", "b2", Decimal("1.00")),
    ]
    out = silver.clean_products(spark.createDataFrame(rows, BRONZE["products"]))
    assert sorted((r.product_id, r.product_name) for r in out.collect()) == [(1, "banana"), (2, "pear"), (3, "plum")]
    assert out.columns == ["product_id", "product_name", "category", "brand", "price"]


def test_inventory_floor_keeps_null(spark):
    rows = [(D, 1, 1, -5), (D, 1, 2, None), (D, 1, 3, 0), (D, 1, 4, 10)]
    out = silver.clean_inventory(spark.createDataFrame(rows, BRONZE["inventory"]))
    assert sorted((r.product_id, r.stock_quantity) for r in out.collect()) == [(1, 0), (2, None), (3, 0), (4, 10)]


def test_csv_store_id_written_as_float(spark, workdir):
    os.makedirs(f"{workdir}/orders.csv")
    with open(f"{workdir}/orders.csv/part-0.csv", "w") as fh:
        fh.write("order_id,customer_id,order_date,order_time,store_id,delivery_time_minutes,order_status\n")
        fh.write("1,5,2024-01-01,18:30:00,3.0,-40,Delivered\n")
        fh.write("2,5,2024-01-02,19:00:00,,30,Cancelled\n")
    raw = io.read_bronze_csv(spark, workdir, "orders")
    out = silver.clean_orders(raw).collect()
    assert [(r.order_id, r.store_id, r.delivery_time_minutes, r.order_time) for r in out] == [
        (1, 3, 40, "18:30:00")]


def test_csv_null_marker(spark, workdir):
    os.makedirs(f"{workdir}/customers.csv")
    with open(f"{workdir}/customers.csv/part-0.csv", "w") as fh:
        fh.write("customer_id,customer_name,city,area,signup_date\n")
        fh.write("1,a,Pune,NA,2024-01-01\n2,b,Pune,,2024-01-02\n")
    plain = io.read_bronze_csv(spark, workdir, "customers")
    assert sorted((r.customer_id, r.area) for r in plain.collect()) == [(1, "NA"), (2, None)]
    marked = io.read_bronze_csv(spark, workdir, "customers", null_value="NA")
    assert sorted((r.customer_id, r.area) for r in silver.clean_customers(marked).collect()) == [
        (1, "Unknown"), (2, "Unknown")]


def test_orders_by_hour_from_string_times(spark):
    from shelfwise.operators.extensions import orders_by_hour

    rows = [(1, 1, D, "18:30:00", 1.0, 10, "Delivered"), (2, 1, D, "18:05:00", 1.0, 10, "Delivered"),
            (3, 1, D, "7:00:00", 1.0, 10, "Cancelled"), (4, 1, D, None, 1.0, 10, "Delivered"),
            (5, 1, D, "late", 1.0, 10, "Delivered"), (6, 1, D, "25:00:00", 1.0, 10, "Delivered")]
    df = spark.createDataFrame(rows, BRONZE["orders"])
    got = [(r.hour, r.orders, r.pct_of_orders) for r in orders_by_hour(df).collect()]
    assert got == [(7, 1, 33.3), (18, 2, 66.7)]  # unknown and malformed times are excluded


def test_csv_header_is_checked(spark, workdir):
    import pytest

    os.makedirs(f"{workdir}/products.csv")
    with open(f"{workdir}/products.csv/part-0.csv", "w") as fh:
        fh.write("product_id,category,product_name,brand,price\n")  # two columns swapped
        fh.write("1,fruit,apple,b1,1.00\n")
    with pytest.raises(Exception, match="(?i)header|CSV"):
        io.read_bronze_csv(spark, workdir, "products").collect()


def test_orders_bad_values_do_not_fail_the_job(spark):
    rows = [(1, 1, D, None, 3.0, -2147483648, "Delivered"),   # |min int| has no int
            (2, 1, D, None, 1e12, 10, "Delivered"),           # not a valid int store id
            (3, 1, D, None, 4.0, -7, "Delivered")]
    out = silver.clean_orders(spark.createDataFrame(rows, BRONZE["orders"])).collect()
    assert sorted((r.order_id, r.store_id, r.delivery_time_minutes) for r in out) == [(1, 3, None), (3, 4, 7)]
