"""Independent DuckDB SQL for every registered query (the correctness oracle).

Conditional counts are written ``COUNT(*) FILTER (WHERE ...)``: DuckDB's
``COUNT_IF`` returns NULL rather than 0 over no rows.

Written directly from the metric definitions, not from the Spark code: the
fixture mapping is spelled out as CTEs over the driver's views, joins are
row-level (the Spark side pre-aggregates), and rounding uses integer
half-up arithmetic on HUGEINT. Result types are cast to the Spark ones.
"""

from __future__ import annotations

# --- bronze fixtures (FIXTURES.md) and silver --------------------------------
BASE = """
base_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name, r_name AS city,
         CASE WHEN c_custkey % 200 = 7 THEN NULL ELSE n_name END AS area
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
),
b_customers AS (
  SELECT * FROM base_customers UNION ALL SELECT * FROM base_customers WHERE customer_id % 50 = 7
),
b_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS brand,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price
  FROM part
),
x_products AS (
  SELECT * FROM b_products
  UNION ALL SELECT product_id, product_name, category, brand, CAST(-5 AS DECIMAL(12,2)) FROM b_products WHERE product_id % 20 = 3
  UNION ALL SELECT product_id, product_name, category, brand, NULL FROM b_products WHERE product_id % 20 = 4
  UNION ALL SELECT product_id + 1000000, product_name, category, brand, CAST(-1 AS DECIMAL(12,2)) FROM b_products WHERE product_id % 50 = 5
),
b_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN o_orderkey % 500 = 3 THEN NULL ELSE CAST(o_custkey % 50 + 1 AS INT) END AS store_id,
         CAST((CASE WHEN o_orderkey % 333 = 5 THEN -1 ELSE 1 END)
              * (8 + (o_orderkey * 37) % 50 + (CASE WHEN o_custkey % 50 < 5 THEN 20 ELSE 0 END)) AS INT)
           AS delivery_time_minutes,
         CASE o_orderstatus WHEN 'F' THEN 'Delivered' WHEN 'O' THEN 'Cancelled' ELSE 'Returned' END
           AS order_status
  FROM orders
),
b_order_items AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id,
         CASE WHEN l_orderkey % 1000 = 11 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS unit_price
  FROM lineitem
),
b_inventory AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS inventory_date, l_suppkey AS store_id,
         l_partkey AS product_id, CAST(l_quantity AS INT) - 25 AS stock_quantity
  FROM lineitem
),
x_order_items AS (
  SELECT order_id,
         CASE WHEN order_id % 700 = 9 THEN product_id + 1000000 ELSE product_id END AS product_id,
         quantity, unit_price
  FROM b_order_items
  UNION ALL SELECT * FROM b_order_items WHERE order_id % 1000 = 13
),
x_orders AS (
  SELECT order_id,
         CASE WHEN order_id % 400 = 17 THEN customer_id + 1000000 ELSE customer_id END AS customer_id,
         order_date, store_id, delivery_time_minutes, order_status
  FROM b_orders
),
s_customers AS (
  SELECT DISTINCT customer_id, customer_name, city, COALESCE(area, 'Unknown') AS area FROM b_customers
),
s_orders AS (
  SELECT order_id, customer_id, order_date, TRY_CAST(store_id AS INT) AS store_id,
         TRY_CAST(abs(CAST(delivery_time_minutes AS BIGINT)) AS INT) AS delivery_time_minutes, order_status
  FROM b_orders WHERE TRY_CAST(store_id AS INT) IS NOT NULL
),
s_order_items AS (
  SELECT * FROM b_order_items WHERE quantity > 0 AND unit_price >= 0
),
s_products AS (
  SELECT product_id, product_name, category, brand, price FROM (
    SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST,
             category NULLS FIRST, brand NULLS FIRST, price) AS rn
    FROM b_products WHERE price >= 0) t
  WHERE rn = 1
),
s_inventory AS (
  SELECT inventory_date, store_id, product_id,
         CASE WHEN stock_quantity < 0 THEN 0 ELSE stock_quantity END AS stock_quantity
  FROM b_inventory
)"""

# --- gold --------------------------------------------------------------------
GOLD = """,
g_order_value AS (
  SELECT order_id, SUM(quantity * unit_price) AS order_value FROM s_order_items GROUP BY order_id
),
orders_valued AS (
  SELECT o.order_id, o.customer_id, o.order_date, o.order_status, v.order_value
  FROM s_orders o LEFT JOIN g_order_value v ON o.order_id = v.order_id
),
g_daily_orders AS (
  SELECT order_date,
         CAST(COUNT(order_id) AS BIGINT) AS total_orders,
         CAST(COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS BIGINT) AS cancelled_orders,
         CAST((2 * CAST(SUM(order_value * 100) AS HUGEINT) + COUNT(order_value))
              // NULLIF(2 * COUNT(order_value), 0) AS DOUBLE) / 100 AS avg_order_value
  FROM orders_valued GROUP BY order_date
),
g_product_sales AS (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS units_sold, SUM(quantity * unit_price) AS revenue
  FROM s_order_items GROUP BY product_id
),
g_product_performance AS (
  SELECT s.product_id, p.product_name, p.category, p.brand, s.units_sold, CAST(s.revenue AS DOUBLE) AS revenue
  FROM g_product_sales s LEFT JOIN s_products p ON s.product_id = p.product_id
),
g_category_performance AS (
  SELECT p.category, CAST(SUM(i.quantity) AS BIGINT) AS units_sold,
         CAST(SUM(i.quantity * i.unit_price) AS DOUBLE) AS revenue
  FROM s_order_items i LEFT JOIN s_products p ON i.product_id = p.product_id
  GROUP BY p.category
),
latest_stock AS (
  SELECT product_id, CAST(SUM(stock_quantity) AS BIGINT) AS total_stock
  FROM s_inventory WHERE inventory_date = (SELECT MAX(inventory_date) FROM s_inventory)
  GROUP BY product_id
),
g_inventory_health AS (
  SELECT st.product_id, p.product_name, p.category, st.total_stock,
         COALESCE(s.units_sold, 0) AS total_demand,
         st.total_stock < 10 AS is_low_stock, st.total_stock = 0 AS is_stock_out
  FROM latest_stock st
  LEFT JOIN g_product_sales s ON st.product_id = s.product_id
  LEFT JOIN s_products p ON st.product_id = p.product_id
),
store_stats AS (
  SELECT store_id, COUNT(order_id) AS total_orders,
         CAST(SUM(delivery_time_minutes) AS HUGEINT) AS s, COUNT(delivery_time_minutes) AS c,
         COUNT(*) FILTER (WHERE delivery_time_minutes > 45) AS late
  FROM s_orders GROUP BY store_id
),
g_delivery_performance AS (
  SELECT store_id, CAST(total_orders AS BIGINT) AS total_orders,
         CAST((20 * s + c) // NULLIF(2 * c, 0) AS DOUBLE) / 10 AS avg_delivery_minutes,
         CAST(late AS BIGINT) AS late_deliveries,
         CAST((2000 * CAST(late AS HUGEINT) + total_orders) // NULLIF(2 * total_orders, 0) AS DOUBLE) / 10
           AS late_delivery_pct
  FROM store_stats
),
g_location_insights AS (
  SELECT c.city, c.area, CAST(COUNT(ov.order_id) AS BIGINT) AS total_orders,
         CAST(SUM(ov.order_value) AS DOUBLE) AS total_revenue
  FROM orders_valued ov LEFT JOIN s_customers c ON ov.customer_id = c.customer_id
  GROUP BY c.city, c.area
)"""


def _with(body: str, gold: bool = True) -> str:
    return "WITH " + BASE + (GOLD if gold else "") + "\n" + body


def _cents(col: str) -> str:
    return f"CAST(ROUND({col} * 100) AS HUGEINT)"


def _pct(part: str, whole: str, scale: int) -> str:
    """round(part * 100 / whole, scale) half-up for non-negative integral part/whole."""
    f = 100 * 10 ** scale
    return (f"CAST((2 * {f} * CAST({part} AS HUGEINT) + {whole}) // NULLIF(2 * CAST({whole} AS HUGEINT), 0)"
            f" AS DOUBLE) / {10 ** scale}")


SILVER_SQL = {
    "silver_customers": "SELECT * FROM s_customers",
    "silver_orders": "SELECT * FROM s_orders",
    "silver_order_items": "SELECT order_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price FROM s_order_items",
    "silver_products": "SELECT product_id, product_name, category, brand, CAST(price AS DOUBLE) AS price FROM s_products",
    "silver_inventory": "SELECT * FROM s_inventory",
}

GOLD_SQL = {
    "order_value": "SELECT order_id, CAST(order_value AS DOUBLE) AS order_value FROM g_order_value",
    "daily_orders": "SELECT * FROM g_daily_orders",
    "product_performance": "SELECT * FROM g_product_performance",
    "category_performance": "SELECT * FROM g_category_performance",
    "inventory_health": "SELECT * FROM g_inventory_health",
    "delivery_performance": "SELECT * FROM g_delivery_performance",
    "location_insights": "SELECT * FROM g_location_insights",
}

QUESTION_SQL = {
    "q01_order_totals": f"""
SELECT CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(cancelled_orders) AS BIGINT) AS total_cancelled_orders,
       {_pct('SUM(cancelled_orders)', 'SUM(total_orders)', 2)} AS cancel_rate_pct,
       CAST((2 * SUM({_cents('avg_order_value')}) + COUNT(avg_order_value))
            // NULLIF(2 * COUNT(avg_order_value), 0) AS DOUBLE) / 100 AS overall_avg_order_value
FROM g_daily_orders""",
    "q02_daily_trend": """
SELECT order_date, total_orders, cancelled_orders, avg_order_value
FROM g_daily_orders ORDER BY order_date NULLS LAST LIMIT 10""",
    "q03_top_products": """
SELECT product_id, product_name, category, units_sold, revenue
FROM g_product_performance ORDER BY revenue DESC NULLS LAST, product_id LIMIT 10""",
    "q04_category_share": f"""
SELECT category, units_sold, revenue,
       CAST((2000 * {_cents('revenue')} + SUM({_cents('revenue')}) OVER ())
            // NULLIF(2 * SUM({_cents('revenue')}) OVER (), 0) AS DOUBLE) / 10 AS pct_of_total_revenue
FROM g_category_performance""",
    "q05_stockout_rate": f"""
SELECT CAST(COUNT(*) AS BIGINT) AS total_products,
       CAST(COUNT(*) FILTER (WHERE is_stock_out) AS BIGINT) AS stocked_out_products,
       {_pct('COUNT(*) FILTER (WHERE is_stock_out)', 'COUNT(*)', 2)} AS stock_out_rate_pct
FROM g_inventory_health""",
    "q06_urgent_restock": """
SELECT product_id, product_name, category, total_stock, total_demand
FROM g_inventory_health WHERE is_low_stock
ORDER BY total_demand DESC NULLS LAST, product_id LIMIT 10""",
    "q07_store_delivery": """
SELECT store_id, total_orders, avg_delivery_minutes, late_deliveries, late_delivery_pct
FROM g_delivery_performance""",
    "q08_late_rate": f"""
SELECT CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM(late_deliveries) AS BIGINT) AS total_late_deliveries,
       {_pct('SUM(late_deliveries)', 'SUM(total_orders)', 2)} AS overall_late_pct
FROM g_delivery_performance""",
    "q09_top_areas": """
SELECT city, area, total_orders, total_revenue
FROM g_location_insights
ORDER BY total_revenue DESC NULLS LAST, city NULLS LAST, area NULLS LAST LIMIT 10""",
    "q10_city_revenue": f"""
SELECT city, CAST(SUM(total_orders) AS BIGINT) AS total_orders,
       CAST(SUM({_cents('total_revenue')}) AS DOUBLE) / 100 AS total_revenue
FROM g_location_insights GROUP BY city""",
}

# --- bronze checks (on the tables with planted referential dirt) -----------------
CHECK_TABLES = {
    "customers": ("b_customers", ["customer_id", "customer_name", "city", "area"]),
    "products": ("b_products", ["product_id", "product_name", "category", "brand", "price"]),
    "orders": ("x_orders", ["order_id", "customer_id", "order_date", "store_id",
                            "delivery_time_minutes", "order_status"]),
    "order_items": ("x_order_items", ["order_id", "product_id", "quantity", "unit_price"]),
    "inventory": ("b_inventory", ["inventory_date", "store_id", "product_id", "stock_quantity"]),
}


def _row_counts() -> str:
    parts = [f"SELECT '{n}' AS table_name, CAST(COUNT(*) AS BIGINT) AS n FROM {v}"
             for n, (v, _) in CHECK_TABLES.items()]
    return ("WITH counts AS (" + " UNION ALL ".join(parts) + ")"
            " SELECT * FROM counts UNION ALL SELECT 'TOTAL', CAST(SUM(n) AS BIGINT) FROM counts")


def _nulls() -> str:
    parts = [f"SELECT '{n}' AS table_name, '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS n, COUNT(*) AS r FROM {v}"
             for n, (v, cols) in CHECK_TABLES.items() for c in cols]
    return ("SELECT table_name, column_name, CAST(n AS BIGINT) AS n, " + _pct("n", "r", 2) + " AS pct FROM ("
            + " UNION ALL ".join(parts) + ") t WHERE n > 0")


def _duplicates() -> str:
    parts = []
    for n, (v, cols) in CHECK_TABLES.items():
        cl = ", ".join(cols)
        parts.append(f"SELECT '{n}' AS table_name, CAST(COALESCE(SUM(c - 1), 0) AS BIGINT) AS n "
                     f"FROM (SELECT {cl}, COUNT(*) AS c FROM {v} GROUP BY {cl}) g")
    return " UNION ALL ".join(parts)


CHECK_SQL = {
    "check_row_counts": _row_counts(),
    "check_nulls": _nulls(),
    "check_orphans": """
SELECT 'orders.customer_id' AS fk, CAST(COUNT(*) AS BIGINT) AS n FROM x_orders o
  WHERE NOT EXISTS (SELECT 1 FROM b_customers c WHERE c.customer_id = o.customer_id)
UNION ALL
SELECT 'order_items.order_id', CAST(COUNT(*) AS BIGINT) FROM x_order_items i
  WHERE NOT EXISTS (SELECT 1 FROM x_orders o WHERE o.order_id = i.order_id)
UNION ALL
SELECT 'order_items.product_id', CAST(COUNT(*) AS BIGINT) FROM x_order_items i
  WHERE NOT EXISTS (SELECT 1 FROM b_products p WHERE p.product_id = i.product_id)
UNION ALL
SELECT 'inventory.product_id', CAST(COUNT(*) AS BIGINT) FROM b_inventory v
  WHERE NOT EXISTS (SELECT 1 FROM b_products p WHERE p.product_id = v.product_id)""",
    "check_status_dist": f"""
SELECT order_status, CAST(COUNT(*) AS BIGINT) AS n,
       {_pct('COUNT(*)', '(SELECT COUNT(*) FROM x_orders)', 1)} AS pct
FROM x_orders WHERE order_status IS NOT NULL GROUP BY order_status""",
    "check_slow_stores": """
SELECT CAST(store_id AS INT) AS store_id,
       CAST((20 * CAST(SUM(delivery_time_minutes) AS HUGEINT) + COUNT(delivery_time_minutes))
            // (2 * COUNT(delivery_time_minutes)) AS DOUBLE) / 10 AS avg_delivery_minutes
FROM x_orders WHERE delivery_time_minutes > 0 AND store_id IS NOT NULL
GROUP BY CAST(store_id AS INT)
ORDER BY AVG(delivery_time_minutes) DESC, store_id LIMIT 5""",
    "check_duplicates": _duplicates(),
    "check_invalid": """
SELECT 'negative_delivery_time' AS rule, CAST(COUNT(*) FILTER (WHERE delivery_time_minutes < 0) AS BIGINT) AS n FROM x_orders
UNION ALL SELECT 'negative_unit_price', CAST(COUNT(*) FILTER (WHERE unit_price < 0) AS BIGINT) FROM x_order_items
UNION ALL SELECT 'negative_stock_quantity', CAST(COUNT(*) FILTER (WHERE stock_quantity < 0) AS BIGINT) FROM b_inventory""",
}

# The gold quality rules (key columns, numeric columns).
# --- gold gate ---------------------------------------------------------------
GATE_RULES = {
    "daily_orders": (["order_date"], ["total_orders", "cancelled_orders"]),
    "product_performance": (["product_id", "product_name", "category"], ["units_sold", "revenue"]),
    "category_performance": (["category"], ["units_sold", "revenue"]),
    "inventory_health": (["product_id", "product_name"], ["total_stock", "total_demand"]),
    "delivery_performance": (["store_id"], ["total_orders", "avg_delivery_minutes", "late_deliveries"]),
    "location_insights": (["city", "area"], ["total_orders", "total_revenue"]),
}


def _gate(broken: bool = False) -> str:
    """The rule table; ``broken``: daily_orders is empty and delivery_performance is missing."""
    parts = []
    for t, (keys, nums) in GATE_RULES.items():
        src = f"g_{t}"
        if broken and t == "delivery_performance":
            parts.append(f"SELECT '{t}', 'exists', NULL, NULL, 1")
            continue
        if broken and t == "daily_orders":
            src = "(SELECT * FROM g_daily_orders WHERE false) e"
        n = f"(SELECT COUNT(*) FROM {src})"
        parts.append(f"SELECT '{t}' AS table_name, 'exists' AS rule, CAST(NULL AS VARCHAR) AS column_name, "
                     f"{n} AS n_rows, 0 AS bad_rows")
        parts.append(f"SELECT '{t}', 'not_empty', NULL, {n}, CASE WHEN {n} = 0 THEN 1 ELSE 0 END")
        for c in keys:
            parts.append(f"SELECT '{t}', 'not_null', '{c}', COUNT(*), COUNT(*) FILTER (WHERE {c} IS NULL) FROM {src} "
                         f"HAVING COUNT(*) > 0")
        for c in nums:
            parts.append(f"SELECT '{t}', 'non_negative', '{c}', COUNT(*), COUNT(*) FILTER (WHERE {c} < 0) FROM {src} "
                         f"HAVING COUNT(*) > 0")
    return ("SELECT table_name, rule, column_name, CAST(n_rows AS BIGINT) AS n_rows, "
            "CAST(bad_rows AS BIGINT) AS bad_rows, bad_rows = 0 AS passed FROM ("
            + "\nUNION ALL ".join(parts) + ") r")


# --- extensions --------------------------------------------------------------
EXTENSION_SQL: dict[str, str] = {
    "x01_demand_concentration": f"""
SELECT segment, CAST(COUNT(*) AS BIGINT) AS products, CAST(SUM(units_sold) AS BIGINT) AS units,
       {_pct('SUM(units_sold)', 'ANY_VALUE(tot)', 2)} AS units_share_pct
FROM (SELECT units_sold,
             CASE WHEN row_number() OVER (ORDER BY units_sold DESC NULLS LAST, product_id) * 100
                       <= COUNT(*) OVER () * 20 THEN 'top_20pct' ELSE 'other' END AS segment,
             SUM(units_sold) OVER () AS tot
      FROM g_product_sales) r
GROUP BY segment""",
    "x02_orders_by_hour": f"""
SELECT hour, CAST(COUNT(*) AS BIGINT) AS orders,
       {_pct('COUNT(*)', '(SELECT COUNT(*) FROM events WHERE event_type = ' + "'purchase'" + ' AND ts IS NOT NULL)', 1)}
         AS pct_of_orders
FROM (SELECT CAST(hour(ts) AS INT) AS hour FROM events WHERE event_type = 'purchase' AND ts IS NOT NULL) e
GROUP BY hour""",
    "x03_slow_stores": """
SELECT store_id,
       CAST((20 * CAST(s AS HUGEINT) + c) // NULLIF(2 * c, 0) AS DOUBLE) / 10 AS avg_delivery_minutes
FROM (SELECT store_id, SUM(delivery_time_minutes) AS s, COUNT(delivery_time_minutes) AS c,
             SUM(delivery_time_minutes) / COUNT(delivery_time_minutes) AS m
      FROM s_orders GROUP BY store_id) st
WHERE m > (SELECT AVG(m) + 2.0 * STDDEV_SAMP(m) FROM
             (SELECT SUM(delivery_time_minutes) / COUNT(delivery_time_minutes) AS m
              FROM s_orders GROUP BY store_id) x)""",
    "x04_cancel_by_delay": f"""
SELECT delay_band, CAST(COUNT(*) AS BIGINT) AS orders,
       CAST(COUNT(*) FILTER (WHERE order_status = 'Cancelled') AS BIGINT) AS cancelled,
       {_pct("COUNT(*) FILTER (WHERE order_status = 'Cancelled')", 'COUNT(*)', 2)} AS cancel_rate_pct
FROM (SELECT CASE WHEN delivery_time_minutes > 55 THEN '>55' ELSE '<=55' END AS delay_band, order_status
      FROM s_orders WHERE delivery_time_minutes IS NOT NULL) b
GROUP BY delay_band""",
    "x05_duplicate_keys": """
SELECT 'customers' AS table_name,
       CAST(COUNT(DISTINCT customer_id) + COALESCE(MAX(CASE WHEN customer_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) AS keys,
       CAST((SELECT COUNT(*) FROM (SELECT customer_id FROM b_customers GROUP BY customer_id HAVING COUNT(*) > 1) r) AS BIGINT)
         AS repeated_keys,
       CAST((SELECT COUNT(*) FROM (SELECT customer_id FROM s_customers GROUP BY customer_id HAVING COUNT(*) > 1) r) AS BIGINT)
         AS conflicting_keys
FROM b_customers
UNION ALL
SELECT 'products',
       CAST(COUNT(DISTINCT product_id) + COALESCE(MAX(CASE WHEN product_id IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT),
       CAST((SELECT COUNT(*) FROM (SELECT product_id FROM b_products GROUP BY product_id HAVING COUNT(*) > 1) r) AS BIGINT),
       CAST((SELECT COUNT(*) FROM (SELECT product_id FROM (SELECT DISTINCT * FROM b_products) d
                                   GROUP BY product_id HAVING COUNT(*) > 1) r) AS BIGINT)
FROM b_products""",
    "x06_latest_snapshot": """
SELECT product_id, CAST(COUNT(*) AS BIGINT) AS stores, CAST(SUM(s) AS BIGINT) AS total_stock
FROM (SELECT store_id, product_id, SUM(stock_quantity) AS s
      FROM (SELECT *, rank() OVER (PARTITION BY store_id, product_id
                                   ORDER BY inventory_date DESC NULLS LAST) AS rk
            FROM s_inventory WHERE inventory_date IS NOT NULL) r
      WHERE rk = 1 GROUP BY store_id, product_id) p
GROUP BY product_id""",
    "x07_weighted_aov": """
SELECT CAST(COUNT(order_id) AS BIGINT) AS orders, CAST(COUNT(order_value) AS BIGINT) AS valued_orders,
       CAST(SUM(order_value) AS DOUBLE) AS revenue,
       CAST((2 * CAST(SUM(order_value * 100) AS HUGEINT) + COUNT(order_value))
            // NULLIF(2 * COUNT(order_value), 0) AS DOUBLE) / 100 AS avg_order_value
FROM orders_valued""",
    "x08_delivery_by_location": """
SELECT city, area, CAST(total_orders AS BIGINT) AS total_orders,
       CAST((20 * s + c) // NULLIF(2 * c, 0) AS DOUBLE) / 10 AS avg_delivery_minutes,
       CAST(late AS BIGINT) AS late_deliveries,
       CAST((2000 * CAST(late AS HUGEINT) + total_orders) // NULLIF(2 * total_orders, 0) AS DOUBLE) / 10
         AS late_delivery_pct
FROM (SELECT c.city, c.area, COUNT(o.order_id) AS total_orders,
             CAST(SUM(o.delivery_time_minutes) AS HUGEINT) AS s, COUNT(o.delivery_time_minutes) AS c,
             COUNT(*) FILTER (WHERE o.delivery_time_minutes > 45) AS late
      FROM s_orders o LEFT JOIN s_customers c ON o.customer_id = c.customer_id
      GROUP BY c.city, c.area) t""",
    "x09_demand_by_area": """
SELECT c.city, c.area, CAST(SUM(i.quantity) AS BIGINT) AS units_sold
FROM s_order_items i JOIN s_orders o ON i.order_id = o.order_id
LEFT JOIN s_customers c ON o.customer_id = c.customer_id
GROUP BY c.city, c.area""",
    "x10_demand_stock_ratio": """
SELECT product_id, product_name, total_stock, total_demand,
       CAST((200 * CAST(total_demand AS HUGEINT) + total_stock) // NULLIF(2 * total_stock, 0) AS DOUBLE) / 100
         AS demand_to_stock
FROM g_inventory_health""",
    "x11_stockout_by_decile": f"""
SELECT decile, CAST(COUNT(*) AS BIGINT) AS products, CAST(COUNT(*) FILTER (WHERE is_stock_out) AS BIGINT) AS stocked_out,
       {_pct('COUNT(*) FILTER (WHERE is_stock_out)', 'COUNT(*)', 2)} AS stock_out_rate_pct
FROM (SELECT is_stock_out,
             CAST(ntile(10) OVER (ORDER BY total_demand DESC NULLS LAST, product_id) AS INT) AS decile
      FROM g_inventory_health) r
GROUP BY decile""",
    "x12_missing_snapshots": """
SELECT p.store_id, p.product_id, p.last_seen
FROM (SELECT store_id, product_id, MAX(inventory_date) AS last_seen FROM s_inventory
      GROUP BY store_id, product_id) p
WHERE p.last_seen IS NOT NULL AND NOT EXISTS (
  SELECT 1 FROM s_inventory l
  WHERE l.inventory_date = (SELECT MAX(inventory_date) FROM s_inventory)
    AND l.store_id IS NOT DISTINCT FROM p.store_id AND l.product_id IS NOT DISTINCT FROM p.product_id)""",
}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    for group in (SILVER_SQL, GOLD_SQL, QUESTION_SQL):
        for name, body in group.items():
            out[name] = _with(body)
    for name, body in CHECK_SQL.items():
        out[name] = _with(body, gold=False) if "WITH counts" not in body else _with_nested(body)
    out["gold_gate"] = _with(_gate())
    # the gate over gold built from items with orphans
    out["gold_gate_broken"] = _with(_gate(broken=True)).replace(
        "SELECT * FROM b_order_items WHERE quantity > 0", "SELECT * FROM x_order_items WHERE quantity > 0")
    out["silver_products_repeated"] = _with("""
SELECT product_id, product_name, category, brand, CAST(price AS DOUBLE) AS price
FROM (SELECT *, row_number() OVER (PARTITION BY product_id ORDER BY product_name NULLS FIRST,
             category NULLS FIRST, brand NULLS FIRST, price) AS rn
      FROM x_products WHERE price >= 0) t WHERE rn = 1""", gold=False)
    for name, body in EXTENSION_SQL.items():
        out[name] = _with(body)
    return out


def _with_nested(body: str) -> str:
    # a body that starts with its own WITH: merge it into the prelude
    inner = body[len("WITH "):]
    return "WITH " + BASE + ",\n" + inner
