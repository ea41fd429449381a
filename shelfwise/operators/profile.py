"""Bronze profiling checks (B1-B7): report-only Spark jobs.

Each check takes the dict of bronze tables and returns one small
DataFrame. A check over several tables is a single plan (a union of
per-table aggregates), and every per-column statistic of a table comes from
one aggregate pass over it, never one job per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions import count_when, half_up_mean, percent, with_total
from shelfwise.operators.repeats import repeated_rows

# The foreign keys checked (label, fact table, fk column,
# dimension table, key column), the business columns that identify a
# duplicate order item (its surrogate id is unique by construction), and the
# columns that may not be negative (rule, table, column).
FOREIGN_KEYS = [
    ("orders.customer_id", "orders", "customer_id", "customers", "customer_id"),
    ("order_items.order_id", "order_items", "order_id", "orders", "order_id"),
    ("order_items.product_id", "order_items", "product_id", "products", "product_id"),
    ("inventory.product_id", "inventory", "product_id", "products", "product_id"),
]
ITEM_BUSINESS_COLUMNS = ["order_id", "product_id", "quantity", "unit_price"]
INVALID_RULES = [
    ("negative_delivery_time", "orders", "delivery_time_minutes"),
    ("negative_unit_price", "order_items", "unit_price"),
    ("negative_stock_quantity", "inventory", "stock_quantity"),
]
SLOW_STORES_K = 5


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """B1: rows per table plus a TOTAL row.

    The tables are tagged and rolled up in one aggregate; column pruning
    leaves the scans reading no data columns. One zero-weight marker row per
    table keeps an empty table in the report (a group needs a row).
    """
    spark = next(iter(tables.values())).sparkSession
    tagged = _union(
        [df.select(F.lit(name).alias("table_name"), F.lit(1).alias("_w")) for name, df in tables.items()]
        + [spark.createDataFrame([(name, 0) for name in tables], "table_name string, _w int")]
    )
    return (
        tagged.rollup("table_name")
        .agg(F.sum("_w").cast("long").alias("n"))
        .select(F.coalesce(F.col("table_name"), F.lit("TOTAL")).alias("table_name"), "n")
    )


def null_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """B2: NULL count and share (2 dp) per column; columns without NULLs omitted."""
    per_table = []
    for name, df in tables.items():
        stats = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[count_when(F.col(c).isNull()).alias(c) for c in df.columns],
        )
        long = stats.unpivot("_rows", df.columns, "column_name", "n")
        per_table.append(long.select(F.lit(name).alias("table_name"), "column_name", "n", "_rows"))
    return (
        _union(per_table)
        .filter(F.col("n") > 0)
        .select("table_name", "column_name", "n", percent("n", "_rows", 2).alias("pct"))
    )


def orphan_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows whose foreign key has no match in its dimension (NULL keys count).

    Facts and dimension are one union of (check, key, rows, known), where a
    fact row counts one and a dimension row is known, and one aggregate by
    check and key: a key that is not known is an orphan with all its rows.
    Both sides meet in the aggregate's only exchange, which a key referenced
    by a third of the table enters as one row a task; there is no join, no
    sort and no column that may grow. A NULL key is a group like others, but
    never known. Checks without orphans are in the report with zero.
    """
    spark = next(iter(tables.values())).sparkSession
    frames = [spark.createDataFrame([(label, None, 0, True) for label, *_ in FOREIGN_KEYS], "fk string, _k long, _rows long, _known boolean")]
    for label, fact, fk, dim, key in FOREIGN_KEYS:
        frames.append(tables[fact].select(F.lit(label).alias("fk"), F.col(fk).cast("long").alias("_k"), F.lit(1).cast("long").alias("_rows"),
                                          F.lit(False).alias("_known")))
        frames.append(tables[dim].select(F.lit(label).alias("fk"), F.col(key).cast("long").alias("_k"), F.lit(0).cast("long").alias("_rows"),
                                         F.col(key).isNotNull().alias("_known")))
    by_key = _union(frames).groupBy("fk", "_k").agg(F.sum("_rows").alias("_rows"), F.max("_known").alias("_known"))
    missing = F.when(F.col("_known") & F.col("_k").isNotNull(), 0).otherwise(F.col("_rows"))
    return by_key.groupBy("fk").agg(F.sum(missing).cast("long").alias("n"))


def status_distribution(tables: dict[str, DataFrame]) -> DataFrame:
    """Order status counts with share of all orders (1 dp), most frequent first.

    NULL statuses are not a group but stay in the denominator.
    """
    counts = tables["orders"].groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))
    return (
        with_total(counts, "n").filter(F.col("order_status").isNotNull())
        .select("order_status", "n", percent("n", "_total", 1).alias("pct"))
        .orderBy(F.desc("n"), F.asc("order_status"))
    )


def slow_stores(tables: dict[str, DataFrame], k: int = SLOW_STORES_K) -> DataFrame:
    """The ``k`` stores with the highest mean positive delivery time (1 dp)."""
    minutes = F.col("delivery_time_minutes")
    return (
        tables["orders"]
        .withColumn("store_id", F.col("store_id").try_cast("int"))  # an id that is no int is no store
        .filter((minutes > 0) & F.col("store_id").isNotNull())
        .groupBy("store_id")
        .agg(F.sum(minutes).alias("_s"), F.count(minutes).alias("_c"))
        .orderBy((F.col("_s") / F.col("_c")).desc(), F.asc("store_id"))
        .limit(k)
        .select("store_id", half_up_mean("_s", "_c", 1).alias("avg_delivery_minutes"))
    )


def duplicate_counts(tables: dict[str, DataFrame], bits: int = 128) -> DataFrame:
    """Rows beyond the first of each group of identical rows (NULLs equal).

    order_items are compared on their business columns. Rows are compared
    themselves only where their digests repeat (:func:`repeats.repeated_rows`).
    """
    frames = []
    for name, df in tables.items():
        groups = repeated_rows(df, ITEM_BUSINESS_COLUMNS if name == "order_items" else df.columns, bits)
        frames.append(groups.agg(F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).cast("long").alias("n"))
                      .select(F.lit(name).alias("table_name"), "n"))
    return _union(frames)


def invalid_values(tables: dict[str, DataFrame]) -> DataFrame:
    """Negative delivery times, unit prices and stock quantities."""
    return _union([
        tables[t].agg(count_when(F.col(c) < 0).alias("n")).select(F.lit(rule).alias("rule"), "n")
        for rule, t, c in INVALID_RULES
    ])


def table_metrics(name: str, columns: list[str]) -> list[Column]:
    """Aggregates of one table that make up its rows in B1, B2 and B7: to be observed on a job that reads it anyway."""
    return [F.count(F.lit(1)).alias("rows"), *[count_when(F.col(c).isNull()).alias(f"null {c}") for c in columns],
            *[count_when(F.col(c) < 0).alias(f"rule {rule}") for rule, t, c in INVALID_RULES if t == name]]


def reports_of_metrics(spark: SparkSession, metrics: dict[str, dict[str, int]]) -> dict[str, DataFrame]:
    """B1, B2 and B7 from the metrics of every table: a few numbers a column, no table is read."""
    rows = [(t, m["rows"]) for t, m in metrics.items()]
    nulls = [(t, k.removeprefix("null "), n, m["rows"]) for t, m in metrics.items() for k, n in m.items() if k.startswith("null ") and n]
    rules = [(rule, metrics[t][f"rule {rule}"]) for rule, t, _ in INVALID_RULES]
    return {
        "check_row_counts": spark.createDataFrame([*rows, ("TOTAL", sum(n for _, n in rows))], "table_name string, n long"),
        "check_nulls": spark.createDataFrame(nulls, "table_name string, column_name string, n long, _rows long").select(
            "table_name", "column_name", "n", percent("n", "_rows", 2).alias("pct")),
        "check_invalid": spark.createDataFrame(rules, "rule string, n long"),
    }


CHECKS = {
    "check_row_counts": row_counts,
    "check_nulls": null_counts,
    "check_orphans": orphan_counts,
    "check_status_dist": status_distribution,
    "check_slow_stores": slow_stores,
    "check_duplicates": duplicate_counts,
    "check_invalid": invalid_values,
}


def profile_bronze(tables: dict[str, DataFrame], metrics: dict[str, dict[str, int]] | None = None) -> dict[str, DataFrame]:
    """All seven checks (lazy); those that ``metrics`` of the tables tell don't read them again."""
    known = reports_of_metrics(next(iter(tables.values())).sparkSession, metrics) if metrics else {}
    return {name: known[name] if name in known else fn(tables) for name, fn in CHECKS.items()}
