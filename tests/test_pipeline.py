"""End to end: bronze CSV -> silver -> gold -> gate, written and read back."""

import glob

from shelfwise.plans import layers
from shelfwise.plans.analyst import QUESTIONS
from shelfwise.operators.gold import presented
from shelfwise.plans.registry import gold_tables, publish, queries, silver_tables
from shelfwise.sources import fixtures, io
from shelfwise.sources.schemas import GOLD_TABLES
from tests.conftest import SF_SMALL


def _same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_run_layers_end_to_end(spark, workdir):
    bronze_dir = f"{workdir}/bronze"
    for name, df in fixtures.bronze_with_all_columns(spark, SF_SMALL).items():
        io.write_bronze_csv(df, bronze_dir, name)
    out = f"{workdir}/out"
    summary = layers.run_layers(spark, bronze_dir, out)

    rows = {r.table: (r.before, r.after) for r in summary.silver_rows}
    assert rows == {"customers": (153, 150), "orders": (1500, 1497), "order_items": (6000, 5996),
                    "products": (200, 200), "inventory": (6000, 6000)}
    assert summary.malformed == dict.fromkeys(rows, 0)
    assert len(summary.gate_rules) == 35

    paths = layers.LayerPaths(out)
    # bronze is parsed once into a typed Parquet copy that checks and cleaning read
    staged = io.read_layer(spark, paths.staged, "orders")
    assert dict(staged.dtypes)["store_id"] == "double" and staged.count() == 1500
    # inventory is partitioned by snapshot date
    assert glob.glob(f"{paths.silver}/inventory.parquet/layer_version=*/inventory_date=*")
    expected = gold_tables(spark, SF_SMALL)
    for name in GOLD_TABLES:
        assert _same(expected[name], io.read_layer(spark, paths.gold, name)), name
        # every table is published in its order: its files, in the order of their names, are sorted
        files = sorted(glob.glob(f"{paths.gold}/{name}.parquet/layer_version=*/part-*"))
        got = [r for f in files for r in spark.read.parquet(f).collect()]
        assert got == presented(name, expected[name]).select(*got[0].asDict()).collect(), name
    for name in ("check_row_counts", "check_nulls", "check_duplicates"):
        assert io.read_layer(spark, paths.reports, name).count() > 0

    answers = layers.answer_questions(spark, paths.gold)
    reg = queries()
    for name in QUESTIONS:
        assert _same(reg[name](spark, SF_SMALL), publish(answers[name])), name
    # the gold tables are also usable from SQL
    assert spark.sql("SELECT COUNT(*) FROM daily_orders").first()[0] == expected["daily_orders"].count()

    # extensions over the written layers equal the registry's (x02 reads different time sources)
    written = layers.build_extensions(spark, out)
    assert len(written) == 12
    for name in written:
        got = io.read_layer(spark, paths.extensions, name)
        if name == "x02_orders_by_hour":
            assert got.count() == 24 and got.agg({"orders": "sum"}).first()[0] == 1497
            continue
        assert _same(reg[name](spark, SF_SMALL), publish(got)), name


def test_bad_csv_values_are_kept_and_reported(spark, workdir):
    """Over-wide, malformed and finer-than-cent values: no line vanishes without being counted."""
    from decimal import Decimal

    from shelfwise.operators.silver import CLEANERS

    lines = ["order_item_id,order_id,product_id,quantity,unit_price", "1,1,1,2,12345678901.00", "2,1,1,3000000000,1.00",
             "3,1,1,1,12.345", "4,1,1,abc,5.00", "5,1,1,1,99999999999999999999999.00", "6,1,1,1,7.00"]
    for name, df in fixtures.bronze_with_all_columns(spark, SF_SMALL).items():
        io.write_bronze_csv(df.limit(0) if name == "order_items" else df.limit(5), f"{workdir}/bronze", name)
    with open(f"{workdir}/bronze/order_items.csv/zz.csv", "w") as f:
        f.write("\n".join(lines) + "\n")
    staged = layers.stage_bronze(spark, f"{workdir}/bronze", f"{workdir}/staged")
    assert staged["order_items"].count() == 6 and io.MALFORMED not in staged["order_items"].columns
    bad = {r["table_name"]: r["n"] for r in layers.malformed_lines(spark, f"{workdir}/staged").collect()}
    assert bad["order_items"] == 2 and bad["orders"] == 0  # "abc", and more digits than money has
    kept = {r.order_item_id: (r.quantity, r.unit_price) for r in CLEANERS["order_items"](staged["order_items"]).collect()}
    assert kept[1] == (2, Decimal("12345678901.00")) and kept[2] == (3000000000, Decimal("1.00"))
    assert kept[3] == (1, Decimal("12.35")) and kept[6] == (1, Decimal("7.00"))


def test_gold_step_reads_items_once_an_aggregate(spark, workdir):
    """Only product-, date-, store- and customer-sized rows are cached; items meet orders in one exchange."""
    s = {name: df for name, df in silver_tables(spark, SF_SMALL).items()}
    tables, cached = layers.cached_gold(s)
    try:
        rows = sum(df.count() for df in cached)
        bound = sum(s[t].select(c).distinct().count() for t, c in (
            ("order_items", "product_id"), ("orders", "order_date"), ("orders", "store_id"), ("orders", "customer_id")))
        assert rows <= bound
        expected = gold_tables(spark, SF_SMALL)
        for name in GOLD_TABLES:
            assert _same(expected[name], tables[name]), name
    finally:
        for df in cached:
            df.unpersist()


def test_money_beyond_two_to_the_53_cents_is_exact(spark):
    from decimal import Decimal

    from shelfwise.operators import gold
    from shelfwise.plans import analyst, analyst_sql

    items = spark.sql("SELECT 1L AS order_id, 1L AS product_id, 1L AS quantity, 90071992547409.93BD AS unit_price "
                      "UNION ALL SELECT 2L, 2L, 1L, 0.01BD")
    products = spark.sql("SELECT id AS product_id, 'n' AS product_name, 'c' AS category, 'b' AS brand FROM range(1, 3)")
    perf = gold.product_performance(gold.product_sales(items), products)
    categories = gold.category_performance(perf)
    assert [r.revenue for r in categories.collect()] == [Decimal("90071992547409.94")]
    where = spark.sql("SELECT 'x' AS city, 'a' AS area, 1L AS total_orders, CAST(90071992547409.93BD AS DECIMAL(38,2)) AS total_revenue "
                      "UNION ALL SELECT 'x', 'b', 1L, CAST(0.01BD AS DECIMAL(38,2))")
    assert [r.total_revenue for r in analyst.city_revenue(where).collect()] == [Decimal("90071992547409.94")]
    where.createOrReplaceTempView("location_insights")
    assert [r.total_revenue for r in spark.sql(analyst_sql.QUESTION_SQL["q10_city_revenue"]).collect()] == [
        Decimal("90071992547409.94")]


def test_gate_fails_on_missing_gold(spark, workdir):
    import pytest

    from shelfwise.operators.gate import GateFailure

    g = gold_tables(spark, SF_SMALL)
    for name in GOLD_TABLES[1:]:
        io.write_table(g[name], workdir, name)
    with pytest.raises(GateFailure, match="daily_orders: exists"):
        layers.validate_gold(spark, workdir)


def test_cli_runs_layers(spark, workdir):
    from shelfwise.__main__ import main

    bronze_dir = f"{workdir}/bronze"
    for name, df in fixtures.bronze_with_all_columns(spark, SF_SMALL).items():
        io.write_bronze_csv(df, bronze_dir, name)
    assert main(["run", bronze_dir, f"{workdir}/out", "--cores", "4", "--input-gb", "0.01"]) == 0
    assert io.read_layer(spark, f"{workdir}/out/gold", "daily_orders").count() == 1091


def test_scale_settings():
    from shelfwise.session import scale_settings

    assert int(scale_settings(100 * 1024, 8000)["spark.sql.shuffle.partitions"]) == 25600
    assert int(scale_settings(100, 1000)["spark.sql.shuffle.partitions"]) == 2000
    assert scale_settings(0.001, 8)["spark.sql.shuffle.partitions"] == "16"


def test_cli_ask_sql(spark, workdir, capsys):
    from shelfwise.__main__ import main

    g = gold_tables(spark, SF_SMALL)
    for name in GOLD_TABLES:
        io.write_table(g[name], workdir, name)
    assert main(["ask", workdir, "--sql"]) == 0
    out = capsys.readouterr().out
    assert "== q10_city_revenue" in out and "total_revenue" in out


def test_resume_from_gold(spark, workdir):
    """A run that failed after silver resumes at gold, reading the written silver tables."""
    from shelfwise.operators.silver import CLEANERS

    paths = layers.LayerPaths(workdir)
    bronze = fixtures.bronze(spark, SF_SMALL)
    for name in CLEANERS:
        io.write_table(CLEANERS[name](bronze[name]), paths.silver, name,
                       layers.PARTITION_COLUMNS.get(name))
    summary = layers.run_layers(spark, "/nonexistent-bronze", workdir, start_at="gold")
    assert summary.silver_rows == [] and len(summary.gate_rules) == 35
    expected = gold_tables(spark, SF_SMALL)
    for name in GOLD_TABLES:
        assert _same(expected[name], io.read_layer(spark, paths.gold, name)), name
    summary = layers.run_layers(spark, "/nonexistent-bronze", workdir, start_at="gate")
    assert len(summary.gate_rules) == 35
