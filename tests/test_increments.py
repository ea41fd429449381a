"""New rows, snapshots delivered again, and reports from staging: equal to a run over everything."""

import datetime
import glob
import os
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import extensions as ext
from shelfwise.operators import gold, profile, repeats, state
from shelfwise.plans import increments, layers
from shelfwise.plans.registry import queries
from shelfwise.sources import fixtures, io
from shelfwise.sources.schemas import BRONZE, GOLD_TABLES
from shelfwise.sources.versions import Layer
from tests.conftest import SF_SMALL

DAY = datetime.date(2024, 1, 1)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def random_bronze(rng, orders, first_order=1, days=range(10), items_of=None):
    """Rows of the five tables, with NULLs, orphans, copies and dirt."""
    maybe = lambda x, p=0.1: None if rng.random() < p else x
    ids = range(first_order, first_order + orders)
    money = lambda: Decimal(rng.randint(-50, 5000)).scaleb(-2)
    out = {
        "customers": [(i, f"c{i}", maybe(f"city{i % 3}"), maybe(f"area{i % 4}"), None) for i in range(1, 15)] * 2,
        "products": [(i, f"p{i}", f"cat{i % 3}", "b", maybe(money())) for i in range(1, 12)],
        "orders": [(i, maybe(rng.randint(1, 16)), maybe(DAY + datetime.timedelta(rng.choice(days))), "10:00:00", maybe(float(rng.randint(1, 4))),
                    maybe(rng.randint(-60, 90)), rng.choice(["Delivered", "Cancelled", "Returned", None])) for i in ids],
        "order_items": [(k, rng.choice(items_of or [*ids, 10**6]), maybe(rng.randint(1, 13)), maybe(rng.randint(0, 9)), maybe(money()))
                        for k in range(3 * orders)],
        "inventory": [(maybe(DAY + datetime.timedelta(d), 0.03), rng.randint(1, 3), maybe(rng.randint(1, 12), 0.05), maybe(rng.randint(-3, 30)))
                      for d in days for _ in range(12)],
    }
    return out


def write_bronze(spark, path, tables):
    for name, rows in tables.items():
        io.write_bronze_csv(spark.createDataFrame(rows, BRONZE[name]), path, name)


def joined(*parts):
    return {name: [r for p in parts for r in p.get(name, [])] if name in increments.FACTS else parts[0][name] for name in BRONZE}


@pytest.fixture()
def no_gate(monkeypatch):
    """Random tables break the quality rules."""
    monkeypatch.setattr(layers, "validate_gold", lambda *a, **k: [])


def test_base_and_increments_equal_everything(spark, workdir, no_gate):
    rng = random.Random(0)
    base = random_bronze(rng, 40)
    first = {k: v for k, v in random_bronze(rng, 30, 41, range(8, 14)).items() if k in increments.FACTS}
    late = {"order_items": [(k, o, 1 + k % 11, 2, Decimal("3.25")) for k, o in enumerate([1, 1, 2, 5, 41, 60, 10**6 + 1, 77])]}
    second = {"orders": random_bronze(rng, 5, 71, range(14, 15))["orders"], "order_items": late["order_items"]}
    for name, tables in (("base", base), ("first", first), ("second", second), ("all", joined(base, first, second))):
        write_bronze(spark, f"{workdir}/{name}", tables)
    layers.run_layers(spark, f"{workdir}/base", f"{workdir}/out")
    layers.run_layers(spark, f"{workdir}/all", f"{workdir}/whole")
    for name in ("first", "second"):
        increments.add_increment(spark, f"{workdir}/{name}", f"{workdir}/out")
    got, want = layers.LayerPaths(f"{workdir}/out"), layers.LayerPaths(f"{workdir}/whole")
    for name in BRONZE:
        assert same(io.read_layer(spark, want.silver, name), io.read_layer(spark, got.silver, name)), name
    for name in GOLD_TABLES:
        assert same(io.read_layer(spark, want.gold, name), io.read_layer(spark, got.gold, name)), name
    whole = {name: io.read_layer(spark, want.silver, name) for name in BRONZE}
    for name, df in state.state_of(whole).items():
        assert same(df, io.read_layer(spark, got.state, name)), name
    written = layers.extension_tables(spark, f"{workdir}/out")
    assert same(ext.latest_per_pair(whole["inventory"]), written["x06_latest_snapshot"])
    assert same(ext.missing_snapshots(whole["inventory"]), written["x12_missing_snapshots"])
    assert "inventory.parquet" not in " ".join(written["x12_missing_snapshots"].inputFiles())
    assert layers.staged_metrics(spark, got.staged) == layers.staged_metrics(spark, want.staged)


def test_an_increment_reads_its_own_rows_only(spark, workdir, no_gate):
    rng = random.Random(5)
    base = random_bronze(rng, 20)
    write_bronze(spark, f"{workdir}/base", base)
    more = random_bronze(rng, 10, 21, range(10, 12), items_of=range(21, 31))
    write_bronze(spark, f"{workdir}/more", {k: more[k] for k in increments.FACTS})
    out = f"{workdir}/out"
    layers.run_layers(spark, f"{workdir}/base", out)
    increments.build_state(spark, out)
    paths = layers.LayerPaths(out)
    facts = {f: os.stat(f).st_atime_ns for n in increments.FACTS for f in glob.glob(f"{paths.silver}/{n}.parquet/**/part-*", recursive=True)}
    for f in facts:  # a file that is opened fails the run
        os.rename(f, f"{f}.away")
        open(f, "wb").close()
    latest = [f for f in facts if "inventory" in f]
    increments.add_increment(spark, f"{workdir}/more", out)
    assert latest and io.read_layer(spark, paths.gold, "daily_orders").count() > 0
    for f in facts:
        os.replace(f"{f}.away", f)
    whole = {name: io.read_layer(spark, paths.silver, name) for name in BRONZE}
    for name, df in state.state_of(whole).items():
        assert same(df, io.read_layer(spark, paths.state, name)), name


def test_a_run_that_died_before_its_state(spark, workdir, no_gate, monkeypatch):
    rng = random.Random(6)
    write_bronze(spark, f"{workdir}/base", random_bronze(rng, 20))
    for k in (1, 2):
        more = random_bronze(rng, 6, 20 * k + 1, range(10 + k, 11 + k))
        write_bronze(spark, f"{workdir}/more{k}", {n: more[n] for n in increments.FACTS})
    out = f"{workdir}/out"
    layers.run_layers(spark, f"{workdir}/base", out)
    with monkeypatch.context() as m:
        m.setattr(state, "merged", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increments.add_increment(spark, f"{workdir}/more1", out)
    increments.add_increment(spark, f"{workdir}/more2", out)
    paths = layers.LayerPaths(out)
    whole = {name: io.read_layer(spark, paths.silver, name) for name in BRONZE}
    for name, df in state.state_of(whole).items():
        assert same(df, io.read_layer(spark, paths.state, name)), name


def test_one_date_is_delivered_again(spark, workdir, no_gate):
    rng = random.Random(7)
    base = random_bronze(rng, 20)
    write_bronze(spark, f"{workdir}/base", base)
    out = f"{workdir}/out"
    layers.run_layers(spark, f"{workdir}/base", out)
    increments.build_state(spark, out)
    paths = layers.LayerPaths(out)
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{paths.silver}/**/part-*", recursive=True)}
    last, fourth = DAY + datetime.timedelta(9), DAY + datetime.timedelta(3)
    again = [(last, 1, 2, 50), (last, 2, 3, -4), (DAY, 9, 9, 9)]  # the first day isn't asked for, the fourth is gone
    write_bronze(spark, f"{workdir}/again", {"inventory": again})
    summary = increments.rerun_dates(spark, f"{workdir}/again", out, [str(last), str(fourth)])
    assert [(r.table, r.before, r.after) for r in summary.silver_rows] == [("inventory", 2, 2)]
    after = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{paths.silver}/**/part-*", recursive=True)}
    assert {f: t for f, t in after.items() if f in before} == before
    assert {f.split("/")[-2] for f in set(after) - set(before)} == {f"inventory_date={last}"}
    base["inventory"] = [r for r in base["inventory"] if r[0] not in (last, fourth)] + again[:2]
    write_bronze(spark, f"{workdir}/all", base)
    layers.run_layers(spark, f"{workdir}/all", f"{workdir}/whole")
    want = layers.LayerPaths(f"{workdir}/whole")
    assert same(io.read_layer(spark, want.silver, "inventory"), io.read_layer(spark, paths.silver, "inventory"))
    for name in GOLD_TABLES:
        assert same(io.read_layer(spark, want.gold, name), io.read_layer(spark, paths.gold, name)), name
    assert same(state.pair_stock(io.read_layer(spark, want.silver, "inventory")), io.read_layer(spark, paths.state, "pair_stock"))
    with pytest.raises(ValueError, match="stage again"):
        layers.run_layers(spark, f"{workdir}/base", out, start_at="silver")
    layers.run_layers(spark, f"{workdir}/base", out)
    assert "replaced" not in Layer(spark, paths.silver).manifest().notes


def test_latest_date_comes_from_the_partitions(spark, workdir):
    inventory = spark.sql("SELECT CAST(date_add(DATE'2024-01-01', CAST(id % 4 AS INT)) AS DATE) AS inventory_date, 1 AS store_id, id AS product_id, "
                          "id AS stock_quantity FROM range(40) UNION ALL SELECT NULL, 1, 1L, 1000L")
    io.write_table(inventory, workdir, "inventory", "inventory_date")
    assert layers.latest_date(spark, workdir) == "2024-01-04"
    products = spark.sql("SELECT id AS product_id, 'n' AS product_name, 'c' AS category, 'b' AS brand FROM range(40)")
    sales = spark.sql("SELECT id AS product_id, 2L AS units_sold, CAST(1 AS DECIMAL(38,2)) AS revenue FROM range(40)")
    written = io.read_layer(spark, workdir, "inventory")
    health = gold.inventory_health(written, sales, products, latest="2024-01-04")
    assert same(gold.inventory_health(inventory, sales, products), health)
    plan = health._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Subquery" not in plan and "(inventory_date" in plan.split("PartitionFilters:")[1][:200]
    io.write_table(inventory.filter("inventory_date IS NULL"), workdir, "inventory", "inventory_date")
    assert layers.latest_date(spark, workdir) is None
    assert gold.inventory_health(io.read_layer(spark, workdir, "inventory"), sales, products).count() == 0
    io.write_table(inventory.limit(0), workdir, "inventory", "inventory_date")
    assert layers.latest_date(spark, workdir) is None and io.read_layer(spark, workdir, "inventory").count() == 0


def test_reports_from_staging_equal_the_checks(spark, workdir):
    tables = {name: df.select(*[F.col(f.name).cast(f.dataType) for f in BRONZE[name] if f.name in df.columns],
                              *[F.lit(None).cast(f.dataType).alias(f.name) for f in BRONZE[name] if f.name not in df.columns])
              .select(*BRONZE[name].names) for name, df in fixtures.bronze_for_checks(spark, SF_SMALL).items()}
    for name, df in tables.items():
        io.write_bronze_csv(df, f"{workdir}/bronze", name)
    staged = layers.stage_bronze(spark, f"{workdir}/bronze", f"{workdir}/staged")
    metrics = layers.staged_metrics(spark, f"{workdir}/staged")
    known = profile.profile_bronze(staged, metrics)
    for name in ("check_row_counts", "check_nulls", "check_invalid"):
        assert known[name].inputFiles() == [] and "Scan parquet" not in known[name]._jdf.queryExecution().executedPlan().toString()
        assert known[name].dtypes == profile.CHECKS[name](staged).dtypes
        assert same(profile.CHECKS[name](staged), known[name]), name
    assert layers.malformed_lines(spark, f"{workdir}/staged").inputFiles() == []
    # and what is registered, but for the columns that only CSVs have
    only = {(r["table_name"], r["column_name"]) for r in known["check_nulls"].collect()}
    assert {(r["table_name"], r["column_name"]) for r in queries()["check_nulls"](spark, SF_SMALL).collect()} <= only
    assert same(queries()["check_row_counts"](spark, SF_SMALL), known["check_row_counts"])
    assert same(queries()["check_invalid"](spark, SF_SMALL), known["check_invalid"])


def test_orphans_meet_in_one_aggregate(spark):
    import itertools

    hot = [(k, 1, None, None, None, None, None) for k in range(2000)] + [(k, None, None, None, None, None, None) for k in range(500)]
    tables = {"orders": spark.createDataFrame(hot, BRONZE["orders"]), "customers": spark.createDataFrame([(2, "c", None, None, None)], BRONZE["customers"]),
              "products": spark.createDataFrame([(None, "p", None, None, None), (1, "q", None, None, None)], BRONZE["products"]),
              "order_items": spark.createDataFrame([(1, 5, 1, 1, None), (2, 9999, None, 1, None), (3, None, 7, 1, None)], BRONZE["order_items"]),
              "inventory": spark.createDataFrame([], BRONZE["inventory"])}
    got = {r["fk"]: r["n"] for r in profile.orphan_counts(tables).collect()}
    assert got == {"orders.customer_id": 2500, "order_items.order_id": 2, "order_items.product_id": 2, "inventory.product_id": 0}
    plan = profile.orphan_counts(tables)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert list(itertools.chain(got)) and dict(profile.orphan_counts(tables).dtypes) == {"fk": "string", "n": "bigint"}


@pytest.mark.parametrize("bits,cells", [(128, repeats.CELLS), (128, 1), (3, 4), (0, 4)])
def test_rows_whose_digests_collide(spark, monkeypatch, bits, cells):
    """Rows are told apart by their values, whatever their digests do and however full the set of them is."""
    monkeypatch.setattr(repeats, "CELLS", cells)
    rng = random.Random(9)
    rows = [(rng.randint(1, 4), rng.choice(["a", "", None, "ab"]), rng.choice([Decimal("1.00"), None])) for _ in range(120)] + [(77, "only", None)]
    df = spark.createDataFrame(rows, "k long, s string, d decimal(12,2)")
    want = sum(rows.count(r) - 1 for r in set(rows))
    tables = {"customers": df, "order_items": df.selectExpr("k AS order_id", "k AS product_id", "1L AS quantity", "d AS unit_price", "rand() AS x")}
    got = {r["table_name"]: r["n"] for r in profile.duplicate_counts(tables, bits).collect()}
    items = [(r[0], r[2]) for r in rows]
    assert got == {"customers": want, "order_items": sum(items.count(r) - 1 for r in set(items))}
    empty = {r["table_name"]: r["n"] for r in profile.duplicate_counts({"customers": df.limit(0)}, bits).collect()}
    assert empty == {"customers": 0}


def test_rows_that_do_not_repeat_stay_where_they_are(spark):
    """What is shuffled of a row that doesn't repeat is its digest: 16 bytes and a count."""
    df = spark.range(20_000).selectExpr("id % 19990 AS k", "repeat(string(id % 19990), 40) AS s")
    plan = profile.duplicate_counts({"customers": df})._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [_d0" not in plan and plan.count("Exchange hashpartitioning(k") == 1  # behind the filter
    assert repeats.repeated_rows(df, ["k", "s"]).count() == 10
    left = df.filter(repeats.may_be_in(repeats.set_of(df.select(F.xxhash64("k").alias("h")).filter("h = 0"), "h"), F.xxhash64("k")))
    assert left.count() == 0


def test_digests_of_rows_with_nulls_differ(spark):
    df = spark.createDataFrame([(None, 1), (1, None), (1, 1), (None, None)], "a long, b long")
    assert df.select(*repeats.row_digest(["a", "b"])).distinct().count() == 4


def test_conflicting_keys_of_hot_and_null_ids(spark):
    customers = spark.createDataFrame([(1, "a", None), (1, "a", "Unknown"), (2, "b", "x"), (2, "c", "x"), (3, "d", "x"), (None, "e", "x"), (None, "f", "x")],
                                      "customer_id long, customer_name string, area string")
    products = customers.selectExpr("customer_id AS product_id", "area")
    got = {r["table_name"]: tuple(r)[1:] for r in ext.duplicate_keys(customers, products).collect()}
    assert got == {"customers": (4, 3, 2), "products": (4, 3, 1)}
    none = {r["table_name"]: tuple(r)[1:] for r in ext.duplicate_keys(customers.limit(0), products.limit(0)).collect()}
    assert none == {"customers": (0, 0, 0), "products": (0, 0, 0)}
