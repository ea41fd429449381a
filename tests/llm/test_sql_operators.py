"""The operators that SQL can express, against that SQL: on given tables and on the odd cases."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelfwise.llm import decontamination, near_dedup, substring_dedup, top_k
from shelfwise.llm.queries import ORACLE_SQL, QUERIES
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, by_sql, frame, same_rows, text

BENCH = [(1, text(25, 45)), (2, "short text"), (3, None), (4, ""), (5, text(300, 312)), (6, text(390, 396)), (6, "never seen at all"),
         (None, text(210, 222))]
UNIQUE = [r for n, r in enumerate(DOCS) if r not in DOCS[:n]]
UNIQUE_IDS = [r for r in UNIQUE if r[0] is not None]


def tables(*names):
    return {n: pd.read_parquet(f"{SF_SMALL}/{n}.parquet") for n in names}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_given_tables(spark, name):
    same_rows(QUERIES[name](spark, SF_SMALL), by_sql(ORACLE_SQL[name], **tables("documents", "benchmark", "embeddings", "labels")))


def documents(rows):
    return pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})


def test_repeated_passages_on_odd_rows(spark):
    out = substring_dedup.remove_repeated_passages(frame(spark, UNIQUE))
    assert out.columns == ["doc_id", "text", "lang", "source", "score", "n_words", "n_removed", "kept_text"]
    got = {r["doc_id"]: r for r in out.collect()}
    want = by_sql(substring_dedup.OP3_SQL, documents=documents(UNIQUE)).df().set_index("doc_id")
    for i, _ in UNIQUE:
        if i is not None:
            assert (got[i]["n_words"], got[i]["n_removed"]) == (want.loc[i, "n_words"], want.loc[i, "n_removed"])
    assert got[12]["n_removed"] == 80 and got[14]["n_words"] == 3039 and got[0]["kept_text"] == ""


def test_repeated_rows_repeat_their_passages(spark):
    out = substring_dedup.remove_repeated_passages(spark.createDataFrame([(1, text(0, 40))] * 2, "doc_id long, text string"))
    assert [(r["n_words"], r["n_removed"]) for r in out.collect()] == [(40, 40)] * 2


@pytest.mark.parametrize("limit", [10_000, 0])
def test_contamination_on_odd_rows(spark, limit):
    """With the set of hashes, and beyond its size; repeated rows give a row each."""
    bench = spark.createDataFrame(BENCH, "item_id long, text string").selectExpr("*", "1 AS gram", "2 AS hash")
    rows = [r for r in DOCS if r[0] is not None]
    found = decontamination.contamination(frame(spark, rows), bench, max_set=limit)
    got = sorted((r["doc_id"], r["n_words"], len(r["hits"]), len(r["items"])) for r in found.collect())
    # SQL counts the item without an id, which hits 10, as one; it sees repeated rows as one document
    want = by_sql(decontamination.OP2_SQL, documents=documents(UNIQUE_IDS), benchmark=documents(BENCH).rename(columns={"doc_id": "item_id"})).df()
    want = {r.doc_id: (r.n_words, r.n_hit, r.n_items - (r.doc_id == 10)) for r in want.itertuples()}
    assert got == sorted((i, *want[i]) for i, _ in rows)


def test_one_window_of_many_items(spark):
    docs = spark.createDataFrame([(1, text(0, 40)), (1, text(0, 40)), (2, text(50, 90))], "doc_id long, text string")
    bench = spark.range(500).selectExpr("id AS item_id").withColumn("text", F.lit(text(10, 22)))
    got = decontamination.contamination(docs, bench).collect()
    assert sorted((r["doc_id"], len(r["hits"]), len(r["items"])) for r in got) == [(1, 12, 500), (1, 12, 500), (2, 0, 0)]


def test_decontaminated_texts(spark):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    docs = frame(spark)
    out = decontamination.decontaminate(docs, bench)
    assert out.columns == docs.columns
    rows = {r["doc_id"]: r["text"] for r in out.collect()}
    before = dict(DOCS)
    assert 4 not in rows and 5 not in rows  # all of them is benchmark
    assert rows[0] is None and rows[1] == "" and rows[2] == before[2] and rows[15] == before[15]
    assert rows[6] == text(0, 25) + " " + text(45, 100)
    assert out.where("doc_id = 7").count() == 2


def test_near_duplicates_on_odd_rows(spark):
    got = {r["doc_id"]: r for r in near_dedup.near_duplicates(frame(spark, UNIQUE)).collect()}
    want = by_sql(near_dedup.OP6_SQL, documents=documents([r for r in UNIQUE if r[0] is not None])).df().set_index("doc_id")
    for i in want.index:
        assert (got[i]["n_shingles"], got[i]["component_id"], got[i]["kept"]) == tuple(
            want.loc[i, ["n_shingles", "component_id", "kept"]])
    assert got[None]["component_id"] is None and got[None]["kept"]


def test_near_duplicate_rows_that_stay(spark):
    docs = frame(spark)
    out = near_dedup.drop_near_duplicates(docs)
    assert out.columns == docs.columns
    assert sorted(r["doc_id"] for r in out.collect() if r["doc_id"] is not None) == [0, 1, 2, 3, 4, 6, 9, 10, 11, 12, 13, 14, 15]
    assert out.where("doc_id is null").count() == 1


def test_top_k_on_odd_rows(spark):
    inf = float("inf")
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.0]), (1, [0.5, -0.25]), (2, None), (3, [1.0, None]), (4, [inf, 0.0]), (5, [float("nan"), 1.0]),
            (6, [0.5, -0.25]), (7, [-3.0, 1e-9]), (8, [0.0, 0.0]), (None, [9.0, 9.0]), (0, [1.0, 2.0])]
    df = spark.createDataFrame([(i, v, 3, 0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score int")
    out = top_k.top_k(spark, df, (df.vec_id % 100 == 0), k=3).collect()
    import math
    valid = {i: [math.floor(1024 * x) for x in v] for i, v in rows
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    want = []
    for q in (0, 100):
        scored = sorted(((-sum(a * b for a, b in zip(valid[q], v)), i) for i, v in valid.items() if i != q))[:3]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)]
    assert sorted(tuple(r) for r in out) == sorted(want)
    none = df.where("vec_id = 2")
    assert top_k.top_k(spark, none, none.vec_id % 100 == 0).collect() == []
    alone = df.where("vec_id = 100")
    assert top_k.top_k(spark, alone, alone.vec_id % 100 == 0).collect() == []


def test_top_k_prunes_without_loss_over_many_blocks(spark, monkeypatch):
    import numpy as np
    monkeypatch.setattr(top_k, "BLOCK", 40)
    monkeypatch.setattr(top_k, "QUERY_BLOCK", 2)
    g = np.random.default_rng(5)
    v = g.normal(size=(600, 24)) * np.exp(g.normal(size=(600, 1))) * np.linspace(2, 0.1, 24)
    v[300:420] = v[0]  # one vector very often
    table = pd.DataFrame({"vec_id": range(600), "embedding": [x.astype(np.float32).tolist() for x in v]})
    df = spark.createDataFrame(table, "vec_id long, embedding array<float>")
    out = top_k.top_k(spark, df, df.vec_id % 100 == 0).withColumnRenamed("id", "vec_id")
    same_rows(out, by_sql(top_k.OP7_SQL, embeddings=table))


@pytest.mark.parametrize("size", [5e3, 3e6, 4e8, 1e30, 1e200])
@pytest.mark.parametrize("width", [3, 2500])
def test_top_k_of_large_components(spark, monkeypatch, size, width):
    """Whole numbers of any size, against Python's own; scores beyond the longs are cut off there."""
    import math

    import numpy as np

    monkeypatch.setattr(top_k, "BLOCK", 30)
    g = np.random.default_rng(int(math.log10(size)))
    v = g.normal(size=(80 if width < 9 else 40, width)) * np.where(np.arange(80 if width < 9 else 40) % 4 == 0, size, 1)[:, None]
    table = [(i, x.tolist()) for i, x in enumerate(v)]
    df = spark.createDataFrame(table, "vec_id long, embedding array<double>")
    whole = {i: [int(x) * 1024 if abs(x) > 2**53 else math.floor(1024 * x) for x in row] for i, row in table}
    want = []
    for q in range(0, len(v), 20):
        cut = lambda s: max(-(2**63), min(2**63 - 1, s))
        best = sorted((-cut(sum(a * b for a, b in zip(whole[q], row))), i) for i, row in whole.items() if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    got = top_k.top_k(spark, df, df.vec_id % 20 == 0, k=5).collect()
    assert sorted(map(tuple, got)) == sorted(want)


def test_empty_tables(spark):
    docs = frame(spark).limit(0)
    bench = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.remove_repeated_passages(docs).collect() == []
    assert decontamination.contamination(docs, bench).collect() == []
    assert decontamination.decontaminate(frame(spark), bench).count() == len(DOCS)
    assert near_dedup.near_duplicates(docs).collect() == []
    assert near_dedup.drop_near_duplicates(docs).collect() == []


def test_near_duplicates_without_or_with_one_id(spark):
    one, near, other = text(0, 100), text(0, 97) + " other end here", text(200, 300)
    grouped = near_dedup.near_duplicates(frame(spark, [(1, one), (None, near), (2, other)])).collect()
    assert {r["doc_id"]: r["component_id"] for r in grouped} == {1: 1, None: 1, 2: 2}
    for ids in ((None, None), (5, 5), (None, 1), (1, 2)):
        left = near_dedup.drop_near_duplicates(frame(spark, [(ids[0], one), (ids[1], near), (7, other), (8, "")])).collect()
        assert len(left) == 3 and {r["doc_id"] for r in left} >= {7, 8}
        assert sum(r["doc_id"] == min((i for i in ids if i is not None), default=None) for r in left) == 1
