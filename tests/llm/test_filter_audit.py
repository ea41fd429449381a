"""The filter audit against SQL and plain Python: every order applied to every document."""

import re
from itertools import permutations
from math import factorial

import pandas as pd
import pytest

from shelfwise.llm import filter_audit as audit
from tests.conftest import SF_SMALL
from tests.llm.cases import DOCS, by_sql, frame, same_rows, text

LABELS = [(4, 1, 0), (5, 0, 1), (6, 1, 1), (6, 0, 0), (7, None, 1), (99, 1, 1), (None, 1, 1), (20, 1, None), (8, 1, 0)]
MORE = [(20, text(0, 300)), (21, text(0, 300)), (21, text(0, 300)), (3, text(0, 300)), (22, "A b C #"), (None, text(0, 300)), (None, None),
        (23, "one two " * 150), (24, "price $5 " + text(0, 250)), (25, "")]


def by_hand(docs, labels, names="ABCDE"):
    """(part, order, step) -> counts, by applying each order to each document."""
    rows = []
    for i, part, t in docs:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        smaller = [j for j, _, u in docs if (u or "") == t and j is not None and i is not None and j < i]
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search(r"[#$%&*|]", t)), "E": bool(smaller)}
        good, toxic = ({q for j, q, x in labels if j == i}, {x for j, q, x in labels if j == i}) if i is not None else (set(), set())
        rows.append((part or "", fails, 1 in good, 1 in toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys(names, 0)
        for order in permutations(names):
            alive = own
            for step, f in enumerate(order, 1):
                gone = [r for r in alive if r[1][f]]
                left = [r for r in alive if not r[1][f]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(r[1][f] for r in own) - len(gone),
                    sum(r[1][f] and sum(r[1].values()) == 1 for r in own), sum(r[2] for r in gone), sum(r[3] for r in gone)]
                alive = left
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def got(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): [r[c] for c in names] for r in df.collect()}


def test_given_tables(spark):
    tables = {n: pd.read_parquet(f"{SF_SMALL}/{n}.parquet") for n in ("documents", "labels")}
    same_rows(audit.op13_filter_audit(spark, SF_SMALL), by_sql(audit.OP13_SQL, **tables))


def test_odd_rows_by_hand(spark):
    rows = DOCS + MORE
    docs = frame(spark, rows)
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS text", "7 AS n", "1 AS mask")
    parts = [(i, "en" if n % 2 else None, t) for n, (i, t) in enumerate(rows)]
    want = by_hand(parts, LABELS)
    assert got(audit.interactions(audit.failure_masks(docs, labels))) == want
    assert len(want) == 2 * 600 and {type(p) for p, _, _ in want} == {str}


def test_copies_of_one_text(spark):
    """Ten thousand copies: one is no copy, whatever their parts."""
    docs = spark.range(10_000).selectExpr("id AS doc_id", "'same' AS text", "concat('l', id % 3) AS lang")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    masks = {(r["part"], r["mask"]): r["n"] for r in audit.failure_masks(docs, labels).collect() if r["n"]}
    assert masks == {("l0", 1): 1, ("l0", 17): 3333, ("l1", 17): 3333, ("l2", 17): 3333}


def test_empty_tables(spark):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    assert audit.interactions(audit.failure_masks(frame(spark).limit(0), labels)).collect() == []
    docs = frame(spark, [(1, text(0, 300).lower())])
    assert {tuple(v) for v in got(audit.interactions(audit.failure_masks(docs, labels.limit(0)))).values()} == {(1, 0, 0, 0, 0, 0, 0)}


@pytest.mark.parametrize("n", [1, 2, 3, 5, 6])
def test_paths_through_an_edge(n):
    """Each edge's weight is the number of orders that take it."""
    reaching, leaving = audit.path_counts(n)
    taken = {}
    for order in permutations(range(n)):
        state = 0
        for f in order:
            taken[state, f] = taken.get((state, f), 0) + 1
            state |= 1 << f
    assert all(reaching[s] * leaving[s | 1 << f] == times for (s, f), times in taken.items())
    assert reaching[-1] == leaving[0] == factorial(n)


def test_other_filters(spark):
    """Any names and masks: Shapley values add up to the documents removed."""
    masks = spark.createDataFrame([("a", 0, 5, 1, 0), ("a", 3, 2, 0, 2), ("b", 7, 1, 1, 1)], "part string, mask int, n long, good long, toxic long")
    rows = audit.interactions(masks, "xyz").collect()
    assert len(rows) == 2 * 6 * 3
    for part, removed in (("a", 2), ("b", 1)):
        by_filter = {r["filter"]: r["shapley"] for r in rows if r["part"] == part}
        assert sum(by_filter.values()) == 6 * removed
        assert {r["kept"] for r in rows if r["part"] == part and r["step"] == 3} == {5 if part == "a" else 0}
