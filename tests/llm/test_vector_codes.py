"""Vector codes against SQL and plain Python integers; bounds against distances to every entry."""

import hashlib
import math
from collections import Counter
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from shelfwise.llm import vector_codes as vc
from tests.conftest import SF_SMALL
from tests.llm.cases import by_sql, same_rows


def by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    """(id, label, vector) rows -> (id, code, error, label_error, digest) rows, with Python integers."""
    kept = [(i, label, v) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[2]))
    if not kept:
        return []
    width = -(-max(len(v) for *_, v in kept) // parts)
    whole = [[math.floor(Fraction(x) * scale) for x in v] + [0] * (parts * width - len(v)) for *_, v in kept]
    cut = [[v[p * width:(p + 1) * width] for p in range(parts)] for v in whole]
    books = [[v[p] for v in cut[:entries]] for p in range(parts)]
    d = lambda a, b: sum((x - y)**2 for x, y in zip(a, b, strict=True))
    nearest = lambda v, book: min(range(len(book)), key=lambda k: (d(v, book[k]), k))
    for _ in range(rounds):
        for p in range(parts):
            codes = [nearest(v[p], books[p]) for v in cut]
            for k in range(len(books[p])):
                own = [v[p] for v, c in zip(cut, codes, strict=True) if c == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, total = [], Counter()
    for (i, label, _), v in zip(kept, cut, strict=True):
        codes = [nearest(v[p], books[p]) for p in range(parts)]
        error = sum(d(v[p], books[p][c]) for p, c in enumerate(codes))
        out.append((i, label, "".join(f"{c:02x}" for c in codes), error))
        total[label] += error
    most = 2**63 - 1
    return [(i, code, min(error, most), min(total[label], most), digest) for i, label, code, error in out]


def check(df, rows, **how):
    got = [tuple(r) for r in vc.vector_codes(df, **how).collect()]
    assert sorted(got, key=repr) == sorted(by_hand(rows, **how), key=repr)
    return got


def test_given_tables(spark):
    same_rows(vc.op11_vector_codes(spark, SF_SMALL), by_sql(vc.OP11_SQL, embeddings=pd.read_parquet(f"{SF_SMALL}/embeddings.parquet")))


def test_odd_rows(spark):
    inf, nan = float("inf"), float("nan")
    g = np.random.default_rng(3)
    rows = [(i, i % 3 or None, g.normal(size=16).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, 1, None), (101, 1, [1.0, None]), (102, None, [inf] * 16), (103, 2, [nan] * 16), (104, 2, []), (105, 2, [0.5, -0.25]),
             (106, 1, [0.0] * 16), (5, 7, rows[5][2]), (5, 7, rows[5][2]), (None, None, rows[9][2]), (None, 3, [1.0] * 16), (107, 1, [-0.0001] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr(
        "*", "'c' AS code", "0 AS error", "'x' AS state", "1 AS id", "2 AS v")
    got = check(df, rows)
    assert len(got) == 68


@pytest.mark.parametrize("size", [1e4, 1e9, 3e18, 3e38])
def test_large_components(spark, size):
    g = np.random.default_rng(4)
    rows = [(i, i % 2, (g.normal(size=16) * (size if i % 5 == 0 else 1)).clip(-3.4e38, 3.4e38).astype(np.float32).tolist()) for i in range(50)]
    check(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), rows)


def test_doubles_up_to_the_largest(spark):
    rows = [(i, 0, [x, -x, 0.1 * i, 1.0]) for i, x in enumerate([1.7e308, 1e300, 2.0**53 + 2, 0.3, -0.3, 1e-300] * 4)]
    check(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), rows, parts=2, entries=3)


def test_ties_fewer_rows_and_copies(spark):
    same = [(i, None, [1.0, 2.0, 3.0, 4.0]) for i in range(40)]
    frame = lambda rows: spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    assert {r[1] for r in check(frame(same), same, parts=4)} == {"00000000"}
    grid = [(i, i, [float(i % 4), float(i // 4 % 3), float(i % 2), 0.0]) for i in range(48)]
    check(frame(grid), grid, parts=2, entries=5, scale=1)
    check(frame(grid[:3]), grid[:3])
    check(frame(grid[:1]), grid[:1])
    none = frame([(1, 1, None)])
    out = vc.vector_codes(none)
    assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and out.collect() == []
    assert vc.vector_codes(none.limit(0)).collect() == []
    empty = [(1, 1, []), (2, 1, [])]
    check(frame(empty), empty)


def test_widths_that_parts_do_not_divide(spark):
    g = np.random.default_rng(8)
    rows = [(i, 1, g.normal(size=int(n)).tolist()) for i, n in enumerate(g.integers(0, 11, size=40))]
    check(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"), rows, entries=6)


def test_strings_as_ids_and_labels(spark):
    g = np.random.default_rng(9)
    rows = [(f"v{i:02d}", "abc"[i % 3], g.normal(size=8).tolist()) for i in range(30)]
    check(spark.createDataFrame(rows, "vec_id string, label string, embedding array<double>"), rows, entries=4, parts=4)


@pytest.mark.parametrize("seed", range(6))
def test_bounds_hold_and_spare_distances(seed):
    """Over many rounds of moving entries: the entry is the nearest, every bound is one, and few rows need them all."""
    g = np.random.default_rng(seed)
    entries = g.integers(-50, 50, size=(16, 3)).astype(float)
    x = (entries[g.integers(0, 16, 2000)] + g.integers(-9, 9, size=(2000, 3))).astype(float)
    bounds, tracked, needs = vc.Bounds.of_all(x, entries, 4), 4, []
    for _ in range(8):
        new = entries + g.integers(-3, 4, size=entries.shape)
        moves = np.sqrt(((new - entries)**2).sum(axis=1)) * (1 + 1e-9)
        now = int(g.integers(1, 9))
        bounds, need = bounds.moved(x, new, moves, now)
        needs.append((need > tracked).mean())
        entries, tracked = new, now
        d = ((x[:, None] - entries[None])**2).sum(axis=2)
        assert (bounds.code == d.argmin(axis=1)).all()
        root = np.sqrt(d)
        rows = np.arange(len(x))
        assert (bounds.upper >= root[rows, bounds.code] - 1e-6).all()
        seen = np.zeros(d.shape, dtype=bool)
        seen[rows, bounds.code] = True
        for z in range(tracked):
            known = bounds.near[:, z] != vc._NONE
            at = rows[known], bounds.near[known, z]
            assert (bounds.lower[known, z] <= root[at] + 1e-6).all()
            seen[at] = True
        assert (bounds.outer[:, None] <= np.where(seen, np.inf, root) + 1e-6).all()
    assert np.mean(needs) < 0.5


def test_adapting_the_number_of_bounds():
    assert vc.adapted(Counter({0: 1000}), 4, 16) == 1
    assert vc.adapted(Counter({0: 100, 3: 900}), 4, 16) == 3
    assert vc.adapted(Counter({5: 900, 0: 100}), 4, 16) in (1, 8)
    assert vc.adapted(Counter({4: 500, 5: 500}), 4, 16) == 8
    assert vc.adapted(Counter(), 4, 16) == 4 and vc.adapted(Counter({1: 5}), 1, 2) == 1


def test_no_folder_is_left(spark):
    from shelfwise.session import ensure_checkpoint_dir

    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ensure_checkpoint_dir(spark))
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    g = np.random.default_rng(1)
    vc.vector_codes(spark.createDataFrame([(i, 1, g.normal(size=8).tolist()) for i in range(40)],
                                          "vec_id long, label int, embedding array<double>")).collect()
    assert not [p for p in files.listStatus(where) if p.getPath().getName().startswith("passes-")]
