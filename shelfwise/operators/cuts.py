"""Exact cuts of an order without sorting or numbering its rows.

Where is the row of rank r? Only the keys of a few ranks are wanted, so they
are selected by histograms that get finer: rows are counted by the leading
bits of their first key, the bucket with the wanted rank is the one to go on
in, its rows are counted by further bits, and so on over all bits of one or
two keys. A level is one aggregate with map-side combine over the rows of the
buckets in question, and a window over at most 2^22 counts a cut; it moves
counts, never rows. All levels are one lazy plan, in which the exchange that
made the rows is read again, not made again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits that are left out at each level of a 64-bit key.
SHIFTS = (44, 22, 0)
_KEYS = ("_n1", "_k1", "_n2", "_k2")


def whole_part(a: Column, b: Column) -> Column:
    """The integer quotient of two integers."""
    return F.call_function("div", a, b)


def _ascending(column: str, descending: bool) -> Column:
    """A long that ascends in the wanted order; 0 for NULL."""
    value = F.col(column).cast("long")
    return F.coalesce(F.bitwise_not(value) if descending else value, F.lit(0).cast("long"))


def keyed(df: DataFrame, order: list[tuple[str, bool]]) -> DataFrame:
    """``df`` with key columns for one or two integer columns (name, descending); NULLs last."""
    keys = {}
    for k, (column, descending) in enumerate(order, 1):
        keys |= {f"_n{k}": F.col(column).isNull().cast("int"), f"_k{k}": _ascending(column, descending)}
    return df.withColumns(keys)


def key_of(rows: DataFrame) -> Column:
    """The key of a :func:`keyed` row; keys compare as the rows are ordered."""
    return F.struct(*[c for c in _KEYS if c in rows.columns])


_LEVEL = """
SELECT cut, _need - (_upto - _rows) AS _need, {known} FROM (
  SELECT *, SUM(_rows) OVER (PARTITION BY cut ORDER BY {new} ROWS UNBOUNDED PRECEDING) AS _upto FROM ({counts}))
WHERE _upto >= _need AND _upto - _rows < _need"""


def cut_keys(rows: DataFrame, cuts: int, rank: Callable[[Column, Column], Column]) -> DataFrame:
    """(cut, key, taken): for each cut from 1 the key of the row at a rank, from :func:`keyed` rows.

    ``rank`` gives the rank of a cut, from 1, from its number and the number
    of rows; a cut whose rank is 0 or beyond the rows has no key. Of rows
    with that key, ``taken`` are not beyond the rank.
    """
    spark = rows.sparkSession
    total = rows.agg(F.count(F.lit(1))).scalar()
    names = [c for c in _KEYS if c in rows.columns]
    prefixes = [F.shiftright(k, s).alias(f"{k}_{s}") for k in names if k.startswith("_k") for s in SHIFTS]
    inside = rows.select(*[n for n in names if n.startswith("_n")], *prefixes)
    known: list[str] = []
    state = None
    for null, key in zip(names[::2], names[1::2], strict=True):
        for shift in SHIFTS:
            bits = f"{key}_{shift}"
            new = [bits] if shift != SHIFTS[0] else [null, bits]
            previous = [k for k in known if not k.startswith(key)]  # finer bits say what coarser ones did
            columns = [*previous, *([null] if null not in previous else []), bits]
            if state is None:
                counts = inside.groupBy(*new).agg(F.count(F.lit(1)).alias("_rows")).withColumn(
                    "cut", F.explode(F.sequence(F.lit(1), F.lit(cuts))))
                counts = counts.withColumn("_need", rank(F.col("cut"), total).cast("long"))
                state = spark.sql(_LEVEL.format(known=", ".join(columns), new=", ".join(new), counts="SELECT * FROM {counts}"), counts=counts)
            else:
                # the rows of the buckets in question, counted by further bits
                by = ", ".join(["cut", "_need", *dict.fromkeys([*known, *new])])
                counts = f"SELECT {by}, COUNT(1) AS _rows FROM {{inside}} JOIN {{state}} USING ({', '.join(known)}) GROUP BY {by}"
                state = spark.sql(_LEVEL.format(known=", ".join(columns), new=", ".join(new), counts=counts), inside=inside, state=state)
            known = columns
    full = F.struct(*[F.col(f"{n}_{SHIFTS[-1]}").alias(n) if n.startswith("_k") else F.col(n) for n in names])
    return state.select("cut", full.alias("key"), F.col("_need").alias("taken"))


def segment(rows: DataFrame, cuts: DataFrame, n: int) -> Column:
    """Which segment, from 1, a keyed row is in: one more than those of the ``n`` cuts that come before it.

    Keys must be distinct. They reach the rows as the value of one scalar subquery.
    """
    names = [f"key{k}" for k in range(1, n + 1)]
    keys = cuts.agg(*[F.max(F.when(F.col("cut") == k, F.col("key"))).alias(name) for k, name in enumerate(names, 1)])
    found = keys.select(F.struct(*names).alias("keys")).scalar()
    return sum((F.when(found[name] < key_of(rows), 1).otherwise(0) for name in names), F.lit(1))
