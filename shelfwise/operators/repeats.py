"""Which rows repeat, found without moving the rows that don't.

Rows are first counted by a digest, an aggregate with map-side combine whose
shuffle has 32 bytes a different row. The digests that occur more than once
become a set of bits of fixed size, the value of a scalar subquery, and rows
that can't be in it are dropped where the table is read. What is left, the
repeated rows and a few others, is then grouped by its values: a bit or a
digest that two different rows share costs a comparison, and nothing else.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Longs of the set, 512 KB. The more of its bits are set, the more rows that don't repeat are grouped, too:
#: one in 40 with 100,000 repeated digests, most with ten million.
CELLS = 1 << 16


def row_digest(columns: list[str], bits: int = 128) -> list[Column]:
    """Two 64-bit hashes of a row, under different seeds; NULLs are values of their own.

    ``bits`` under 128 keeps fewer of them, for tests of what a collision does.
    """
    # hashes skip NULLs: a list beside them says where they are
    nulls = F.concat(*[F.when(F.col(c).isNull(), F.lit("1")).otherwise(F.lit("0")) for c in columns])
    low = F.xxhash64(*[F.col(c) for c in columns], nulls)
    high = F.xxhash64(F.lit("second"), nulls, *[F.col(c) for c in reversed(columns)])
    if bits >= 128:
        return [low.alias("_d0"), high.alias("_d1")]
    return [F.pmod(low, F.lit(1 << bits)).alias("_d0"), F.lit(0).cast("long").alias("_d1")]


def _cell(h: Column) -> Column:
    return F.pmod(h, F.lit(CELLS)).cast("int")


def _bit(h: Column) -> Column:
    return F.shiftrightunsigned(h, 58).cast("int")


def set_of(hashes: DataFrame, h: str) -> Column:
    """A column of hashes as ``CELLS`` longs of bits: a scalar subquery."""
    one = F.lit(1).cast("long")
    cells = (hashes.groupBy(_cell(F.col(h)).cast("long").alias("id"))
             .agg(F.bit_or(F.call_function("shiftleft", one, _bit(F.col(h)))).alias("bits")))
    dense = hashes.sparkSession.range(CELLS).join(cells, "id", "left").select(
        F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")).alias("x"))
    return dense.agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["bits"]).alias("bits")).scalar()


def may_be_in(bits: Column, h: Column) -> Column:
    """Whether a hash may be one of a set; false only if it is not."""
    return F.getbit(F.get(bits, _cell(h)), _bit(h)) == 1


def repeated_rows(df: DataFrame, columns: list[str], bits: int = 128) -> DataFrame:
    """(``columns``, _c): groups of equal rows of ``columns`` with more than one row, and how many rows."""
    digest = row_digest(columns, bits)
    often = df.select(*digest).groupBy("_d0", "_d1").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    return (df.select(*columns).filter(may_be_in(set_of(often, "_d0"), digest[0]))
            .groupBy(*columns).agg(F.count(F.lit(1)).alias("_c")).filter(F.col("_c") > 1))
