"""Global row numbers and tiles without a single-partition window.

``row_number() over (order by ...)`` with no partition key moves the whole
input into one task. Here the input is range-partitioned on the sort key
(sampled bounds, so even a tie on the leading column spreads over several
partitions through the tie-break columns), sorted within partitions, and
numbered by ``monotonically_increasing_id`` (partition index in the upper
31 bits, position in the lower 33). The numbered rows are checkpointed to
the shared checkpoint directory so both passes below see one
materialisation; per-partition counts give each partition its offset. How
the offsets (one row a partition) are joined is left to the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.session import ensure_checkpoint_dir

_LOW_BITS = 33


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    """Add a 1-based row number over ``order``, which must be a total order."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    staged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_rid", F.monotonically_increasing_id())
        .checkpoint(eager=True)
    )
    part = F.shiftright(F.col("_rid"), _LOW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    local = F.col("_rid") - F.shiftleft(F.col("_part"), _LOW_BITS)
    return (
        staged.withColumn("_part", part)
        .join(offsets, on="_part")
        .withColumn(name, local + F.col("_offset") + 1)
        .drop("_part", "_rid", "_offset")
    )


def ntile_of(row_number: Column | str, total: Column, buckets: int) -> Column:
    """SQL ``ntile(buckets)`` from a 1-based row number and the row count.

    The first ``total % buckets`` tiles hold one row more than the others.
    """
    rn = F.col(row_number) if isinstance(row_number, str) else row_number

    def div(a: Column, b: Column) -> Column:
        return F.call_function("div", a, b)

    size = div(total, F.lit(buckets))
    extra = total - size * buckets
    big = extra * (size + 1)
    in_big = div(rn - 1, size + 1) + 1
    in_small = extra + div(rn - 1 - big, F.greatest(size, F.lit(1))) + 1
    return F.when(rn <= big, in_big).otherwise(in_small).cast("int")
