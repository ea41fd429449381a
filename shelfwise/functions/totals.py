"""Shares of a total from grouped rows, in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_total(grouped: DataFrame, column: str, total: str = "_total") -> DataFrame:
    """``grouped`` with the sum of ``column`` over all its rows.

    For results with a handful of groups (statuses, hours, categories): they
    are gathered into one row and spread again, so what they were grouped
    from is neither read twice nor windowed as a whole.
    """
    gathered = grouped.agg(F.sum(column).alias(total), F.collect_list(F.struct(*grouped.columns)).alias("_rows"))
    return gathered.select(total, F.inline("_rows"))
