"""Money and flag expressions.

Money is decimal from the scan to the written gold tables and the answers
over them, so sums are exact and independent of partitioning at any size. It
becomes double only in the projection of a registered query's result.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Prices as cleaned, and sums of them.
MONEY, TOTAL_MONEY = "decimal(20,2)", "decimal(38,2)"


def line_total(quantity: str = "quantity", unit_price: str = "unit_price") -> Column:
    """quantity * unit_price, exact."""
    return F.col(quantity) * F.col(unit_price)


def published(money: Column | str) -> Column:
    """Exact decimal money as the double published in gold tables."""
    c = F.col(money) if isinstance(money, str) else money
    return c.cast("double")


def count_when(cond: Column) -> Column:
    """Number of rows where ``cond`` holds, as bigint (NULL counts as false, 0 on no rows)."""
    return F.count_if(cond)
