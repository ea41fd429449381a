"""Column-expression helpers (all built-in Spark functions, no UDFs)."""

from shelfwise.functions.money import MONEY, TOTAL_MONEY, count_when, line_total, published
from shelfwise.functions.rounding import cents, half_up_mean, half_up_ratio, percent
from shelfwise.functions.totals import with_total

__all__ = ["MONEY", "TOTAL_MONEY", "count_when", "line_total", "published", "cents",
           "half_up_mean", "half_up_ratio", "percent", "with_total"]
