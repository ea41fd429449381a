"""Exact half-up rounding of ratios.

``round(avg(x), 2)`` on doubles lands on the wrong side of a tie whenever the
binary value of the mean sits just under the decimal half (and the two SQL
engines used here disagree on such ties). Every rounded metric in the
pipeline is a ratio of an exact numerator (decimal money or a count) and an
exact denominator (a count or a decimal total), so it is rounded with exact
integral division instead:

    round_half_up(n / d, s) = sign(n) * ((2 * |n| * 10^s + d) div (2 * d)) / 10^s

``div`` is Spark's exact integral division; all of it stays in codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_up_ratio(num: Column | str, den: Column | str, scale: int) -> Column:
    """``num / den`` rounded half away from zero to ``scale`` digits, as double.

    ``num`` must be exact (integral, or decimal such that ``num * 10^scale``
    is integral); ``den`` must be exact and positive (a count, or a decimal
    total as in a share of revenue). Returns NULL when ``den`` is 0 or NULL.
    """
    n, d = _col(num), _col(den)
    factor = 10 ** scale
    scaled = n * F.lit(factor)
    q = F.call_function("div", F.abs(scaled) * 2 + d, F.nullif(d * 2, F.lit(0)))
    signed = F.when(scaled < 0, -q).otherwise(q)
    return (signed.cast("double") / F.lit(float(factor))).cast("double")


def half_up_mean(total: Column | str, count: Column | str, scale: int) -> Column:
    """Mean from an exact sum and a non-null count, rounded half-up."""
    return half_up_ratio(total, count, scale)


def percent(part: Column | str, whole: Column | str, scale: int) -> Column:
    """``round(part * 100 / whole, scale)`` with exact half-up rounding."""
    return half_up_ratio(_col(part) * F.lit(100), whole, scale)


def cents(money: Column | str) -> Column:
    """A two-decimal double (a rounded money value) as exact DECIMAL(38,2)."""
    return _col(money).cast("decimal(38,2)")
