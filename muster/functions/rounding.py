"""Exact rounding on integers.

Rounding a double depends on its binary value and rounding a decimal average
rounds twice, so averages and rates are computed as whole hundredths, half away
from zero, and become a double once, at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(num: Column, den: Column) -> Column:
    """Whole part of ``num / den``; null when ``den`` is 0."""
    return F.call_function("div", num.cast("bigint"), F.nullif(den.cast("bigint"), F.lit(0)))


def div_half_up(num: Column, den: Column) -> Column:
    """``num / den`` rounded to a whole number, half away from zero (``den`` >= 0)."""
    magnitude = int_div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -magnitude).otherwise(magnitude)


def to_hundredths(c: Column) -> Column:
    """Decimal with two places as a count of hundredths."""
    return (c * 100).cast("bigint")


def from_hundredths(c: Column) -> Column:
    return c / F.lit(100)


def rate_pct(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent to two places; null when ``whole`` is 0."""
    return from_hundredths(div_half_up(part * 10000, whole))


def mean_of_hundredths(total: Column, n: Column) -> Column:
    """Average of ``n`` values whose sum is ``total`` hundredths, to two places."""
    return from_hundredths(div_half_up(total, n))


def years_in_hundredths(days: Column) -> Column:
    """``days / 365.25`` rounded to two places, as hundredths (365.25 = 1461 / 4)."""
    return div_half_up(days.cast("bigint") * 400, F.lit(1461))
