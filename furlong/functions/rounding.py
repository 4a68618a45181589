"""Exact two-decimal rounding, half away from zero, without floating point.

Rates are rounded the way a database ``NUMERIC`` rounds them: to hundredths,
ties away from zero.  All inputs here are non-negative, so that is
``floor(x * 100 + 1/2)``.  For ``x = num / den * p / q`` (integer totals,
integer scale factor p/q) that is one exact integer division:

    (200·p·num + q·den) div (2·q·den)

evaluated on longs where the totals are so small that nothing can overflow, and
on DECIMAL(38,0), many times as slow, where they are not.  This runs once per
group, after the aggregation; per-row work stays in longs.  A zero
denominator gives NULL, like ``NULLIF``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(38,0)"


def _int_div(num: Column, den: Column) -> Column:
    return F.call_function("div", num, den)


def hundredths(num: Column, den: Column, p: int = 1, q: int = 1) -> Column:
    """``round(num / den * p / q, 2) * 100`` as BIGINT, for num, den >= 0."""
    def rounded(kind: str) -> Column:
        n, d = num.cast(kind), den.cast(kind)
        return _int_div(n * F.lit(200 * p) + d * F.lit(q),
                        F.nullif(d * F.lit(2 * q), F.lit(0))).cast("long")

    most = F.lit(2**61 // (200 * max(p, q)))
    small = num.between(-most, most) & den.between(-most, most)
    return F.when(small, rounded("long")).otherwise(rounded(_EXACT))


def from_hundredths(h: Column) -> Column:
    return h.cast("double") / F.lit(100)


def percent2(num: Column, den: Column) -> Column:
    """``round(num / den * 100, 2)`` as DOUBLE."""
    return from_hundredths(hundredths(num, den, 100))


def mean2(total: Column, count: Column, q: int = 1) -> Column:
    """``round(total / q / count, 2)`` as DOUBLE (NULL when count is 0)."""
    return from_hundredths(hundredths(total, count, 1, q))


def exact_ratio(num: Column, den: Column) -> Column:
    """``num / den`` as DECIMAL(38,18), for ordering by an unrounded ratio
    of two long totals (a double quotient could tie distinct ratios)."""
    return num.cast("decimal(20,0)") / den.cast("decimal(20,0)")
