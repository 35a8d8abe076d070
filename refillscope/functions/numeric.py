"""Numeric expressions: guarded division, half-even mean, percentage."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Digits kept before the half-even rounding of a mean. Sums of quotients depend on
# summation order in the last bit; rounding to 9 decimals first makes the integer
# mean independent of partitioning and of the engine that computes it.
MEAN_STABILISING_DIGITS = 9


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def usable_quantity(c) -> Column:
    """A quantity that can divide: not NULL, not NaN and not zero."""
    col = _col(c)
    return col.isNotNull() & ~F.isnan(col) & (col != F.lit(0.0))


def safe_ratio(numerator, denominator) -> Column:
    """``numerator / denominator`` as DOUBLE, NULL when the denominator is 0 or either is NULL or NaN."""
    top, bottom = (_col(c).cast("double") for c in (numerator, denominator))
    return F.try_divide(F.nanvl(top, F.lit(None).cast("double")), F.nanvl(bottom, F.lit(None).cast("double")))


def half_even_mean(total, count) -> Column:
    """``int(round(total / count))`` with Python's half-even rounding; NULL when count is 0."""
    ratio = safe_ratio(total, count)
    return F.bround(F.round(ratio, MEAN_STABILISING_DIGITS), 0).cast("int")


def percentage_2dp(numerator, denominator) -> Column:
    """``round(numerator / denominator * 100, 2)``; NULL when the denominator is 0."""
    return F.round(safe_ratio(numerator, denominator) * F.lit(100.0), 2)
