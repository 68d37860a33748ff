"""Scalar column functions (F, P rows of the inventory).

All are built-in Catalyst expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

def null_double() -> Column:
    return F.lit(None).cast("double")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round6(c) -> Column:
    """Half-even rounding of x*1e6, the way numpy rounds.

    ``round`` (half-up on the decimal) and ``bround`` (half-even on the
    decimal) both differ from numpy on some inputs; ``rint`` on the scaled
    double is numpy's own algorithm.  The value is first snapped to a 1e-12
    grid so that a true half-way value (e.g. a mean of 7-decimal inputs)
    rounds the same way whatever order a distributed sum added it in.
    """
    c = col(c)
    return F.rint(F.rint(c * F.lit(1e12)) / F.lit(1e6)) / F.lit(1e6)


def safe_div(num, den) -> Column:
    """Guarded ratio: null when the denominator is 0 or null."""
    return F.try_divide(col(num), col(den))


def guarded_margin(num, den) -> Column:
    """Null when numerator or denominator is 0 or null."""
    n, d = col(num), col(den)
    return F.when((n != 0) & (d != 0), F.try_divide(n, d))


def ln_volume(volume) -> Column:
    """ln(volume) with 0 -> null."""
    v = col(volume)
    return F.ln(F.nullif(v, F.lit(0.0)))


def rel_spread(a, b, base) -> Column:
    """(a - b) / base."""
    return F.try_divide(col(a) - col(b), col(base))


def clean_market_cap(c, scale_suffix: bool = False) -> Column:
    """Market-cap text to a number.

    Default reproduces the reference: '$', 'B', 'M' and ',' are removed, not
    scaled ("900M" -> 900 outranks "3B" -> 3).  ``scale_suffix=True`` applies
    the x1e9 / x1e6 the suffixes mean.
    """
    c = col(c)
    number = F.translate(c, "$BM,", "").try_cast("double")
    if not scale_suffix:
        return number
    return (
        F.when(c.endswith("B"), number * F.lit(1e9))
        .when(c.endswith("M"), number * F.lit(1e6))
        .otherwise(number)
    )


def to_number(c) -> Column:
    """Numeric coercion, bad text -> null."""
    return col(c).try_cast("double")


def prev_month_end(d) -> Column:
    """Last day of the month before ``d``."""
    return F.last_day(F.add_months(col(d), -1))


def days_to_first(dates_array, end) -> Column:
    """Days from ``end`` to element 0 of a date array."""
    return F.datediff(F.get(col(dates_array), 0), col(end)).cast("double")


def cyclical(c, period: int = 12):
    """sin / cos of 2*pi*c/period."""
    ang = col(c).cast("double") * F.lit(2 * math.pi / period)
    return F.sin(ang), F.cos(ang)


def growth_label(target, close, threshold: float = 1.10) -> Column:
    """1 if target >= close * threshold else 0; a null target gives 0."""
    return F.when(col(target) >= col(close) * F.lit(threshold), 1).otherwise(0)


def proba_label(probability, threshold: float = 0.475) -> Column:
    """1 if the class-1 probability >= threshold."""
    return F.when(col(probability) >= F.lit(threshold), 1).otherwise(0)
