"""Per-key window operators (W rows of the inventory).

Every window here is ``partitionBy(key).orderBy(time)``: the data is
exchanged once by key and each key's rows are sorted inside its task.  A
key's series holds at most one row per calendar day (bars) or month
(monthly tables), so the largest window partition is bounded by the length
of the calendar, not by the size of the data set.
"""

from __future__ import annotations

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.scalar import col


def series_window(key: str = "ticker", order: str = "date") -> WindowSpec:
    return Window.partitionBy(key).orderBy(order)


def trailing(w: WindowSpec, n: int) -> WindowSpec:
    """The last ``n`` rows up to and including the current one."""
    return w.rowsBetween(-(n - 1), 0)


def forward_filled(c, w: WindowSpec) -> Column:
    """Last non-null value up to the current row (pad fill, W08 / W12)."""
    return F.last(col(c), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))


def pct_change(c, w: WindowSpec, periods: int = 1) -> Column:
    """c_t / c_{t-periods} - 1 on a padded series.

    pandas pads missing values before dividing ([1, NaN, 3] -> [NaN, 0, 2]);
    pass a forward-filled column to get the same.  A zero base gives null.
    """
    c = col(c)
    return F.try_divide(c, F.lag(c, periods).over(w)) - F.lit(1.0)


def masked(agg: Column, x, w: WindowSpec, n: int) -> Column:
    """``agg`` over the trailing ``n`` rows, null until all ``n`` are non-null
    (pandas ``rolling(n)`` with the default ``min_periods=n``; W02/W04/W06)."""
    frame = trailing(w, n)
    return F.when(F.count(col(x)).over(frame) == n, agg.over(frame))


def rolling_mean(x, w: WindowSpec, n: int) -> Column:
    return masked(F.avg(col(x)), x, w, n)


def rolling_std(x, w: WindowSpec, n: int) -> Column:
    return masked(F.stddev_samp(col(x)), x, w, n)


def rolling_min(x, w: WindowSpec, n: int) -> Column:
    return masked(F.min(col(x)), x, w, n)


def rolling_max(x, w: WindowSpec, n: int) -> Column:
    return masked(F.max(col(x)), x, w, n)


def rolling_sum(x, w: WindowSpec, n: int) -> Column:
    return masked(F.sum(col(x)), x, w, n)
