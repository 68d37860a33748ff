"""Macro and market series aligned on month-ends.

Long input ``(series, date, value)``.  The name -> code map is a fixed,
small dictionary, so the alignment is one ``groupBy(month).pivot(code,
codes)`` (one shuffle, partial aggregation) instead of N outer joins.  The
result has one row per month: its size is bounded by the calendar times
the number of configured series, which is what makes the later broadcast
joins (J03, J04) and the un-keyed forward-fill window (W08) safe.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The reference's series configuration (friendly name -> code).
MACRO_SERIES = {
    "gdp_us": "GDPC1",
    "cpi_us": "CPIAUCSL",
    "unemployment_us": "UNRATE",
    "interest_us": "FEDFUNDS",
    "gdp_de": "CLVMNACSCAB1GQDE",
    "cpi_de": "DEUCPIALLMINMEI",
    "interest_eu": "IRLTLT01EZM156N",
}
MARKET_SERIES = {
    "sp500": "^GSPC",
    "vix": "^VIX",
    "dax": "^GDAXI",
    "spy": "SPY",
    "gld": "GLD",
    "vgk": "VGK",
    "xlv": "XLV",
    "xlk": "XLK",
    "xlf": "XLF",
    "efa": "EFA",
    "eurusd": "EURUSD=X",
    "usdx": "DX-Y.NYB",
}

# The test fixtures carry other codes (see FIXTURES.md).
FIXTURE_MACRO = {
    "macro_urgent": "1-URGENT",
    "macro_high": "2-HIGH",
    "macro_medium": "3-MEDIUM",
    "macro_not_specified": "4-NOT SPECIFIED",
    "macro_low": "5-LOW",
}
FIXTURE_MARKET = {
    "mkt_automobile": "AUTOMOBILE",
    "mkt_building": "BUILDING",
    "mkt_furniture": "FURNITURE",
    "mkt_household": "HOUSEHOLD",
    "mkt_machinery": "MACHINERY",
}


def _last_non_null(value: str = "value", order: str = "date"):
    """Last non-null value of the group (pandas ``last`` skips NaN)."""
    return F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.col(order)))


def month_end_last(series: DataFrame, names: dict[str, str]) -> DataFrame:
    """One row per month-end, one column per configured series (P02 rename
    by pivot value alias); unconfigured series are pruned at the scan."""
    codes = list(names.values())
    wide = (
        series.where(F.col("series").isin(codes))
        .groupBy(F.last_day("date").alias("date"))
        .pivot("series", codes)
        .agg(_last_non_null())
    )
    return wide.select("date", *[F.col(f"`{code}`").alias(name) for name, code in names.items()])


def _month_range(lo, hi):
    """Explode the month-ends from the month of ``lo`` to the month of ``hi``."""
    firsts = F.sequence(F.trunc(lo, "month"), F.trunc(hi, "month"), F.expr("interval 1 month"))
    return F.explode(F.transform(firsts, F.last_day))


def macro_features(macro: DataFrame, names: dict[str, str] = MACRO_SERIES) -> DataFrame:
    """Month-end last value, outer-aligned (J07) on a dense month grid
    from the first to the last month of any series, then forward filled (W08).

    The grid and the fill run over the month table (a few hundred rows per
    century of history), so one un-keyed window is fine.
    """
    wide = month_end_last(macro, names)
    bounds = wide.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    grid = bounds.select(_month_range("lo", "hi").alias("date"))
    full = grid.join(F.broadcast(wide), "date", "left")
    w = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return full.select("date", *[F.last(n, ignorenulls=True).over(w).alias(n) for n in names])


def market_features(market: DataFrame, names: dict[str, str] = MARKET_SERIES) -> DataFrame:
    """Month-end last value of each daily series on that series' own
    dense month range, outer-aligned on date (J06); no fill."""
    codes = list(names.values())
    sub = market.where(F.col("series").isin(codes))
    ranges = sub.groupBy("series").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    months = ranges.select(_month_range("lo", "hi").alias("date")).distinct()
    wide = month_end_last(sub, names)
    return months.join(F.broadcast(wide), "date", "left").select("date", *names)


def market_features_by_joins(market: DataFrame, names: dict[str, str] = MARKET_SERIES) -> DataFrame:
    """J06 as the reference writes it: one month-end frame per series folded
    with full outer joins on date.  Same rows as ``market_features``; kept
    as the parity check of the pivot plan (N - 1 joins instead of one
    shuffle)."""
    frames = []
    for name, code in names.items():
        one = market.where(F.col("series") == code)
        rng = one.agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
        months = rng.select(_month_range("lo", "hi").alias("date"))
        last = one.groupBy(F.last_day("date").alias("date")).agg(_last_non_null().alias(name))
        frames.append(months.join(last, "date", "left"))
    return reduce(lambda a, b: a.join(b, "date", "full_outer"), frames).select("date", *names)
