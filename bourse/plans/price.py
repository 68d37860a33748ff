"""Monthly price features from daily bars.

Plan: bars are exchanged by ticker once; the daily windows (growth, rolling
volatility), the month-end aggregation (keyed ticker + month, which the
ticker partitioning already satisfies) and the monthly windows all run in
that one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import ln_volume, rel_spread, round6
from ..operators.calendar import dense_months
from ..operators.rolling import (
    forward_filled,
    masked,
    pct_change,
    rolling_max,
    rolling_mean,
    rolling_min,
    rolling_std,
    series_window,
)

GROWTH_LAGS = {"daily_growth": 1, "weekly_growth": 5, "biweekly_growth": 10, "monthly_growth": 21}
VOL_WINDOW = 10
MIN_MED_MAX = ["ln_volume", *GROWTH_LAGS]
MEDIAN_ONLY = [
    "rel_spread_oc", "rel_spread_hl",
    "vol_10d_mean", "vol_10d_std", "vol_10d_min", "vol_10d_max",
]
MONTHLY_AGG_COLUMNS = (
    ["close"]
    + [f"{c}_{f}" for c in MIN_MED_MAX for f in ("min", "median", "max")]
    + [f"{c}_median" for c in MEDIAN_ONLY]
)
PRICE_COLUMNS = (
    ["date", "close"]
    + MONTHLY_AGG_COLUMNS[1:]
    + ["return_1m", "return_2m", "return_3m", "vol_3m", "momentum_3m",
       "mma_3_scaled", "mma_6_scaled", "year", "month", "ticker"]
)


def by_ticker(bars: DataFrame, key: str = "ticker") -> DataFrame:
    """Exchange bars by ticker once; every later window / month aggregation
    reuses this partitioning.

    The partition count is the session's ``spark.sql.shuffle.partitions``
    (sized by the cluster for the data), given explicitly so that AQE does
    not coalesce by bytes: the bar table is narrow but the window stages on
    it are compute-heavy, so parallelism matters more than partition size.
    """
    n = int(bars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return bars.repartition(n, key)


def choose_close(df: DataFrame) -> DataFrame:
    """Use ``adj_close`` as ``close`` when the column exists."""
    if "adj_close" in df.columns:
        return df.drop("close").withColumnRenamed("adj_close", "close")
    return df


def daily_features(bars: DataFrame) -> DataFrame:
    """F01, F02, W01, W02 on daily bars."""
    w = series_window()
    df = choose_close(bars).withColumn("_close_ff", forward_filled("close", w))
    df = df.withColumns(
        {"ln_volume": ln_volume("volume")}
        | {name: pct_change("_close_ff", w, n) for name, n in GROWTH_LAGS.items()}
        | {
            "rel_spread_oc": rel_spread("open", "close", "close"),
            "rel_spread_hl": rel_spread("high", "low", "close"),
        }
    )
    g = "daily_growth"
    df = df.withColumns(
        {
            "vol_10d_mean": rolling_mean(g, w, VOL_WINDOW),
            "vol_10d_std": rolling_std(g, w, VOL_WINDOW),
            "vol_10d_min": rolling_min(g, w, VOL_WINDOW),
            "vol_10d_max": rolling_max(g, w, VOL_WINDOW),
        }
    )
    return df.drop("_close_ff")


def month_end_resample(daily: DataFrame) -> DataFrame:
    """close = last non-null close of the month; min / median / max of
    ln_volume and the growths; median of spreads and rolling volatility."""
    aggs = [
        F.max_by("close", F.when(F.col("close").isNotNull(), F.col("date"))).alias("close")
    ]
    for c in MIN_MED_MAX:
        aggs += [
            F.min(c).alias(f"{c}_min"),
            F.median(c).alias(f"{c}_median"),
            F.max(c).alias(f"{c}_max"),
        ]
    aggs += [F.median(c).alias(f"{c}_median") for c in MEDIAN_ONLY]
    return daily.groupBy("ticker", F.last_day("date").alias("date")).agg(*aggs)


def monthly_features(monthly: DataFrame, rounded: bool = True, drop_incomplete: bool = True) -> DataFrame:
    """W09, W03-W06, F05, F06, P06 on the month-end table."""
    df = dense_months(monthly)
    w = series_window()
    df = df.withColumn("_close_ff", forward_filled("close", w))
    df = df.withColumns(
        {f"return_{k}m": pct_change("_close_ff", w, k) for k in (1, 2, 3)}
    )
    df = df.withColumn("vol_3m", rolling_std("return_1m", w, 3))
    df = df.withColumns(
        {
            # vol 0 gives +-inf in pandas; we return null (documented deviation)
            "momentum_3m": F.when(F.col("vol_3m") != 0, F.try_divide("return_3m", "vol_3m")),
            "mma_3_scaled": F.try_divide(rolling_mean("close", w, 3), F.col("close")),
            "mma_6_scaled": F.try_divide(rolling_mean("close", w, 6), F.col("close")),
        }
    ).drop("_close_ff")
    if rounded:
        df = df.withColumns(
            {c: round6(c) for c, t in df.dtypes if t == "double"}
        )
    df = df.withColumns({"year": F.year("date"), "month": F.month("date")})
    df = df.select(*PRICE_COLUMNS)
    return df.dropna("any") if drop_incomplete else df


def price_features(bars: DataFrame, partitioned: bool = False) -> DataFrame:
    """Daily bars -> one row per ticker and month-end.  Pass
    ``partitioned=True`` for bars already exchanged by ``by_ticker``."""
    return monthly_features(month_end_resample(daily_features(bars if partitioned else by_ticker(bars))))
