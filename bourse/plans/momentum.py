"""The 38 momentum indicators on daily bars.

Warm-up rows are null.  Zero-denominator results follow the published
conventions of the indicator library the reference calls (0 for BOP, CCI,
RSI, CMO, STOCH, WILLR, ROC family when the denominator vanishes).

Plan: one exchange by ticker (shared with C01 / C04 when the same ``bars``
DataFrame is used), then window stages:

0. row number, lags and shape columns (true range, directional moves,
   gains / losses, typical price);
1. framed window aggregates (SMA, min/max, sums) and the first scans
   (Wilder sums of TR/+DM/-DM, RSI means, the four MACD EMAs, TRIX EMA 1);
2. scans on scans (TRIX EMA 2), DX, MACD lines;
3. ADX, signal lines, TRIX EMA 3, stochastic RSI;
4. ADXR and TRIX.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.rolling import series_window, trailing
from ..operators.scan import affine_scans, chunk_of, ema, scan_window, wilder_mean, wilder_sum

# The output column names.
MOMENTUM_COLUMNS = [
    "adx", "adxr", "apo", "aroon_1", "aroon_2", "aroonosc", "bop", "cci", "cmo", "dx",
    "macd", "macdsignal", "macdhist", "macd_ext", "macdsignal_ext", "macdhist_ext",
    "macd_fix", "macdsignal_fix", "macdhist_fix", "minus_di", "mom", "plus_di", "dm",
    "ppo", "roc", "rocp", "rocr", "rocr100", "rsi", "slowk", "slowd", "fastk", "fastd",
    "fastk_rsi", "fastd_rsi", "trix", "ultosc", "willr",
]

# First row (0-based, per ticker) with a value -- the library's lookbacks.
LOOKBACK = {
    "adx": 27, "adxr": 40, "apo": 25, "aroon_1": 14, "aroon_2": 14, "aroonosc": 14,
    "bop": 0, "cci": 13, "cmo": 14, "dx": 14, "macd": 33, "macdsignal": 33, "macdhist": 33,
    "macd_ext": 33, "macdsignal_ext": 33, "macdhist_ext": 33, "macd_fix": 33,
    "macdsignal_fix": 33, "macdhist_fix": 33, "minus_di": 13, "mom": 10, "plus_di": 14,
    "dm": 13, "ppo": 25, "roc": 10, "rocp": 10, "rocr": 10, "rocr100": 10, "rsi": 14,
    "slowk": 8, "slowd": 8, "fastk": 6, "fastd": 6, "fastk_rsi": 20, "fastd_rsi": 20,
    "trix": 88, "ultosc": 28, "willr": 13,
}

PERIOD = 14
TINY = 1e-8  # the library's "is zero" tolerance


def _nz(c):
    """True when |c| is not within the library's zero tolerance."""
    return (c <= -TINY) | (c >= TINY)


def base_columns(bars: DataFrame) -> DataFrame:
    """Stage 0: row number and one-bar shape columns.

    A recurrence cannot pass over a missing bar.  Leading incomplete bars
    shift the start (and so every seed row); from the first null inside a
    series on, its indicators are null (``_whole`` is false)."""
    w = series_window()
    h, l, c, o = (F.col(x) for x in ("high", "low", "close", "open"))
    prev_h, prev_l, prev_c = F.lag("high").over(w), F.lag("low").over(w), F.lag("close").over(w)
    # a series starts at its first complete bar; "_whole" ends with the first
    # null inside it
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    complete = h.isNotNull() & l.isNotNull() & c.isNotNull() & o.isNotNull()
    df = bars.withColumns({"_row": F.row_number().over(w), "_seen": F.count(F.when(complete, 1)).over(upto)})
    df = df.withColumn("rn", F.col("_row") - F.min(F.when(complete, F.col("_row"))).over(upto))
    df = df.withColumns(
        {
            "_whole": F.coalesce(F.col("_seen") == F.col("rn") + 1, F.lit(False)),
            "_c1": prev_c,
            "_up": h - prev_h,
            "_down": prev_l - l,
            "_chg": c - prev_c,
        }
    )
    up, down, chg, c1 = F.col("_up"), F.col("_down"), F.col("_chg"), F.col("_c1")
    return df.withColumns(
        {
            "_chunk": chunk_of("rn"),
            "_tr": F.greatest(h - l, F.abs(h - c1), F.abs(l - c1)),
            "_pdm": F.when((up > 0) & (up > down), up).when(up.isNotNull(), F.lit(0.0)),
            "_mdm": F.when((down > 0) & (up < down), down).when(down.isNotNull(), F.lit(0.0)),
            "_gain": F.when(chg > 0, chg).when(chg.isNotNull(), F.lit(0.0)),
            "_loss": F.when(chg < 0, -chg).when(chg.isNotNull(), F.lit(0.0)),
            "_tp": (h + l + c) / 3,
            "_bp": c - F.least(l, c1),
        }
    )


def _from(rn_min: int, expr):
    return F.when(F.col("rn") >= rn_min, expr)


def window_indicators(df: DataFrame) -> DataFrame:
    """Indicators that need only framed windows and lags (21 of 38)."""
    w = scan_window()
    c, h, l, o = (F.col(x) for x in ("close", "high", "low", "open"))

    def avg(x, n):
        return F.avg(x).over(trailing(w, n))

    def lo(x, n):
        return F.min(x).over(trailing(w, n))

    def hi(x, n):
        return F.max(x).over(trailing(w, n))

    c10 = F.lag("close", 10).over(w)
    sma12, sma26 = avg("close", 12), avg("close", 26)
    # aroon: bars since the extreme of the last 15 bars, latest bar wins ties
    aroon_frame = trailing(w, PERIOD + 1)
    low_idx = F.min_by("rn", F.struct(F.col("low"), -F.col("rn"))).over(aroon_frame)
    high_idx = F.max_by("rn", F.struct(F.col("high"), F.col("rn"))).over(aroon_frame)
    factor = F.lit(100.0 / PERIOD)
    ll5, hh5 = lo("low", 5), hi("high", 5)
    ll14, hh14 = lo("low", 14), hi("high", 14)
    tp_lags = [F.lag("_tp", k).over(w) for k in range(PERIOD)]
    df = df.withColumns(
        {
            "_sma12": sma12,
            "_sma26": sma26,
            "_c10": c10,
            "_low_idx": low_idx,
            "_high_idx": high_idx,
            "_fastk_raw": F.when(
                hh5 - ll5 != 0, F.try_divide(c - ll5, (hh5 - ll5) / F.lit(100.0))
            ).otherwise(F.lit(0.0)),
            "willr": _from(
                13,
                F.when(hh14 - ll14 != 0, F.try_divide(hh14 - c, (hh14 - ll14) / F.lit(-100.0))).otherwise(F.lit(0.0)),
            ),
            "_tp_avg": avg("_tp", PERIOD),
            "_tp_lags": F.array(*tp_lags),
            "bop": F.when(h - l < TINY, F.lit(0.0)).otherwise(F.try_divide(c - o, h - l)),
            "_bp7": F.sum("_bp").over(trailing(w, 7)),
            "_bp14": F.sum("_bp").over(trailing(w, 14)),
            "_bp28": F.sum("_bp").over(trailing(w, 28)),
            "_tr7": F.sum("_tr").over(trailing(w, 7)),
            "_tr14": F.sum("_tr").over(trailing(w, 14)),
            "_tr28": F.sum("_tr").over(trailing(w, 28)),
        }
    )
    c10 = F.col("_c10")
    nz10 = c10 != 0
    mad = F.aggregate(
        F.col("_tp_lags"), F.lit(0.0), lambda acc, x: acc + F.abs(x - F.col("_tp_avg"))
    )
    dev = F.col("_tp") - F.col("_tp_avg")
    ult = (
        F.when(_nz(F.col("_tr7")), F.lit(4.0) * F.try_divide(F.col("_bp7"), F.col("_tr7"))).otherwise(F.lit(0.0))
        + F.when(_nz(F.col("_tr14")), F.lit(2.0) * F.try_divide(F.col("_bp14"), F.col("_tr14"))).otherwise(F.lit(0.0))
        + F.when(_nz(F.col("_tr28")), F.try_divide(F.col("_bp28"), F.col("_tr28"))).otherwise(F.lit(0.0))
    )
    df = df.withColumns(
        {
            "apo": _from(25, F.col("_sma12") - F.col("_sma26")),
            "ppo": _from(
                25,
                F.when(_nz(F.col("_sma26")), F.try_divide(F.col("_sma12") - F.col("_sma26"), F.col("_sma26")) * 100.0)
                .otherwise(F.lit(0.0)),
            ),
            "_macd_ext_line": F.col("_sma12") - F.col("_sma26"),
            "aroon_1": _from(14, factor * (F.lit(PERIOD) - (F.col("rn") - F.col("_low_idx")))),
            "aroon_2": _from(14, factor * (F.lit(PERIOD) - (F.col("rn") - F.col("_high_idx")))),
            "aroonosc": _from(14, factor * (F.col("_high_idx") - F.col("_low_idx"))),
            "cci": _from(
                13,
                F.when((dev != 0) & (mad != 0), F.try_divide(dev, F.lit(0.015) * (mad / F.lit(float(PERIOD)))))
                .otherwise(F.lit(0.0)),
            ),
            "mom": _from(10, c - c10),
            "roc": _from(10, F.when(nz10, (F.try_divide(c, c10) - 1.0) * 100.0).otherwise(F.lit(0.0))),
            "rocp": _from(10, F.when(nz10, F.try_divide(c - c10, c10)).otherwise(F.lit(0.0))),
            "rocr": _from(10, F.when(nz10, F.try_divide(c, c10)).otherwise(F.lit(0.0))),
            "rocr100": _from(10, F.when(nz10, F.try_divide(c, c10) * 100.0).otherwise(F.lit(0.0))),
            "ultosc": _from(28, F.lit(100.0) * (ult / F.lit(7.0))),
            "_fastk_sma3": avg("_fastk_raw", 3),
        }
    )
    df = df.withColumns(
        {
            "fastk": _from(6, F.col("_fastk_raw")),
            "fastd": _from(6, F.col("_fastk_sma3")),
            "slowk": _from(8, F.col("_fastk_sma3")),
            "slowd": _from(8, avg("_fastk_sma3", 3)),
            "macd_ext": _from(33, F.col("_macd_ext_line")),
            "macdsignal_ext": _from(33, avg("_macd_ext_line", 9)),
        }
    )
    return df.withColumn("macdhist_ext", F.col("macd_ext") - F.col("macdsignal_ext"))


def scan_indicators(df: DataFrame) -> DataFrame:
    """Indicators built on affine scans (17 of 38)."""
    w = scan_window()
    k12, k26 = 2.0 / 13, 2.0 / 27
    df = affine_scans(
        df,
        [
            wilder_sum("_tr", "_s_tr", PERIOD, 13),
            wilder_sum("_pdm", "_s_pdm", PERIOD, 13),
            wilder_sum("_mdm", "_s_mdm", PERIOD, 13),
            wilder_mean("_gain", "_g", PERIOD, 14),
            wilder_mean("_loss", "_l", PERIOD, 14),
            ema("close", "_ema12", 12, seed_row=25, k=k12),
            ema("close", "_ema26", 26, seed_row=25, k=k26),
            ema("close", "_fix12", 12, seed_row=25, k=0.15),
            ema("close", "_fix26", 26, seed_row=25, k=0.075),
            ema("close", "_e30a", 30, seed_row=29),
        ],
    )
    s_tr, s_pdm, s_mdm = F.col("_s_tr"), F.col("_s_pdm"), F.col("_s_mdm")
    pdi = F.lit(100.0) * F.try_divide(s_pdm, s_tr)
    mdi = F.lit(100.0) * F.try_divide(s_mdm, s_tr)
    g, lo_ = F.col("_g"), F.col("_l")
    df = df.withColumns(
        {
            "dm": _from(13, s_pdm),
            "minus_di": _from(13, s_mdm),
            "plus_di": _from(14, F.when(_nz(s_tr), pdi).otherwise(F.lit(0.0))),
            "dx": _from(
                14,
                F.when(_nz(s_tr) & _nz(pdi + mdi), F.lit(100.0) * F.try_divide(F.abs(mdi - pdi), mdi + pdi))
                .otherwise(F.lit(0.0)),
            ),
            "rsi": _from(14, F.when(_nz(g + lo_), F.lit(100.0) * F.try_divide(g, g + lo_)).otherwise(F.lit(0.0))),
            "cmo": _from(14, F.when(_nz(g + lo_), F.lit(100.0) * F.try_divide(g - lo_, g + lo_)).otherwise(F.lit(0.0))),
            "_macd_line": F.col("_ema12") - F.col("_ema26"),
            "_macd_fix_line": F.col("_fix12") - F.col("_fix26"),
        }
    )
    df = affine_scans(
        df,
        [
            ema("_e30a", "_e30b", 30, seed_row=58),
            wilder_mean("dx", "_adx", PERIOD, 27),
            ema("_macd_line", "_signal", 9, seed_row=33),
            ema("_macd_fix_line", "_signal_fix", 9, seed_row=33),
        ],
    )
    rsi = F.col("rsi")
    ll, hh = F.min(rsi).over(trailing(w, 5)), F.max(rsi).over(trailing(w, 5))
    df = df.withColumns(
        {
            "adx": _from(27, F.col("_adx")),
            "macd": _from(33, F.col("_macd_line")),
            "macdsignal": _from(33, F.col("_signal")),
            "macd_fix": _from(33, F.col("_macd_fix_line")),
            "macdsignal_fix": _from(33, F.col("_signal_fix")),
            "_srsi_k": F.when(hh - ll != 0, F.try_divide(rsi - ll, (hh - ll) / F.lit(100.0))).otherwise(F.lit(0.0)),
        }
    )
    df = affine_scans(df, [ema("_e30b", "_e30c", 30, seed_row=87)])
    df = df.withColumns(
        {
            "macdhist": F.col("macd") - F.col("macdsignal"),
            "macdhist_fix": F.col("macd_fix") - F.col("macdsignal_fix"),
            "adxr": _from(40, (F.col("adx") + F.lag("adx", PERIOD - 1).over(w)) / F.lit(2.0)),
            "fastk_rsi": _from(20, F.col("_srsi_k")),
            "fastd_rsi": _from(20, F.avg("_srsi_k").over(trailing(w, 3))),
            "_e30c_prev": F.lag("_e30c").over(w),
        }
    )
    prev = F.col("_e30c_prev")
    return df.withColumn(
        "trix",
        _from(88, F.when(prev != 0, (F.try_divide(F.col("_e30c"), prev) - 1.0) * 100.0).otherwise(F.lit(0.0))),
    )


def momentum_daily(bars: DataFrame) -> DataFrame:
    """Ticker, date and the 38 indicator columns, one row per bar."""
    df = window_indicators(base_columns(bars))
    df = scan_indicators(df)
    return df.select("ticker", "date", *[F.when(F.col("_whole"), F.col(c)).alias(c) for c in MOMENTUM_COLUMNS])


def momentum_monthly(daily: DataFrame) -> DataFrame:
    """Month-end median of every indicator, then drop months with a
    null in any of them."""
    return (
        daily.groupBy("ticker", F.last_day("date").alias("date"))
        .agg(*[F.median(c).alias(c) for c in MOMENTUM_COLUMNS])
        .dropna("any")
    )
