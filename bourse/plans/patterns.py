"""The 61 candlestick patterns on daily bars.

Plan (one exchange by ticker, then window stages on the same spec):

1. shape columns of each bar (body, shadows, range, colour);
2. thresholds: 10- and 5-bar means over the bars *before* each bar, null
   until the full window exists;
3. lags 1..4 of shapes and thresholds (one Window operator);
4. the 59 single-stage patterns as ``CASE`` expressions (split into a few
   selects to stay under the codegen method limit);
5. the Hikkake pair: trigger lags 1..3 and the confirmation rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.rolling import series_window
from . import candles

SINGLE = [p for p in candles.PATTERN_COLUMNS if p not in candles.HIKKAKE_TRIGGERS]


def shapes(bars: DataFrame) -> DataFrame:
    w = series_window()
    o, h, l, c = (F.col(x) for x in ("open", "high", "low", "close"))
    df = bars.withColumns(
        {
            "rn": F.row_number().over(w) - 1,
            "o0": o, "h0": h, "l0": l, "c0": c,
            "body0": F.abs(c - o),
            "top0": F.greatest(o, c),
            "bot0": F.least(o, c),
            "rng0": h - l,
            "col0": F.when(c >= o, F.lit(1)).otherwise(F.lit(-1)),
        }
    )
    return df.withColumns(
        {"up0": F.col("h0") - F.col("top0"), "lo0": F.col("bot0") - F.col("l0")}
    ).withColumn("shd0", F.col("up0") + F.col("lo0"))


def thresholds(df: DataFrame) -> DataFrame:
    w = series_window()
    out = {}
    for name, (src, n, factor) in candles.THRESHOLDS.items():
        frame = w.rowsBetween(-n, -1)
        mean = F.when(F.count(f"{src}0").over(frame) == n, F.avg(f"{src}0").over(frame))
        out[f"{name}0"] = F.lit(factor) * mean
    return df.withColumns(out)


def lagged(df: DataFrame) -> DataFrame:
    w = series_window()
    names = candles.SHAPES + list(candles.THRESHOLDS)
    return df.withColumns(
        {f"{n}{k}": F.lag(f"{n}0", k).over(w) for k in range(1, candles.MAX_OFFSET + 1) for n in names}
    )


def patterns_daily(bars: DataFrame, penetration: float = candles.PENETRATION, groups: int = 4) -> DataFrame:
    """ticker, date and the 61 pattern columns (int, 0 when not firing)."""
    df = lagged(thresholds(shapes(bars)))
    triggers = {f"_{n}": F.expr(candles.trigger_case(n)) for n in candles.HIKKAKE_TRIGGERS}
    df = df.withColumns(triggers)
    w = series_window()
    df = df.withColumns({f"_{n}_{k}": F.lag(f"_{n}", k).over(w) for n in candles.HIKKAKE_TRIGGERS for k in (1, 2, 3)})
    size = -(-len(SINGLE) // groups)
    for g in range(groups):
        part = SINGLE[g * size:(g + 1) * size]
        df = df.withColumns({p: F.expr(candles.pattern_case(p, penetration)) for p in part})
    df = df.withColumns({n: F.expr(candles.confirm_case(f"_{n}")) for n in candles.HIKKAKE_TRIGGERS})
    return df.select("ticker", "date", *candles.PATTERN_COLUMNS)


def patterns_monthly(daily: DataFrame) -> DataFrame:
    """Month-end median of every pattern column (double), then drop
    months with a null."""
    return (
        daily.groupBy("ticker", F.last_day("date").alias("date"))
        .agg(*[F.median(c).alias(c) for c in candles.PATTERN_COLUMNS])
        .dropna("any")
    )
