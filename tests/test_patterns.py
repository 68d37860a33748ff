"""Candlestick goldens: a firing series and a near miss per pattern family,
plus plan and warm-up properties."""

import datetime as dt

import pytest

from bourse.plans import candles
from bourse.plans import patterns as pat

SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume double"


def _frame(spark, bars, lead=12, base=100.0):
    """``lead`` quiet bars (body 1, range 2) then the test bars (o, h, l, c)."""
    d0 = dt.date(2021, 1, 1)
    rows = []
    for i in range(lead):
        rows.append(("T", d0 + dt.timedelta(days=i), base, base + 1.5, base - 0.5, base + 1.0, 1.0))
    for j, (o, h, l, c) in enumerate(bars):
        rows.append(("T", d0 + dt.timedelta(days=lead + j), o, h, l, c, 1.0))
    return spark.createDataFrame(rows, SCHEMA)


def _last(spark, bars, name):
    out = pat.patterns_daily(_frame(spark, bars)).orderBy("date").collect()
    return out[-1][name]


def test_doji_fires_and_near_miss(spark):
    assert _last(spark, [(100.0, 101.0, 99.0, 100.05)], "cdldoji") == 100
    assert _last(spark, [(100.0, 101.0, 99.0, 100.5)], "cdldoji") == 0


def test_engulfing_bullish_and_bearish(spark):
    assert _last(spark, [(101.0, 101.5, 99.5, 100.0), (99.5, 102.5, 99.0, 102.0)], "cdlengulfing") == 100
    assert _last(spark, [(100.0, 101.5, 99.5, 101.0), (101.5, 102.0, 99.0, 99.5)], "cdlengulfing") == -100
    # same colour: no engulfing
    assert _last(spark, [(100.0, 101.5, 99.5, 101.0), (99.5, 102.5, 99.0, 102.0)], "cdlengulfing") == 0


def test_marubozu_sign_follows_colour(spark):
    assert _last(spark, [(100.0, 104.0, 100.0, 104.0)], "cdlmarubozu") == 100
    assert _last(spark, [(104.0, 104.0, 100.0, 100.0)], "cdlmarubozu") == -100
    assert _last(spark, [(100.0, 106.0, 98.0, 104.0)], "cdlmarubozu") == 0


def test_hammer_and_hanging_man(spark):
    # small body at the top, long lower shadow, no upper shadow
    hammer = [(95.0, 95.6, 94.9, 95.5), (95.0, 95.2, 92.0, 95.2)]
    assert _last(spark, hammer, "cdlhammer") == 100
    hanging = [(100.0, 101.6, 99.9, 101.5), (101.4, 101.6, 98.0, 101.6)]
    assert _last(spark, hanging, "cdlhangingman") == -100


def test_hikkake_trigger_and_confirmation(spark):
    bars = [
        (100.0, 104.0, 96.0, 101.0),   # mother bar
        (100.5, 103.0, 97.0, 101.0),   # inside bar
        (100.0, 102.0, 95.0, 99.0),    # lower high and lower low -> bullish trigger
        (99.0, 100.0, 94.0, 99.5),     # not inside, no confirmation
        (100.0, 104.0, 99.0, 103.5),   # close above the inside bar's high -> +200
        (103.0, 105.0, 102.0, 104.5),  # already confirmed -> 0
    ]
    out = [r["cdlhikkake"] for r in pat.patterns_daily(_frame(spark, bars)).orderBy("date").collect()][-4:]
    assert out == [100, 0, 200, 0]


def test_mathold_never_fires_with_zero_penetration(spark):
    pred, _ = candles._patterns(0.0)["cdlmathold"]
    assert "bot2 < c4" in pred and "bot2 > c4 - body4 * 0.0" in pred


def test_warmup_is_zero(spark):
    out = pat.patterns_daily(_frame(spark, [], lead=12)).orderBy("date").collect()
    assert all(r["cdlbelthold"] == 0 for r in out[:10])


def test_lookbacks():
    assert candles.lookback(candles._patterns(0.0)["cdlengulfing"][0]) == 1
    assert candles.lookback(candles._patterns(0.0)["cdldoji"][0]) == 10
    assert candles.lookback(candles._patterns(0.0)["cdl3whitesoldiers"][0]) == 12
    assert candles.lookback(candles._patterns(0.0)["cdlbreakaway"][0]) == 14


def test_scaling_prices_leaves_patterns_unchanged(spark):
    from bourse.sources import tables as src
    from pyspark.sql import functions as F

    bars = src.bars(spark, "/root/testdata/sf0.001")
    scaled = bars.select("ticker", "date", *[(F.col(c) * 2).alias(c) for c in ("open", "high", "low", "close")],
                         "volume")
    a = pat.patterns_daily(bars).orderBy("ticker", "date").collect()
    b = pat.patterns_daily(scaled).orderBy("ticker", "date").collect()
    diff = sum(1 for x, y in zip(a, b) for n in candles.PATTERN_COLUMNS if x[n] != y[n])
    assert diff <= len(a) * len(candles.PATTERN_COLUMNS) // 1000  # only float ties at thresholds may move


def test_one_exchange_for_all_pattern_windows(spark):
    from bourse.sources import tables as src
    from bourse.plans.price import by_ticker

    df = pat.patterns_daily(by_ticker(src.bars(spark, "/root/testdata/sf0.001")))
    plan = df._jdf.queryExecution().executedPlan().toString()
    import re

    # one exchange by ticker alone: every window stage shares it
    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", plan)) == 1
    _ = pytest
