"""C01 price features: hand fixtures for what the generated data never shows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from bourse.operators.calendar import dense_months
from bourse.plans import price

SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume double"


def _bars(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _days(start, n):
    d0 = dt.date.fromisoformat(start)
    return [d0 + dt.timedelta(days=i) for i in range(n)]


def test_zero_volume_gives_null_log(spark):
    rows = [("Z", d, 1.0, 1.0, 1.0, 1.0 + i, 0.0 if i == 3 else 10.0) for i, d in enumerate(_days("2020-01-01", 12))]
    out = {r["date"]: r["ln_volume"] for r in price.daily_features(_bars(spark, rows)).collect()}
    assert out[dt.date(2020, 1, 4)] is None
    assert out[dt.date(2020, 1, 5)] == pytest.approx(2.302585092994046)


def test_null_close_is_padded_in_growth(spark):
    closes = [1.0, None, 3.0] + [3.0 + i for i in range(12)]
    rows = [("N", d, 1.0, 1.0, 1.0, c, 10.0) for d, c in zip(_days("2020-01-01", 15), closes)]
    out = sorted(price.daily_features(_bars(spark, rows)).collect(), key=lambda r: r["date"])
    # pandas pads before dividing: [1, NaN, 3] -> [NaN, 0, 2]
    assert out[0]["daily_growth"] is None
    assert out[1]["daily_growth"] == pytest.approx(0.0)
    assert out[2]["daily_growth"] == pytest.approx(2.0)
    # rolling 10 needs 10 non-null growths
    assert out[9]["vol_10d_mean"] is None
    assert out[10]["vol_10d_mean"] is not None


def test_dense_months_fills_gap(spark):
    df = spark.createDataFrame(
        [("G", dt.date(2020, 1, 31), 1.0), ("G", dt.date(2020, 4, 30), 2.0), ("H", dt.date(2020, 1, 31), 5.0)],
        "ticker string, date date, close double",
    )
    got = sorted((r["ticker"], r["date"], r["close"]) for r in dense_months(df).collect())
    assert got == [
        ("G", dt.date(2020, 1, 31), 1.0), ("G", dt.date(2020, 2, 29), None),
        ("G", dt.date(2020, 3, 31), None), ("G", dt.date(2020, 4, 30), 2.0),
        ("H", dt.date(2020, 1, 31), 5.0),
    ]


def test_gap_month_returns_use_padded_close(spark):
    jan = [("M", d, 1.0, 1.0, 1.0, 10.0, 1.0) for d in _days("2020-01-01", 31)]
    mar = [("M", d, 1.0, 1.0, 1.0, 12.0, 1.0) for d in _days("2020-03-01", 31)]
    m = price.monthly_features(price.month_end_resample(price.daily_features(_bars(spark, jan + mar))),
                               drop_incomplete=False)
    rows = {r["date"]: r for r in m.collect()}
    assert rows[dt.date(2020, 2, 29)]["close"] is None
    assert rows[dt.date(2020, 2, 29)]["return_1m"] == pytest.approx(0.0)
    assert rows[dt.date(2020, 3, 31)]["return_1m"] == pytest.approx(0.2)
    assert rows[dt.date(2020, 3, 31)]["return_2m"] == pytest.approx(0.2)


def test_round6_matches_numpy_away_from_ties(spark):
    import numpy as np

    rnd = __import__("random").Random(7)
    vals = [rnd.uniform(-1e4, 1e4) for _ in range(500)] + [5e-7 + 1e-9, 0.1234567, -3.9999994]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(price.round6("x")).collect()]
    assert got == [float(np.round(v, 6)) for v in vals]


def test_round6_half_way_values_round_half_even(spark):
    # values within 1e-12 of a half-way point are snapped first, so a sum
    # computed in any order rounds the same way
    vals = [5e-7, 2.5e-6, 1.0000005, 0.0706055, 0.07060549999999999, 0.07060550000000001]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    got = [r[0] for r in df.select(price.round6("x")).collect()]
    assert got == [0.0, 2e-6, 1.0, 0.070606, 0.070606, 0.070606]


def test_flagship_runs_and_plan_has_one_exchange_for_windows(spark):
    from bourse.sources import tables as src

    df = price.price_features(src.bars(spark, "/root/testdata/sf0.001"))
    assert df.count() > 0
    plan = df._jdf.queryExecution().executedPlan().toString()
    # bars aggregation exchange + one exchange by ticker for all windows
    import re

    assert len(re.findall(r"Exchange hashpartitioning\(ticker#\d+, \d+\)", plan)) == 1
    _ = F


def test_adjusted_close_preferred(spark):
    rows = [("A", dt.date(2020, 1, 1), 1.0, 2.0, 0.5, 1.5, 10.0, 1.4)]
    df = spark.createDataFrame(rows, SCHEMA + ", adj_close double")
    out = price.choose_close(df).first()
    assert out["close"] == 1.4 and "adj_close" not in price.choose_close(df).columns
    plain = spark.createDataFrame([r[:-1] for r in rows], SCHEMA)
    assert price.choose_close(plain).first()["close"] == 1.5
