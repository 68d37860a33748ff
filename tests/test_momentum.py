"""Momentum properties and flat-price conventions."""

import datetime as dt

import pytest

from bourse.plans import momentum as mom
from bourse.plans.price import by_ticker
from bourse.sources import tables as src

SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume double"


@pytest.fixture(scope="module")
def daily(spark):
    return mom.momentum_daily(by_ticker(src.bars(spark, "/root/testdata/sf0.001"))).cache()


def test_properties(daily):
    rows = daily.collect()
    assert rows
    for r in rows:
        if r["aroonosc"] is not None:
            assert r["aroonosc"] == pytest.approx(r["aroon_2"] - r["aroon_1"], abs=1e-9)
        if r["macdhist"] is not None:
            assert r["macdhist"] == pytest.approx(r["macd"] - r["macdsignal"], abs=1e-9)
        if r["rocr100"] is not None:
            assert r["rocr100"] == pytest.approx(100 * r["rocr"], rel=1e-12)
            assert r["rocr100"] == pytest.approx(100 + r["roc"], rel=1e-9)
        if r["rsi"] is not None:
            assert 0 <= r["rsi"] <= 100


def test_warmup_rows_are_null(daily):
    first = {}
    for r in sorted(daily.collect(), key=lambda r: (r["ticker"], r["date"])):
        first.setdefault(r["ticker"], []).append(r)
    for rows in first.values():
        for name, lb in mom.LOOKBACK.items():
            if len(rows) > lb:
                assert rows[lb - 1][name] is None if lb > 0 else True
                assert rows[lb][name] is not None, name


def test_flat_prices_zero_denominators(spark):
    d0 = dt.date(2021, 1, 1)
    rows = [("F", d0 + dt.timedelta(days=i), 10.0, 10.0, 10.0, 10.0, 1.0) for i in range(40)]
    out = mom.momentum_daily(spark.createDataFrame(rows, SCHEMA)).orderBy("date").collect()[-1]
    for name in ("bop", "cci", "rsi", "cmo", "fastk", "slowk", "willr", "dx", "plus_di"):
        assert out[name] == 0.0, name
    assert out["mom"] == 0.0 and out["rocr"] == 1.0


def test_short_series_all_null(spark):
    d0 = dt.date(2021, 1, 1)
    rows = [("S", d0 + dt.timedelta(days=i), 10.0 + i, 11.0 + i, 9.0 + i, 10.5 + i, 1.0) for i in range(13)]
    out = mom.momentum_daily(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r["rsi"] is None and r["adx"] is None and r["trix"] is None for r in out)


def _walk(n, start=0):
    rows, c = [], 100.0
    for i in range(n):
        c += ((i * 7919) % 13 - 6) / 4
        rows.append(["N", dt.date(2021, 1, 1) + dt.timedelta(days=start + i), c - 0.5, c + 1.0, c - 1.5, c, 1.0])
    return rows


def test_leading_null_shifts_the_start_and_a_null_inside_ends_the_series(spark):
    clean = [r.asDict() for r in mom.momentum_daily(spark.createDataFrame(_walk(120), SCHEMA)).orderBy("date").collect()]
    late = _walk(120, start=3)
    lead = [["N", dt.date(2021, 1, 1) + dt.timedelta(days=i), None, None, None, None, None] for i in range(3)]
    shifted = [r.asDict() for r in mom.momentum_daily(spark.createDataFrame(lead + late, SCHEMA)).orderBy("date").collect()]
    holed = _walk(120)
    holed[60][5] = None
    broken = [r.asDict() for r in mom.momentum_daily(spark.createDataFrame(holed, SCHEMA)).orderBy("date").collect()]
    for name in ("macd", "rsi", "apo", "roc", "trix", "bop"):  # scans, a simple mean, a lag, one bar
        assert all(r[name] is None for r in shifted[:3])
        assert [r[name] for r in shifted[3:]] == [r[name] for r in clean]
        assert [r[name] for r in broken[:60]] == [r[name] for r in clean[:60]]
        assert all(r[name] is None for r in broken[60:])
