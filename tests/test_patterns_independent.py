"""The 61 patterns against SQL written apart from them, on bars of a coarse
grid on which every pattern fires (but mat-hold, which cannot at penetration 0)."""

import duckdb
import numpy as np
import pandas as pd
import pytest

from bourse.plans import candles
from bourse.plans import patterns as pat
from bourse.plans import price
from bourse.sql import patterns as sql

TICKERS, BARS = 60, 4000


def series(rng):
    """Bodies, shadows and gaps of a few sizes, opens near the last close, the
    last open or between them: thresholds are met exactly as often as passed."""
    size = rng.choice([0, 1, 2, 4, 8, 14, 20], BARS, p=[.08, .12, .14, .2, .2, .16, .1]) * rng.choice([-1, 1], BARS)
    gap = rng.choice([-16, -8, -4, -2, -1, 0, 0, 1, 2, 4, 8, 16], BARS)
    mode = rng.choice(3, BARS, p=[.4, .3, .3])
    o, c = np.zeros(BARS), np.zeros(BARS)
    last_open = last_close = 1000.0
    for i in range(BARS):
        o[i] = (last_close, last_open, (last_open + last_close) / 2)[mode[i]] + gap[i]
        c[i] = o[i] + size[i]
        last_open, last_close = o[i], c[i]
    up, low = (rng.choice([0, 0, 1, 2, 4, 10, 24], BARS) for _ in range(2))
    return o, np.maximum(o, c) + up, np.minimum(o, c) - low, c


@pytest.fixture(scope="module")
def both(spark, tmp_path_factory):
    rng = np.random.default_rng(0)
    days = pd.date_range("1990-01-01", periods=BARS).date
    frames = []
    for t in range(TICKERS):
        o, h, l, c = series(rng)
        frames.append(pd.DataFrame({"ticker": f"t{t:02d}", "date": days, "open": o, "high": h, "low": l, "close": c, "volume": 1.0}))
    path = str(tmp_path_factory.mktemp("bars") / "bars.parquet")
    pd.concat(frames).to_parquet(path)
    want = duckdb.sql(f"SELECT * FROM ({sql.patterns_daily_sql(source=f'SELECT * FROM read_parquet({path!r})')}) ORDER BY ticker, date").df()
    out = str(tmp_path_factory.mktemp("bars") / "patterns")
    pat.patterns_daily(price.by_ticker(spark.read.parquet(path))).write.parquet(out)
    got = duckdb.sql(f"SELECT * FROM read_parquet('{out}/*.parquet') ORDER BY ticker, date").df()
    return got, want


def test_same_columns():
    assert set(sql.COLUMNS) == set(candles.PATTERN_COLUMNS)


@pytest.mark.parametrize("name", candles.PATTERN_COLUMNS)
def test_pattern_fires_where_the_specification_says(both, name):
    got, want = both
    assert len(got) == len(want) == TICKERS * BARS
    assert (got["ticker"] == want["ticker"]).all()
    assert (got[name].to_numpy() == want[name].to_numpy()).all()
    fired = int((want[name] != 0).sum())
    assert fired == 0 if name == "cdlmathold" else 0 < fired < len(want)


@pytest.mark.parametrize("name", ["cdl2crows", "cdl3starsinsouth", "cdlbreakaway", "cdlupsidegap2crows"])
def test_patterns_that_never_fire_on_the_given_tables_fire_here(both, name):
    assert (both[0][name] != 0).sum() >= 5
