"""Series alignment, scans and sinks on small fixtures."""

import datetime as dt

from bourse.plans import series as se
from bourse.sources import io as sio


def test_macro_forward_fill_and_grid(spark):
    rows = [("A", dt.date(2020, 1, 1), 1.0), ("A", dt.date(2020, 4, 1), 4.0),
            ("B", dt.date(2020, 1, 1), 10.0), ("B", dt.date(2020, 2, 1), None), ("B", dt.date(2020, 3, 1), 30.0)]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    out = {r["date"]: (r["a"], r["b"]) for r in se.macro_features(df, {"a": "A", "b": "B"}).collect()}
    assert out == {
        dt.date(2020, 1, 31): (1.0, 10.0), dt.date(2020, 2, 29): (1.0, 10.0),
        dt.date(2020, 3, 31): (1.0, 30.0), dt.date(2020, 4, 30): (4.0, 30.0),
    }


def test_month_end_last_skips_null(spark):
    rows = [("A", dt.date(2020, 1, 2), 1.0), ("A", dt.date(2020, 1, 30), None)]
    df = spark.createDataFrame(rows, "series string, date date, value double")
    out = se.month_end_last(df, {"a": "A"}).collect()
    assert out[0]["a"] == 1.0


def test_market_pivot_equals_join_fold(spark):
    from bourse.sources import tables as src

    m = src.market(spark, "/root/testdata/sf0.001")
    a = sorted(tuple(r) for r in se.market_features(m, se.FIXTURE_MARKET).collect())
    b = sorted(tuple(r) for r in se.market_features_by_joins(m, se.FIXTURE_MARKET).collect())
    assert a == b


def test_scan_bars_range_is_end_exclusive_and_pushed(spark):
    rows = [("X", dt.date(2020, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0) for d in (1, 2, 3)]
    df = spark.createDataFrame(rows, sio.BARS_SCHEMA)
    out = sio.scan_bars(df, ["X"], "2020-01-01", "2020-01-03").collect()
    assert [r["date"].day for r in sorted(out, key=lambda r: r["date"])] == [1, 2]


def test_parquet_scan_pushes_filters(spark, tmp_path):
    rows = [("X", dt.date(2020, 1, d), 1.0, 1.0, 1.0, 1.0, 1.0) for d in (1, 2, 3)]
    path = str(tmp_path / "bars")
    spark.createDataFrame(rows, sio.BARS_SCHEMA).write.parquet(path)
    df = sio.read_bars_parquet(spark, path, ["X", "Y"], "2020-01-02", "2020-01-04").select("ticker", "close")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(date" in plan and "In(ticker" in plan
    assert "ReadSchema: struct<ticker:string,date:date,close:double>" in plan
