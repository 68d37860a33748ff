"""G18 by distributed selection, S12 rejected rows, bucketed bars, J05 at once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourse.operators import quantiles as qt
from bourse.plans import dataset as ds
from bourse.plans import price
from bourse.plans import profile as pf
from bourse.sources import io as sio

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]


def test_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(4)
    rows = [(g, float(np.round(rng.normal(), 1)) if rng.random() > 0.1 else None) for g in ["a", "b", None] for _ in range(400)]
    rows += [("one", 5.0), ("two", 1.0), ("two", 2.0), ("empty", None)]
    df = spark.createDataFrame(rows, "k string, x double").repartition(4)
    got = {r.k: r.q for r in qt.group_quantiles(df, "x", "k", PROBS, parts=5).collect()}
    for g in ("a", "b", None, "one", "two"):
        values = [x for k, x in rows if k == g and x is not None]
        assert got[g] == pytest.approx(np.quantile(values, PROBS))
    assert set(got) == {"a", "b", None, "one", "two"}
    five = {r.k: tuple(r)[1:] for r in pf.five_numbers(df, "x", "k").collect()}
    assert five["two"] == (1.0, 1.25, 1.5, 1.75, 2.0)
    assert qt.group_quantiles(df.where("k = 'none'"), "x", "k", PROBS).collect() == []


def test_weighted_quantiles(spark):
    rows = [("a", 1.0, 3), ("a", 2.0, 1), ("a", 9.0, 2), ("b", 4.0, 1)]
    df = spark.createDataFrame(rows, "k string, x double, n long")
    got = {r.k: r.q for r in qt.group_quantiles(df, "x", "k", [0.5, 0.9], weight="n").collect()}
    assert got["a"] == pytest.approx(np.quantile([1, 1, 1, 2, 9, 9], [0.5, 0.9])) and got["b"] == [4.0, 4.0]


def test_one_label_on_a_million_values_is_split(spark):
    df = spark.range(1_000_000).select(F.lit(1).alias("label"), ((F.col("id") * 7919) % 1_000_003).cast("double").alias("x"))
    slices = qt._slices(df, "label", "x", None, 16).groupBy("g", "part").agg(F.sum("rows").alias("n")).collect()
    assert len(slices) >= 8 and max(r.n for r in slices) < 250_000
    want = np.quantile((np.arange(1_000_000) * 7919) % 1_000_003, PROBS)
    assert qt.group_quantiles(df, "x", "label", PROBS, parts=16).first().q == pytest.approx(want)
    plan = qt.group_quantiles(df, "x", "label", PROBS, parts=16)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "collect_set" not in plan


def test_rejected_rows(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b,c\n1,2.5,x\n2,oops,y\nthree,1.0,z\n4,1.5\n5,1.5,w,extra\n6,,\n\"7\",\"8.5\",\"q, r\"\n")
    schema = "a int, b double, c string"
    rows, rejected = sio.read_csv_rejecting(spark, str(path), schema)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted([(1, 2.5, "x"), (6, None, None), (7, 8.5, "q, r")], key=str)
    assert {r.line: r.reason for r in rejected.collect()} == {
        "2,oops,y": "b: not a double", "three,1.0,z": "a: not a int", "4,1.5": "another number of fields", "5,1.5,w,extra": "another number of fields"}
    with pytest.raises(sio.RejectedRowsError):
        sio.read_csv(spark, str(path), schema)
    with pytest.raises(sio.RejectedRowsError):
        sio.read_csv(spark, str(path), schema, max_rejected=0.5)
    assert sio.read_csv(spark, str(path), schema, max_rejected=0.6).count() == 3


def test_bucketed_bars_need_no_exchange(spark, tmp_path):
    rows = [(t, f"2020-01-{d:02d}", 1.0 + d, 2.0 + d, 0.5 + d, 1.5 + d, 10.0) for t in ("a", "b", "c") for d in range(1, 29)]
    bars = spark.createDataFrame(rows, "ticker string, date string, open double, high double, low double, close double, volume double").withColumn("date", F.to_date("date"))
    stored = sio.write_bucketed(bars, "bars_bucketed_test", 4, str(tmp_path / "bars"))
    from bourse.plans import momentum, patterns
    for df in (price.daily_features(stored), momentum.momentum_daily(stored), patterns.patterns_daily(stored)):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert stored.count() == len(rows)
    assert sorted(map(tuple, price.daily_features(stored).select("ticker", "date", "daily_growth").collect()), key=str) == sorted(
        map(tuple, price.daily_features(price.by_ticker(bars)).select("ticker", "date", "daily_growth").collect()), key=str)
    spark.sql("DROP TABLE bars_bucketed_test")


def test_right_sides_are_checked_at_once(spark):
    one = spark.createDataFrame([("a", 1), ("b", 2)], "ticker string, x int")
    two = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-02-01", 1)], "ticker string, date string, y int")
    bad = spark.createDataFrame([("2020-01-01", 1), ("2020-01-01", 2)], "date string, z int")
    sides = {"one": (one, ["ticker"]), "two": (two, ["ticker", "date"]), "none": (bad.where("z > 5"), ["date"])}
    assert ds.checked_right_sides(sides) == {"one": 2, "two": 2, "none": 0}
    with pytest.raises(ds.CardinalityError, match="macro"):
        ds.checked_right_sides(sides | {"macro": (bad, ["date"])})
    # keys of one table do not meet those of another
    assert ds.checked_right_sides({"x": (one, ["ticker"]), "y": (one, ["ticker"])}) == {"x": 2, "y": 2}
    assert ds.checked_right_sides({}) == {}
