"""Evaluation goldens (the reference's saved report) and dataset helpers."""

import datetime as dt

import pytest

from bourse.plans import dataset as ds
from bourse.plans import evaluate as ev


def _preds(spark, tn, fp, fn, tp):
    rows = [(0, 0)] * tn + [(0, 1)] * fp + [(1, 0)] * fn + [(1, 1)] * tp
    return spark.createDataFrame(rows, "label int, prediction int")


def test_report_golden(spark):
    p = _preds(spark, 125, 1, 85, 5)
    cm = {(r["label"], r["prediction"]): r["count"] for r in ev.confusion_matrix(p).collect()}
    assert cm == {(0, 0): 125, (0, 1): 1, (1, 0): 85, (1, 1): 5}
    rep = {r["class"]: r for r in ev.classification_report(p).collect()}
    assert rep["accuracy"]["precision"] == pytest.approx(0.6019, abs=1e-4)
    assert rep["1"]["precision"] == pytest.approx(0.8333, abs=1e-4)
    assert rep["1"]["recall"] == pytest.approx(0.0556, abs=1e-4)
    assert rep["1"]["f1_score"] == pytest.approx(0.1042, abs=1e-4)
    h = ev.headline(p).first()
    assert (h["accuracy"], h["precision_1"]) == (0.602, 0.833)
    assert sum(cm.values()) == p.count()


def test_zero_division_is_zero(spark):
    rep = {r["class"]: r for r in ev.classification_report(_preds(spark, 10, 0, 3, 0)).collect()}
    assert rep["1"]["precision"] == 0.0 and rep["1"]["f1_score"] == 0.0


def test_best_model_first_max_wins(spark):
    m = spark.createDataFrame([("a", 0, 0.5), ("b", 1, 0.7), ("c", 2, 0.7)], "model string, model_order int, metric double")
    assert ev.best_model(m).first()["model"] == "b"


def test_temporal_split_boundaries(spark):
    d0 = dt.date(2020, 1, 1)
    df = spark.createDataFrame([(d0 + dt.timedelta(days=i),) for i in range(101)], "date date")
    out = {r["date"]: r["split"] for r in ds.temporal_split(df).collect()}
    assert out[d0 + dt.timedelta(days=70)] == "train"
    assert out[d0 + dt.timedelta(days=71)] == "validation"
    assert out[d0 + dt.timedelta(days=85)] == "validation"
    assert out[d0 + dt.timedelta(days=86)] == "test"


def test_group_fill_leaves_null_keys(spark):
    df = spark.createDataFrame(
        [("a", "X", None), ("b", "X", 2.0), ("c", "X", 4.0), ("d", None, None)],
        "ticker string, industry string, trailing_peg double",
    )
    out = {r["ticker"]: r["trailing_peg"] for r in ds.group_median_fill(df, "trailing_peg", "industry").collect()}
    assert out == {"a": 3.0, "b": 2.0, "c": 4.0, "d": None}


def test_one_hot_drops_first_sorted_level(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), ("c", "x"), (None, None)], "ticker string, sector string")
    out = ds.one_hot(df, ["ticker", "sector"])
    assert sorted(out.columns) == ["sector_y", "ticker_index"]
    # levels are numbered in sorted order, a null has no number and no indicator
    assert sorted(map(tuple, out.select("ticker_index", "sector_y").fillna(-1).collect())) == [(-1, 0), (0, 1), (1, 0), (2, 0)]
    dense = ds.one_hot(df, ["ticker"], sparse=())
    assert sorted(dense.columns) == ["sector", "ticker_b", "ticker_c"]
    assert sorted(tuple(r) for r in dense.select("ticker_b", "ticker_c").collect()) == [(0, 0), (0, 0), (0, 1), (1, 0)]
    with pytest.raises(ds.LevelLimitError):
        ds.one_hot(df, ["ticker"], sparse=(), max_levels=2)


def test_cardinality_check_raises(spark):
    left = spark.createDataFrame([("a", 1)], "ticker string, x int")
    right = spark.createDataFrame([("a", 1), ("a", 2)], "ticker string, y int")
    with pytest.raises(ds.CardinalityError):
        ds.left_join_many_to_one(left, right, ["ticker"])
