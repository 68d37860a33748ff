"""Imputation, one-hot, features and session settings."""

import datetime as dt

import pytest

from bourse.plans import dataset as ds
from bourse.session import PLAN_CONF, tune
from bourse.sources import tables as src

SF = "/root/testdata/sf0.001"


def months(spark):
    rows, d0 = [], dt.date(2020, 1, 31)
    for t, (sector, peg, env) in {"A": ("S", 1.0, None), "B": ("S", None, 4.0), "C": ("S", 3.0, 8.0), "D": ("T", 9.0, None)}.items():
        for m in range(1 + ord(t) % 3):
            rows.append((t, d0 + dt.timedelta(days=31 * m), sector, "I", "X", peg, env, None))
    return spark.createDataFrame(rows, "ticker string, date date, sector string, industry string, country string, trailing_peg double, "
                                       "esg_env double, dividend_yield double")


def test_fill_equals_medians_over_the_months(spark):
    df = months(spark)
    got = {(r.ticker, r.date): r for r in ds.fill(df).collect()}
    want = df.fillna({"dividend_yield": 0.0})
    for col, group in (("trailing_peg", "industry"), ("esg_env", "sector"), ("esg_env", "industry"), ("esg_env", "country")):
        want = ds.group_median_fill(want, col, group)
    assert len(got) == want.count()
    for r in want.collect():
        g = got[r.ticker, r.date]
        assert (g.trailing_peg, g.esg_env, g.dividend_yield) == (r.trailing_peg, r.esg_env, r.dividend_yield)


def test_what_is_left_raises_and_dropping_is_explicit(spark):
    df = months(spark).selectExpr("*", "CAST(NULL AS DOUBLE) AS beta")
    with pytest.raises(ds.MissingValuesError, match="beta"):
        ds.impute(df)
    out, gone = ds.impute_dropping(df)
    assert gone == ["beta"] and "beta" not in out.columns
    with pytest.raises(ds.MissingValuesError):
        ds.preprocess(df.selectExpr("*", "1.0D AS close", "2.0D AS target", "1 AS month"))


def test_fill_reads_its_input_twice_whatever_the_steps(spark, tmp_path):
    path = str(tmp_path / "months")
    months(spark).write.parquet(path)
    plan = ds.fill(spark.read.parquet(path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") <= 1  # the other scan went into the per-ticker table


def test_one_hot_levels(spark):
    df = months(spark)
    out = ds.one_hot(df)
    assert {"ticker_index", "sector_T"} <= set(out.columns) and "ticker" not in out.columns
    assert {r.ticker_index for r in out.select("ticker_index").collect()} == {0, 1, 2, 3}
    with pytest.raises(ds.LevelLimitError):
        ds.one_hot(df, ["sector"], max_levels=1)
    vec = ds.sparse_block(out)
    sizes = {(r.ticker_index, r.ticker_index_vector.size, tuple(r.ticker_index_vector.indices)) for r in vec.collect()}
    assert {s for _, s, _ in sizes} == {3} and (0, 3, ()) in sizes


def test_features_leave_label_and_split_out(spark):
    df = spark.createDataFrame([(1, 2.0, 0, "train", 5)], f"ticker_index int, close double, {ds.LABEL} int, split string, n int")
    r = ds.features(df).first()
    assert r.features == [2.0, 5.0] and r.label == 0 and r.split == "train"


def test_callers_session_is_left_alone(spark):
    key = next(iter(PLAN_CONF))
    other = spark.newSession()
    before = other.conf.get(key)
    tuned = tune(other)
    assert tuned.conf.get(key) == PLAN_CONF[key] and other.conf.get(key) == before


def test_bars_hash_and_check_their_order_key(spark):
    plan = src.bars(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_split_of_nothing(spark):
    assert ds.temporal_split(months(spark).limit(0)).collect() == []
