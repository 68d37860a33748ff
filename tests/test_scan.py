"""A1 affine scan vs a sequential loop, and its guards."""

import math
import random

import pytest
from pyspark.sql import functions as F

from bourse.operators.scan import CHUNK, Scan, affine_scans, ema, wilder_mean, wilder_sum


def _sequential(xs, a, b, seed_row, n, seed_kind):
    out = [None] * len(xs)
    if len(xs) <= seed_row:
        return out
    window = xs[seed_row - n + 1: seed_row + 1]
    y = sum(window) / n if seed_kind == "avg" else sum(window)
    out[seed_row] = y
    for t in range(seed_row + 1, len(xs)):
        y = a * y + b * xs[t]
        out[t] = y
    return out


@pytest.mark.parametrize("length", [1, 20, CHUNK - 1, CHUNK, CHUNK + 1, 2 * CHUNK + 37])
def test_scan_matches_loop_across_chunks(spark, length):
    rnd = random.Random(length)
    xs = [100 + rnd.uniform(-5, 5) for _ in range(length)]
    rows = [("T", i, x) for i, x in enumerate(xs)]
    df = spark.createDataFrame(rows, "ticker string, rn int, x double")
    scans = [ema("x", "e12", 12, seed_row=25), wilder_mean("x", "wm", 14, 14), wilder_sum("x", "ws", 14, 13)]
    got = {r["rn"]: r for r in affine_scans(df, scans).collect()}
    for s in scans:
        want = _sequential(xs, s.a, s.b, s.seed_row, s.n, s.seed)
        for i in range(length):
            g, w = got[i][s.out], want[i]
            if w is None:
                assert g is None
            else:
                assert math.isclose(g, w, rel_tol=1e-12), (s.out, i, g, w)


def test_two_keys_do_not_mix(spark):
    rows = [("A", i, float(i)) for i in range(40)] + [("B", i, 1000.0 - i) for i in range(40)]
    df = spark.createDataFrame(rows, "ticker string, rn int, x double")
    out = {(r["ticker"], r["rn"]): r["e"] for r in affine_scans(df, [ema("x", "e", 5)]).collect()}
    assert out[("A", 4)] == pytest.approx(2.0)
    assert out[("B", 4)] == pytest.approx(998.0)


def test_guard_rejects_slow_decay():
    with pytest.raises(ValueError):
        Scan("x", "y", 0.9999, 0.0001, 10, 10)


def test_no_python_udf_in_plan(spark):
    df = spark.createDataFrame([("T", i, float(i)) for i in range(50)], "ticker string, rn int, x double")
    plan = affine_scans(df, [ema("x", "e", 5)])._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    _ = F
