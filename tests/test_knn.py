"""Pivot k-NN against brute force, and what it saves."""

import numpy as np
import pyarrow as pa
import pytest

from pyspark.sql import functions as F

from bourse.operators import knn

SCHEMA = "id long, features array<double>, label int, level int, weight double"


def frame(spark, x, label, level=None, weight=None, start=0):
    level = np.zeros(len(x), int) if level is None else level
    weight = np.zeros(len(x)) if weight is None else weight
    rows = [(start + i, v.tolist(), int(l), int(a), float(w)) for i, (v, l, a, w) in enumerate(zip(x, label, level, weight))]
    return knn.rows_of(spark.createDataFrame(rows, SCHEMA).repartition(4), level="level", weight="weight")


def brute(x, y, k, p, level=None, weight=None, level_q=None, weight_q=None):
    out = {}
    for i, q in enumerate(y):
        d = (np.abs(x - q) ** p).sum(1)
        if level is not None:
            d += np.where(level != level_q[i], weight ** p + weight_q[i] ** p, 0)
        d = d ** (1 / p)
        best = np.lexsort((np.arange(len(x)), d))[:k]
        out[i] = [(int(b), float(d[b])) for b in best]
    return out


def check(found, want):
    got = {}
    for r in sorted(found.lists.collect(), key=lambda r: (r.id, r.rank)):
        got.setdefault(r.id, []).append((r.train_id, r.distance))
    assert got.keys() == want.keys()
    for i, rows in want.items():
        assert [a for a, _ in got[i]] == [a for a, _ in rows]
        assert [d for _, d in got[i]] == pytest.approx([d for _, d in rows], rel=1e-9, abs=1e-12)


@pytest.mark.parametrize("p", [1, 2])
def test_equals_brute_force(spark, p):
    rng = np.random.default_rng(p)
    x, y = rng.normal(size=(400, 6)), rng.normal(size=(60, 6)) * 1.5
    x[50:90] = x[10]  # repeated rows: ties go to the smaller id
    y[3] = x[10]
    label = rng.integers(0, 2, 400)
    check(knn.neighbours(frame(spark, x, label), frame(spark, y, np.zeros(60)), 5, p), brute(x, y, 5, p))
    few = knn.neighbours(frame(spark, x[:3], label[:3]), frame(spark, y[:4], np.zeros(4)), 5, p)
    check(few, brute(x[:3], y[:4], 5, p))


def test_clusters_are_pruned_and_cells_are_split(spark, monkeypatch):
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(25, 16)) * 20
    x = centers[rng.integers(0, 25, 4000)] + rng.normal(size=(4000, 16))
    y = centers[rng.integers(0, 25, 200)] + rng.normal(size=(200, 16))
    monkeypatch.setattr(knn, "BLOCK", 50)
    monkeypatch.setattr(knn, "QUERIES", 7)
    found = knn.neighbours(frame(spark, x, np.ones(4000)), frame(spark, y, np.ones(200)), 5, 2)
    check(found, brute(x, y, 5, 2))
    assert found.compared < 0.15 * 4000 * 200


def test_no_pair_join_in_the_plan(spark):
    rng = np.random.default_rng(8)
    cells = frame(spark, rng.normal(size=(80, 3)), np.ones(80)).withColumns({"cell": (F.col("id") % 3).cast("int"), "at": F.lit(0.5)})
    visits = frame(spark, rng.normal(size=(9, 3)), np.ones(9)).drop("label").withColumns({"cell": (F.col("id") % 3).cast("int"), "at": F.lit(0.5), "reach": F.lit(9.0)})
    found = knn._search(cells, visits, np.array([27, 27, 26]), 3, 2)
    assert found.count() == 27
    plan = found._jdf.queryExecution().toString()
    assert "CoGroup" in plan and "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("p", [1, 2])
def test_level_is_the_distance_over_indicators(spark, p):
    rng = np.random.default_rng(9)
    n, m, levels = 200, 30, 5
    x, y = rng.normal(size=(n, 4)), rng.normal(size=(m, 4))
    level, level_q = rng.integers(0, levels, n), rng.integers(0, levels, m)
    scale = np.append(0.0, rng.uniform(0.5, 2, levels - 1))  # level 0 has no column
    hot = lambda v, lv: np.hstack([v, np.eye(levels)[lv] * scale])
    found = knn.neighbours(frame(spark, x, np.ones(n), level, scale[level]), frame(spark, y, np.ones(m), level_q, scale[level_q]), 4, p)
    check(found, brute(hot(x, level), hot(y, level_q), 4, p))


def test_votes(spark):
    lists = spark.createDataFrame([(1, 1, 10, 0.0, 0), (1, 2, 11, 0.5, 1), (1, 3, 12, 0.5, 1), (2, 1, 10, 1.0, 0), (2, 2, 11, 2.0, 1), (2, 3, 12, 4.0, 1)],
                                  "id long, rank int, train_id long, distance double, label int")
    q = spark.createDataFrame([(1, 1), (2, 0), (3, 0)], "id long, label int")
    got = {(w, k): {r.id: (r.prediction, r.probability) for r in knn.vote(lists, q, k, w).collect()} for w in ("uniform", "distance") for k in (1, 2, 3)}
    assert got["uniform", 3] == {1: (1, pytest.approx(2 / 3)), 2: (1, pytest.approx(2 / 3)), 3: (None, None)}
    assert got["uniform", 2] == {1: (0, 0.5), 2: (0, 0.5), 3: (None, None)}  # a tie goes to class 0
    assert got["distance", 3] == {1: (0, 0.0), 2: (0, pytest.approx(0.75 / 1.75)), 3: (None, None)}
    assert got["uniform", 1][2] == (0, 0.0)


def test_invalid_rows_and_empty_tables(spark):
    rows = [(1, [1.0, 2.0], 1), (None, [1.0, 2.0], 1), (2, None, 0), (3, [None, 1.0], 0), (4, [float("nan"), 1.0], 0), (5, [float("inf"), 1.0], 0)]
    df = spark.createDataFrame(rows, "id long, features array<double>, label int")
    valid = knn.rows_of(df)
    assert [r.id for r in valid.collect()] == [1]
    assert knn.neighbours(valid.where("id < 0"), valid).lists.collect() == []
    assert [(r.id, r.train_id) for r in knn.neighbours(valid, valid, 3).lists.collect()] == [(1, 1)]
    with pytest.raises(ValueError):
        knn.neighbours(valid, valid, 3, p=3)


def test_visits_grow_with_blocks_and_not_with_cells(spark, monkeypatch):
    """Independent features, where no bound cuts: a query visits a block once,
    however many cells it has to look at."""
    rng = np.random.default_rng(11)
    x, y = rng.normal(size=(1500, 24)), rng.normal(size=(100, 24))
    monkeypatch.setattr(knn, "BLOCK", 500)
    asked, search = [], knn._search

    def spy(cells, visits, *rest):
        asked.append(visits.count())
        return search(cells, visits, *rest)

    monkeypatch.setattr(knn, "_search", spy)
    for p in (1, 2):
        check(knn.neighbours(frame(spark, x, np.ones(1500)), frame(spark, y, np.ones(100)), 9, p), brute(x, y, 9, p))
    assert len(asked) == 4 and max(asked) <= 100 * 6  # 39 cells of 1,500 rows, at most 6 blocks


@pytest.mark.parametrize("p", [1, 2])
def test_visits_leave_in_bounded_batches(p):
    """One batch of queries that all visit many cells is handed on in parts."""
    rng = np.random.default_rng(12)
    pivots = knn._Pivots(rng.normal(size=(50, 8)), np.zeros(50, int), np.zeros(50))
    count = np.full(50, knn.BLOCK)  # a block each
    blocks = knn._blocks(pivots, p, count)
    n = 4000
    v = pa.FixedSizeListArray.from_arrays(pa.array(rng.normal(size=n * 8)), 8).cast(pa.list_(pa.float64()))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.zeros(n, np.int32)), pa.array(np.zeros(n)), v, pa.array(np.full(n, 1e6))],
                                       names=["id", "level", "weight", "v", "reach"])
    out = list(knn._visits(pivots, p, blocks, count, np.zeros(50), np.full(50, 9.0), 5, False)([batch]))
    assert sum(b.num_rows for b in out) == n * 49 and max(b.num_rows for b in out) <= knn.QUERIES


@pytest.mark.parametrize("p", [1, 2])
@pytest.mark.parametrize("scale", [1.0, 1e-6, 1e6, 1e20])
def test_rows_closer_than_single_precision(spark, p, scale):
    """Distances that differ by less than single precision holds, beside far
    rows, are ordered as in double precision."""
    rng = np.random.default_rng(13)
    x = np.repeat(rng.normal(size=(40, 5)), 20, axis=0) * scale
    x *= 1 + rng.integers(-40, 40, size=x.shape) * 1e-9
    x[::97] *= 1e4
    y = x[rng.choice(len(x), 30)] * (1 + 1e-8)
    got = {}
    for r in sorted(knn.neighbours(frame(spark, x, np.ones(len(x))), frame(spark, y, np.ones(30)), 7, p).lists.collect(), key=lambda r: (r.id, r.rank)):
        got.setdefault(r.id, []).append((r.distance, r.train_id))
    for i, q in enumerate(y):
        d = knn.distance(x, q, p, 0, 0.0, 0, 0.0)
        best = np.lexsort((np.arange(len(x)), d))[:7]
        assert got[i] == [(float(d[b]), int(b)) for b in best]
