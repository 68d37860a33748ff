"""Operator 13 against numpy's eigenvectors and Python integers."""

import collections

import numpy as np
import pytest

from bourse.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, label int, i int, n string, whitened double"


def brute(rows, count=8):
    x = np.floor(1024 * np.array([v for _, v in rows], np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(0)
    z = x - s / n
    cov = z.T @ z / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:count]
    dev = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return n, dev, z @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(cov)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], 1, 2, "x", 0.5) for i, v in rows], SCHEMA).repartition(4)


def check(got, rows, count=8):
    n, dev, white, share = brute(rows, count)
    by = collections.defaultdict(dict)
    for r in got:
        by[r.component][r.vec_id] = r
    assert sorted(by) == list(range(1, white.shape[1] + 1))
    for c, found in by.items():
        assert sorted(found) == sorted(i for i, _ in rows)
        mine = np.array([found[i].whitened for i, _ in rows])
        theirs = white[:, c - 1]
        np.testing.assert_allclose(mine * np.sign(mine @ theirs), theirs, rtol=1e-7, atol=1e-8)
        assert [found[i].deviation for i, _ in rows] == dev
        assert {found[i].n for i, _ in rows} == {n}
        assert all(abs(found[i].explained / share[c - 1] - 1) < 1e-9 for i, _ in rows)
        assert all(found[i].identity_error < 1e-8 for i, _ in rows)


def test_equals_numpy(spark):
    rnd = np.random.default_rng(1)
    x = (rnd.normal(size=(300, 12)) * np.linspace(0.2, 3, 12)).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x)]
    awkward = [(1000, None), (1001, []), (1002, [None] * 12), (1003, [float("nan")] * 12), (1004, [float("inf")] + [0] * 11), (1005, [1, 2, 3])]
    check(whitening.whiten(frame(spark, rows + awkward)).collect(), rows)


def test_large_entries_are_exact(spark):
    rnd = np.random.default_rng(2)
    x = (rnd.normal(size=(50, 9)) * 1e5).astype(np.float32)
    rows = [(i, v) for i, v in enumerate(x)]
    got = whitening.transform(*(lambda r, d: (r, whitening.fit(r, d)))(*whitening.usable(frame(spark, rows)))).collect()
    assert {r.vec_id: int(r.deviation) for r in got} == dict(zip(range(50), brute(rows)[1]))
    y = np.array([[1 << 45, -(1 << 45), 5], [-(1 << 52) + 1, 3, -(1 << 19)]])
    parts = whitening._limbs(y)
    assert (sum(p.astype(np.int64).astype(object) << (20 * i) for i, p in enumerate(parts)) == y).all()
    assert max(np.abs(p).max() for p in parts) <= 1 << 19


def test_low_rank_ties_and_small_tables(spark):
    rnd = np.random.default_rng(3)
    base = rnd.integers(-50, 50, size=(2, 10))
    rows = [(i, (rnd.integers(-9, 9, size=2) @ base).astype(float)) for i in range(60)]
    got = whitening.whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and len(got) == 120
    check(got, rows, 2)
    same = [(7, [1.0, 2.0]), (7, [1.0, 2.0]), (None, [1.0, 2.0])]
    assert whitening.whiten(frame(spark, same)).collect() == []
    assert whitening.whiten(frame(spark, same[:1])).collect() == []
    empty = whitening.whiten(frame(spark, []))
    assert empty.collect() == [] and empty.columns[:2] == ["vec_id", "component"]
    lost = frame(spark, [(None, [1.0, 0.0]), (4, [3.0, 1.0]), (4, [2.0, 5.0])])
    assert len(whitening.whiten(lost).collect()) == 6


@pytest.mark.parametrize("d", [1, 2, 7, 32])
def test_factor_and_rotation(d):
    a = np.random.default_rng(d).normal(size=(d, 2 * d))
    a = a @ a.T
    low = whitening.pivoted_cholesky(a)
    np.testing.assert_allclose(low @ low.T, a, atol=1e-10 * np.abs(a).max())
    turned = whitening.jacobi(low)
    np.testing.assert_allclose(turned @ turned.T, a, atol=1e-10 * np.abs(a).max())
    np.testing.assert_allclose(np.sort((turned ** 2).sum(0)), np.linalg.eigvalsh(a), rtol=1e-10)
