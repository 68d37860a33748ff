"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided
Jacobi on the triangular factor.

An entry c counts as the integer x = floor(1024 * c) + 100000, so every sum is
exact and does not depend on how Spark deals out the rows:

* One pass adds n and the sums S.  With k = floor(S / n) the rest T = S - n * k
  lies in [0, n).
* A second pass adds the scatter Q of y = x - k, one d x d matrix per task,
  added up by Spark.  The covariance (n * Q - T * T') / n^2 is rounded once; y
  is centred to less than one unit before it is multiplied.  Products of 20-bit
  limbs in blocks of ``BLOCK`` rows stay below 2^53, so matrix products in
  doubles are exact.
* The driver holds d x d numbers: V = L L' by Cholesky with diagonal pivoting,
  then the columns of L are rotated in pairs until they are orthogonal.  Their
  squared norms are the eigenvalues of V, the normalised columns its
  eigenvectors.
* A third pass projects (x - S / n) on the components.  The covariance of what
  it wrote is measured and compared with the identity.

Defined results: rows whose vector is null, empty, holds null or non-finite
entries or entries beyond 2^50, or has another length than most (ties: the
shorter) take no part; a null vec_id is a row like any other; repeated rows
count as often as they stand; directions without variance (eigenvalue at
most d * 2^-52 of the largest) are no components, so equal vectors, one row or
an empty table give no rows; other columns are not read.
"""

from __future__ import annotations

import decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
BOUND = float(1 << 50)
BLOCK = 4096     # rows of one exact matrix product
LIMB = 20        # bits: 2^20 * 2^20 * BLOCK = 2^52
SWEEPS = 60


class Whitener(NamedTuple):
    n: int
    sums: list[int]           # S, exact
    trace: float              # of the covariance
    eigenvalues: np.ndarray   # falling
    components: np.ndarray    # one column each


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id long, v array<double>) of the rows that take part, and their
    length (0: there are none)."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    rows = rows.where(F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < BOUND)))
    most = rows.groupBy(F.size("v").alias("d")).count().where("d > 0").orderBy(F.desc("count"), "d").limit(1).collect()
    d = most[0]["d"] if most else 0
    return rows.where((F.size("v") == d) & (F.size("v") > 0)), d


def _integers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    flat = np.asarray(batch.column("v").flatten(), np.float64)
    return np.floor(flat * SCALE).astype(np.int64).reshape(-1, d) + SHIFT


def _sums(d: int):
    def run(batches):
        n, high, low = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _integers(batch, d)
            n += len(x)
            high += (x >> 31).sum(0)
            low += (x & 0x7FFFFFFF).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([high.tolist()], pa.list_(pa.int64())), pa.array([low.tolist()], pa.list_(pa.int64()))],
                                         names=["n", "high", "low"])
    return run


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as doubles l0 + l1 * 2^20 + ..., each of at most 20 bits."""
    out, half = [], 1 << (LIMB - 1)
    while True:
        low = ((y + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        y = (y - low) >> LIMB
        if not y.any():
            return out


def _scatter(center: list[int]):
    def run(batches):
        d = len(center)
        k = np.array(center, np.int64)
        sums: dict[int, np.ndarray] = {}  # power of two -> exact matrix
        held: dict[int, np.ndarray] = {}
        blocks = 0

        def flush():
            for bits, m in held.items():
                sums[bits] = sums.get(bits, 0) + m.astype(object)
            held.clear()

        for batch in batches:
            y = _integers(batch, d) - k
            for a in range(0, len(y), BLOCK):
                parts = _limbs(y[a:a + BLOCK])
                for i, p in enumerate(parts):
                    for j in range(i, len(parts)):
                        m = (p.T @ parts[j]).astype(np.int64)
                        bits = LIMB * (i + j)
                        held[bits] = held.get(bits, 0) + (m if i == j else m + m.T)
                blocks += 1
                if blocks % 256 == 0:
                    flush()
        flush()
        total = sum((m * (1 << bits) for bits, m in sums.items()), np.zeros((d, d), object))
        at = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()),
             pa.array([decimal.Decimal(int(v)) for v in total[at]], pa.decimal128(38, 0))], names=["i", "j", "q"])
    return run


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L (d x rank) with a = L L'; rows in the order of ``a``, each column is
    the pivot with the largest variance that is left."""
    d = len(a)
    left, out = a.diagonal().copy(), np.zeros((d, d))
    floor = d * np.finfo(float).eps * max(left.max(initial=0.0), 0.0)
    free = np.ones(d, bool)
    for r in range(d):
        p = int(np.argmax(np.where(free, left, -np.inf)))
        if left[p] <= floor:
            return out[:, :r]
        root = np.sqrt(left[p])
        col = np.where(free, (a[:, p] - out[:, :r] @ out[p, :r]) / root, 0.0)
        col[p] = root
        out[:, r] = col
        free[p] = False
        left -= col * col
    return out


def jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of ``factor`` rotated until all are orthogonal (to
    rounding).  A round rotates disjoint pairs; a sweep meets every pair."""
    x = factor.copy()
    r = x.shape[1]
    ring = list(range(r + r % 2))
    tol = np.finfo(float).eps * np.sqrt(max(len(x), 1))
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            pairs = [(p, q) for p, q in zip(ring[:len(ring) // 2], reversed(ring[len(ring) // 2:])) if p < r and q < r]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            p, q = map(np.array, zip(*pairs))
            a, b = x[:, p], x[:, q]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            cosine = np.abs(ab) / np.maximum(np.sqrt(aa * bb), np.finfo(float).tiny)
            worst = max(worst, cosine.max())
            zeta = (bb - aa) / np.where(ab == 0, 1.0, 2 * ab)
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(cosine <= tol, 0.0, t)
            c = 1 / np.hypot(1.0, t)
            x[:, p], x[:, q] = c * a - c * t * b, c * t * a + c * b
        if worst <= tol:
            return x
    raise ArithmeticError(f"columns still at a cosine of {worst} after {SWEEPS} sweeps")


def fit(rows: DataFrame, d: int) -> Whitener | None:
    """The whitener of all ``rows``; None without rows."""
    if not d:
        return None
    per_task = written(rows.mapInArrow(_sums(d), "n long, high array<long>, low array<long>"), "sums")
    n = per_task.agg(F.sum("n")).first()[0] or 0
    if not n:
        return None
    wide = per_task.select(F.posexplode(F.arrays_zip("high", "low")).alias("i", "s")).groupBy("i").agg(
        *[F.sum(F.col(f"s.{c}").cast("decimal(38,0)")).alias(c) for c in ("high", "low")])
    sums = [int(r["high"]) * (1 << 31) + int(r["low"]) for r in wide.orderBy("i").collect()]
    center = [s // n for s in sums]
    rest = [s - n * k for s, k in zip(sums, center)]
    pairs = rows.mapInArrow(_scatter(center), "i int, j int, q decimal(38,0)").groupBy("i", "j").agg(F.sum("q").alias("q"))
    cov = np.zeros((d, d))
    for i, j, q in pairs.collect():  # d * (d + 1) / 2 numbers
        cov[i, j] = cov[j, i] = (n * int(q) - rest[i] * rest[j]) / (n * n)
    turned = jacobi(pivoted_cholesky(cov))
    values = (turned * turned).sum(0)
    order = [i for i in np.argsort(-values, kind="stable") if values[i] > d * np.finfo(float).eps * values.max()]
    components = turned[:, order] / np.sqrt(values[order])
    for c in components.T:  # one sign for all rows
        c *= np.sign(c[np.argmax(np.abs(c))])
    return Whitener(n, sums, float(np.trace(cov)), values[order], components)


def _project(model: Whitener, count: int):
    def run(batches):
        n, d = model.n, len(model.sums)
        center = np.array([s // n for s in model.sums], np.int64)
        rest = np.array([s % n for s in model.sums], np.int64)
        turn = model.components[:, :count] / np.sqrt(model.eigenvalues[:count])
        for batch in batches:
            y = _integers(batch, d) - center
            most = int(np.abs(y).max(initial=0))
            if d * (n * (most + 1)) ** 2 < 1 << 63:
                u = n * y - rest
                off = [decimal.Decimal(int(v)) for v in (u * u).sum(1)]
            else:
                off = [decimal.Decimal(sum((n * v - t) ** 2 for v, t in zip(row, rest.tolist()))) for row in y.tolist()]
            w = (y - rest / n) @ turn
            at = np.arange(0, w.size + 1, count, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(off, pa.decimal128(38, 0)), pa.ListArray.from_arrays(pa.array(at), pa.array(w.reshape(-1)))],
                names=["vec_id", "deviation", "whitened"])
    return run


def transform(rows: DataFrame, model: Whitener, count: int = COMPONENTS) -> DataFrame:
    """(vec_id, deviation decimal, whitened array<double>) of all rows: the
    sum of (n * x - S)^2 and the coordinates on the first ``count``
    components."""
    return rows.mapInArrow(_project(model, min(count, len(model.eigenvalues))), "vec_id long, deviation decimal(38,0), whitened array<double>")


def identity_error(done: DataFrame, count: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the
    identity, centred before multiplying."""
    w = [F.col("whitened")[i] for i in range(count)]
    means = done.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(w)]).first()
    z = [x - F.lit(float(m)) for x, m in zip(w, means)]
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    cov = done.agg(*[F.avg(z[i] * z[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(vectors: DataFrame, count: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component (from 1), as in ``OUT``.  A deviation
    that no long can hold is null; ``transform`` gives it in full."""
    rows, d = usable(vectors, id_col, vec_col)
    model = fit(rows, d)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], OUT)
    count = min(count, len(model.eigenvalues))
    done = written(transform(rows, model, count), "whitened")
    error = identity_error(done, count)
    share = F.array(*[F.lit(float(e) / model.trace) for e in model.eigenvalues[:count]])
    return done.select("vec_id", F.col("deviation").try_cast("long").alias("deviation"), F.posexplode("whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("i") + 1).alias("explained"), F.lit(float(error)).alias("identity_error"))
