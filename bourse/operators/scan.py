"""A1: affine recurrences y_t = a * y_{t-1} + b * x_t as window functions.

EMA, Wilder's mean and Wilder's running sum are all affine recurrences.  A
recurrence cannot be a single SQL window aggregate, but its closed form can:

    y_t = sum_{k=s..t} a^(t-k) v_k,   v_s = seed,  v_k = b * x_k  (k > s)

``a^(t-k)`` over- / under-flows on long series, so rows are cut into chunks of
``CHUNK`` rows (chunk = rn div CHUNK, i = rn mod CHUNK):

* local_t = a^i * sum_{k <= t in the chunk} a^(-i_k) v_k    (window per chunk)
* carry   = local at the last row of the previous chunk       (window per key)
* y_t     = local_t + carry * a^(i+1)

The carry from two chunks back is multiplied by a^CHUNK, far below double
precision for every decay used here (guarded in ``Scan``).  Everything is a
built-in window expression: no Python runs on the executors, the key's rows
stay in the partition the data is already exchanged into, and scans with
the same stage share one sort per window spec.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 1024


@dataclass(frozen=True)
class Scan:
    """One recurrence: ``out`` = scan of column ``x``.

    ``seed_row`` is the 0-based row (per key) holding the seed; the seed is
    the ``seed`` aggregate ("avg" or "sum") of ``x`` over the ``n`` rows that
    end at ``seed_row``.  Rows before ``seed_row`` are null.
    """

    x: str
    out: str
    a: float
    b: float
    seed_row: int
    n: int
    seed: str = "avg"

    def __post_init__(self):
        if not 0.0 < self.a < 1.0:
            raise ValueError(f"decay {self.a} outside (0, 1)")
        if CHUNK * math.log(self.a) > math.log(1e-17):
            raise ValueError(f"decay {self.a}: a^{CHUNK} does not vanish; use a shorter chunk")
        if -CHUNK * math.log(self.a) > math.log(1e290):
            raise ValueError(f"decay {self.a}: a^-{CHUNK} overflows; use a shorter chunk")


def ema(x: str, out: str, period: int, seed_row: int | None = None, k: float | None = None) -> Scan:
    """Exponential moving average, seeded with the simple mean of the first
    ``period`` values (k = 2 / (period + 1) unless given)."""
    k = 2.0 / (period + 1) if k is None else k
    return Scan(x, out, 1.0 - k, k, period - 1 if seed_row is None else seed_row, period, "avg")


def wilder_mean(x: str, out: str, period: int, seed_row: int) -> Scan:
    """Wilder smoothing: seed = mean of ``period`` values, then
    (prev * (period - 1) + x) / period."""
    return Scan(x, out, (period - 1) / period, 1.0 / period, seed_row, period, "avg")


def wilder_sum(x: str, out: str, period: int, seed_row: int) -> Scan:
    """Wilder running sum: seed = sum of ``period - 1`` values, then
    prev - prev / period + x."""
    return Scan(x, out, (period - 1) / period, 1.0, seed_row, period - 1, "sum")


def chunk_of(rn: str = "rn"):
    return F.floor(F.col(rn) / CHUNK)


def scan_window(key: str = "ticker", rn: str = "rn"):
    """The per-key window the scans use, ordered by (chunk, rn).  Ordering
    by the chunk first is the same row order as by ``rn`` alone, but it is
    also the sort order the per-chunk window needs, so every window of a
    multi-stage plan can share ONE sort: callers that order their own
    windows this way (``_chunk`` column from ``chunk_of``) add no sort."""
    return Window.partitionBy(key).orderBy("_chunk", rn)


def affine_scans(df: DataFrame, scans: list[Scan], key: str = "ticker", rn: str = "rn") -> DataFrame:
    """Add one column per scan.  ``rn`` is the 0-based row number per key."""
    r = F.col(rn)
    if "_chunk" not in df.columns:
        df = df.withColumn("_chunk", chunk_of(rn))
    w = scan_window(key, rn)
    i = r % CHUNK
    df = df.withColumns(
        {
            f"_v_{s.out}": F.when(
                r == s.seed_row,
                (F.avg if s.seed == "avg" else F.sum)(s.x).over(w.rowsBetween(-(s.n - 1), 0)),
            ).when(r > s.seed_row, F.lit(s.b) * F.col(s.x))
            for s in scans
        }
    )
    df = df.withColumn("_i", i)
    wc = Window.partitionBy(key, "_chunk").orderBy(rn).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumns(
        {
            f"_l_{s.out}": F.pow(F.lit(s.a), F.col("_i"))
            * F.sum(F.col(f"_v_{s.out}") * F.pow(F.lit(s.a), -F.col("_i"))).over(wc)
            for s in scans
        }
    )
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns(
        {
            s.out: F.col(f"_l_{s.out}")
            + F.coalesce(
                F.last(F.when(F.col("_i") == CHUNK - 1, F.col(f"_l_{s.out}")), ignorenulls=True).over(before),
                F.lit(0.0),
            )
            * F.pow(F.lit(s.a), F.col("_i") + 1)
            for s in scans
        }
    )
    return df.drop("_i", *[f"_v_{s.out}" for s in scans], *[f"_l_{s.out}" for s in scans])
