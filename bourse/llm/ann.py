"""Approximate nearest neighbours: inverted multi-index.

The two halves of a vector are quantised separately by two small codebooks
(k-means on a bounded sample), so a vector falls into one of ``half`` squared
cells.  A query walks pairs of centroids by rising sum of the two distances
(multi-sequence algorithm, a heap over the two sorted lists) until the cells
hold enough vectors, and the entries of those cells are reranked by the exact
Euclidean distance in double precision.  How many are enough is measured: for
``TRIALS`` sampled queries the true neighbours are found by brute force (one
pass over the index), and the number is the smallest that reaches ``RECALL``
of them (``candidates`` sets it by hand).

Every valid vector is indexed.  Only the k + 1 smallest ids of equal vectors
can be among the k nearest of anything, so a vector that very many rows share
is indexed k + 1 times; equal query vectors are searched once.  A query goes
once to each first-half centroid it visits, with the list of second-half
centroids; the entries of a first-half centroid are split into blocks of
``BLOCK`` entries and ``QUERIES`` queries, so no task holds a crowded one.
To the driver come the samples and the cell counts (half * half numbers).

Defined results: vectors that are null, zero, hold null or non-finite values
or have another length than most take no part, neither as query nor as
candidate; fewer candidates than k are all returned; distance ties go to the
smaller id; repeated ids are candidates of their own unless they equal the
query's id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import written

HALF = 128         # centroids of each half
SAMPLE = 20_000    # vectors that the codebooks are fitted on
TRIALS = 100       # queries that the number of candidates is measured on
RECALL = 0.96
BLOCK = 4_096
QUERIES = 1_024
ROUNDS = 12


def valid(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, v array<double>) of the vectors that take part."""
    v = F.col(vec_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).where(
        F.col("id").isNotNull() & F.col("v").isNotNull()
        & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.where(F.size("v") == (size[0]["n"] if size else 0))


def kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Lloyd's algorithm from k-means++ like starts; empty centroids restart
    at the worst served points."""
    rng = np.random.default_rng(seed)
    k = min(k, len(np.unique(x, axis=0)))
    centers = x[rng.integers(len(x))][None, :]
    near = ((x - centers[0]) ** 2).sum(1)
    while len(centers) < k:
        new = x[rng.choice(len(x), p=near / near.sum())]
        centers = np.vstack([centers, new])
        near = np.minimum(near, ((x - new) ** 2).sum(1))
    for _ in range(rounds):
        d = (x ** 2).sum(1)[:, None] - 2 * x @ centers.T + (centers ** 2).sum(1)[None, :]
        own = d.argmin(1)
        n = np.bincount(own, minlength=k)
        sums = np.zeros_like(centers)
        np.add.at(sums, own, x)
        centers = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centers)
        for i, worst in zip(np.flatnonzero(n == 0), np.argsort(-d.min(1))):
            centers[i] = x[worst]
    return centers


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def _sq(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return (x ** 2).sum(1)[:, None] - 2 * x @ centers.T + (centers ** 2).sum(1)[None, :]


def _cells(a: np.ndarray, b: np.ndarray):
    cut = a.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            one, two = (_sq(x[:, :cut], a).argmin(1), _sq(x[:, cut:], b).argmin(1)) if len(x) else (np.zeros(0), np.zeros(0))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(one.astype(np.int32)), pa.array(two.astype(np.int32))],
                                             names=["id", "v", "a", "b"])
    return run


def _nearest(v: np.ndarray, ids: np.ndarray, q: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, distances) of the k nearest rows of v, ties by id."""
    d = np.sqrt(((v - q) ** 2).sum(1))
    some = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
    top = some[np.lexsort((ids[some], d[some]))[:k]]
    return top, d[top]


def _brute(trials: np.ndarray, k: int):
    def run(batches):
        for batch in batches:
            x, ids = _matrix(batch.column("v")), np.asarray(batch.column("id"))
            one, two = np.asarray(batch.column("a")), np.asarray(batch.column("b"))
            for t, q in enumerate(trials) if len(x) else ():
                top, d = _nearest(x, ids, q, k)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(top), t, np.int32)), pa.array(ids[top]), pa.array(d), pa.array(one[top]), pa.array(two[top])],
                    names=["t", "id", "d", "a", "b"])
    return run


def enough(index: DataFrame, a: np.ndarray, b: np.ndarray, counts: np.ndarray, trials: np.ndarray, k: int, recall: float) -> int:
    """The fewest candidates that hold ``recall`` of the true k + 1 nearest of
    the trial vectors."""
    best = F.row_number().over(Window.partitionBy("t").orderBy("d", "id"))
    truth = index.mapInArrow(_brute(trials, k + 1), "t int, id long, d double, a int, b int").withColumn("n", best).where(
        F.col("n") <= k + 1).select("t", "a", "b").collect()  # at most trials * (k + 1) rows
    cut, needs = a.shape[1], []
    da, db = _sq(trials[:, :cut], a), _sq(trials[:, cut:], b)
    for t in range(len(trials)):
        sums = (da[t][:, None] + db[t][None, :]).ravel()
        order = np.argsort(sums, kind="stable")
        held = np.empty(len(order), np.int64)
        held[order] = np.cumsum(counts[order])
        needs += [int(held[r["a"] * len(b) + r["b"]]) for r in truth if r["t"] == t]
    needs.sort()
    return needs[min(len(needs) - 1, int(np.ceil(recall * len(needs))) - 1)] if needs else 0


def walk(da: np.ndarray, db: np.ndarray, counts: np.ndarray, need: int) -> list[int]:
    """Cells by rising da[i] + db[j] until they hold ``need`` entries; empty
    cells are passed over.  Pairs enter the heap when both neighbours before
    them have left it."""
    ia, ib = np.argsort(da, kind="stable"), np.argsort(db, kind="stable")
    heap, seen, out, total = [(da[ia[0]] + db[ib[0]], 0, 0)], set(), [], 0
    while heap and total < need:
        _, i, j = heapq.heappop(heap)
        seen.add((i, j))
        cell = int(ia[i]) * len(ib) + int(ib[j])
        if counts[cell]:
            out.append(cell)
            total += int(counts[cell])
        if i + 1 < len(ia) and (j == 0 or (i + 1, j - 1) in seen):
            heapq.heappush(heap, (da[ia[i + 1]] + db[ib[j]], i + 1, j))
        if j + 1 < len(ib) and (i == 0 or (i - 1, j + 1) in seen):
            heapq.heappush(heap, (da[ia[i]] + db[ib[j + 1]], i, j + 1))
    return out


def _walks(a: np.ndarray, b: np.ndarray, counts: np.ndarray, need: int):
    cut = a.shape[1]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column("v"))
            if not len(x):
                continue
            da, db = _sq(x[:, :cut], a), _sq(x[:, cut:], b)
            rows, firsts, seconds = [], [], []
            for i in range(len(x)):
                cells = np.sort(np.array(walk(da[i], db[i], counts, need), np.int64))
                one, two = cells // len(b), (cells % len(b)).astype(np.int16)
                at = np.flatnonzero(np.concatenate([[True], one[1:] != one[:-1], [True]]))
                rows += [i] * (len(at) - 1)
                firsts += one[at[:-1]].tolist()
                seconds += [two[s:e].tobytes() for s, e in zip(at, at[1:])]
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(take), batch.column("v").take(take), pa.array(firsts, pa.int32()), pa.array(seconds, pa.binary())],
                names=["id", "v", "a", "bs"])
    return run


def _rerank(k: int, half: int):
    def run(queries: pa.Table, entries: pa.Table) -> pa.Table:
        """The k nearest visited entries of one block for each of its queries."""
        q, v = _matrix(queries.column("v").combine_chunks()), _matrix(entries.column("v").combine_chunks())
        qid, vid, code = np.asarray(queries.column("id")), np.asarray(entries.column("id")), np.asarray(entries.column("b"))
        out_q, out_v, out_d = [], [], []
        for i, bs in enumerate(queries.column("bs").to_pylist()) if len(v) else ():
            on = np.zeros(half, bool)
            on[np.frombuffer(bs, np.int16)] = True
            some = np.flatnonzero(on[code])
            if len(some):
                top, d = _nearest(v[some], vid[some], q[i], k)
                out_q.append(np.full(len(top), qid[i]))
                out_v.append(vid[some[top]])
                out_d.append(d)
        join = lambda x, t: np.concatenate(x).astype(t) if x else np.zeros(0, t)
        return pa.table({"id": join(out_q, np.int64), "vec_id": join(out_v, np.int64), "score": join(out_d, np.float64)})
    return run


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, half: int = HALF, candidates: int | None = None,
           sample: int = SAMPLE, recall: float = RECALL) -> DataFrame:
    """The k nearest of ``vectors`` (id, v) for each row of ``queries`` (id,
    v), without the query's own id: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    # equal vectors: the k + 1 smallest ids are enough
    first = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    index = written(vectors.withColumn("n", first).where(F.col("n") <= k + 1).drop("n"), "vectors")

    def drawn(rows: DataFrame, n: int) -> np.ndarray:
        return _matrix(rows.orderBy(F.xxhash64("id", F.lit(11)), "id").limit(n).select("v").toArrow().column("v").combine_chunks())

    x = drawn(index, sample)
    if not len(x):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    cut = max(1, x.shape[1] // 2)
    a, b = kmeans(x[:, :cut], half), kmeans(x[:, cut:], half) if x.shape[1] > cut else np.zeros((1, 0))
    index = written(index.mapInArrow(_cells(a, b), "id long, v array<double>, a int, b int"), "cells")
    counts = np.zeros(len(a) * len(b), np.int64)
    for one, two, n in index.groupBy("a", "b").count().collect():  # at most half * half rows
        counts[one * len(b) + two] = n
    # equal query vectors are searched once, under their smallest id
    asked = queries.groupBy("v").agg(F.min("id").alias("id"))
    if candidates is None:
        trials = drawn(asked, TRIALS)
        candidates = enough(index, a, b, counts, trials, k, recall) if len(trials) else 0
    visits = written(asked.select("id", "v").mapInArrow(
        _walks(a, b, counts, max(candidates, k + 1)), "id long, v array<double>, a int, bs binary"), "walks")
    plan = visits.groupBy("a").agg(F.count(F.lit(1)).alias("q")).join(index.groupBy("a").agg(F.count(F.lit(1)).alias("e")), "a").select(
        "a", F.ceil(F.col("q") / QUERIES).cast("int").alias("qb"), F.ceil(F.col("e") / BLOCK).cast("int").alias("eb"))
    plan = F.broadcast(written(plan, "blocks"))  # at most half rows

    def every(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = visits.join(plan, "a").select("a", F.pmod(F.xxhash64("id"), F.col("qb")).cast("int").alias("qs"), every("eb").alias("es"), "id", "v", "bs")
    right = index.join(plan, "a").select("a", F.pmod(F.xxhash64("id"), F.col("eb")).cast("int").alias("es"), every("qb").alias("qs"), "id", "v", "b")
    keys = ["a", "qs", "es"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_rerank(k + 1, len(b)), "id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("id").orderBy("score", "vec_id"))
    near = written(found.withColumn("n", best).where(F.col("n") <= k + 1).drop("n").withColumnRenamed("id", "rep"), "nearest")
    who = queries.join(asked.select("v", F.col("id").alias("rep")), "v").select(F.col("id").alias("query_id"), "rep")
    own = who.join(near, "rep").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return own.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)
