"""Exact k nearest neighbours by pivot (Voronoi) partitions.

Every training row belongs to the cell of its nearest pivot.  For a query q,
pivot p with largest member distance U and smallest L, and q's own pivot c, a
member o of p's cell satisfies d(q, o) >= d(q, p) - U, >= L - d(q, p) and
>= (d(q, p) - d(q, c)) / 2.  A cell is visited only if none of these bounds
exceeds the distance within which k rows are already known:

1. the cells' counts and radii give a first such distance,
2. the query's home block, searched first, gives a sharper one,
3. the blocks that hold a cell left under it are searched.

A block is some neighbouring cells of at most ``BLOCK`` rows together, or a
piece of a crowded cell; a query visits a block once, and visits are cut into
parts of at most ``QUERIES``.  So the rows shuffled are the training rows once
per part and the queries once per block, and no task holds more than a block
and a part.  Inside, the bounds hold for runs of ``CHUNK`` rows ordered by
(pivot, distance to it), under the k-th distance found so far.

Where the bounds cut nothing (many independent features) every pair has to be
looked at.  They are then cheap: tiles of distances in single precision (a
matrix product for p = 2) rule out all pairs that exceed the known distance by
more than their rounding error; the few others are computed in double
precision, which alone decides.  Pairs whose distance was computed are
counted.  The result is exact: bounds are widened by ``SLACK`` for rounding.

Rows may carry a level: one categorical feature in its standardised one-hot
form.  Two rows of different levels are then w(a)^p + w(b)^p further apart, w
being the scale of a level's indicator, which is the same distance as over
the dense indicator columns without making them.

Defined results: rows without an id, without features or with null or
non-finite entries take no part; equal distances go to the smaller id; fewer
than k training rows are all returned.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .persist import materialize

PIVOTS = 512      # most pivots
SPARE = 4         # sampled rows per pivot to choose from
BLOCK = 16_384    # most rows of a block
QUERIES = 8_192   # most queries of a part
VALUES = 1 << 20  # most feature values of a block or part, so wide rows make smaller ones
CHUNK = 1_024     # training rows of a tile
TILE = {1: 64, 2: 512}  # queries of a tile by p
PAIRS = 1 << 15   # pairs computed in double precision at once
SLACK = 1e-9
_ROW = "id long, label int, level int, weight double, v array<double>"


class Neighbours(NamedTuple):
    lists: DataFrame   # id, rank, train_id, distance, label
    compared: int      # pairs whose distance was computed
    cells: int


def rows_of(df: DataFrame, features: str = "features", label: str = "label", level: str | None = None,
            weight: str | None = None) -> DataFrame:
    """The columns that the search reads; invalid rows are left out."""
    v = F.col(features).cast("array<double>")
    out = df.select(F.col("id").cast("long").alias("id"), F.col(label).cast("int").alias("label"),
                    (F.col(level).cast("int") if level else F.lit(0)).alias("level"),
                    (F.col(weight).cast("double") if weight else F.lit(0.0)).alias("weight"), v.alias("v"))
    return out.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.col("level").isNotNull() & F.col("weight").isNotNull()
                     & F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf"))))


def _matrix(batch: pa.RecordBatch, name: str = "v") -> np.ndarray:
    n = batch.num_rows
    flat = np.asarray(batch.column(name).flatten(), np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def distance(a: np.ndarray, b: np.ndarray, p: int, level_a, weight_a, level_b, weight_b) -> np.ndarray:
    """Distances of the rows of ``a`` to the row ``b``, or to its rows."""
    diff = np.abs(a - b)
    total = diff.sum(1) if p == 1 else (diff * diff).sum(1)
    apart = np.where(level_a != level_b, np.abs(weight_a) ** p + np.abs(weight_b) ** p, 0.0)
    return total + apart if p == 1 else np.sqrt(total + apart)


def _tags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return np.asarray(batch.column("level")), np.asarray(batch.column("weight"))


class _Pivots(NamedTuple):
    v: np.ndarray
    level: np.ndarray
    weight: np.ndarray

    def distances(self, batch: pa.RecordBatch, p: int) -> np.ndarray:
        x, (level, weight) = _matrix(batch), _tags(batch)
        return np.stack([distance(x, v, p, level, weight, lv, w) for v, lv, w in zip(*self)], axis=1)


def choose_pivots(train: DataFrame, n_train: int, p: int, most: int = PIVOTS) -> _Pivots:
    """About sqrt(n) pivots, far from each other, of a bounded sample drawn by
    a hash of the id."""
    want = int(min(most, max(1, np.ceil(np.sqrt(n_train)))))
    rows = train.orderBy(F.xxhash64("id"), "id", "v").limit(SPARE * want).collect()
    v = np.array([r["v"] for r in rows], np.float64)
    level, weight = np.array([r["level"] for r in rows]), np.array([r["weight"] for r in rows], np.float64)
    taken = [0]
    near = distance(v, v[0], p, level, weight, level[0], weight[0])
    while len(taken) < want and near.max() > 0:
        i = int(near.argmax())
        taken.append(i)
        near = np.minimum(near, distance(v, v[i], p, level, weight, level[i], weight[i]))
    return _Pivots(v[taken], level[taken], weight[taken])


def _assign(pivots: _Pivots, p: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            d = pivots.distances(batch, p)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])],
                                             names=[*batch.schema.names, "pivot", "at"])
    return run


class _Blocks(NamedTuple):
    """The blocks of the cells: cell c has ``pieces[c]`` of them from
    ``first[c]`` on; ``count`` and ``holds`` (cells x blocks) are per block."""
    first: np.ndarray
    pieces: np.ndarray
    count: np.ndarray
    holds: np.ndarray


def _chain(pivots: _Pivots, p: int) -> list[int]:
    """The pivots in an order where neighbours are near."""
    left, at, out = np.ones(len(pivots.v), bool), 0, []
    while True:
        out.append(at)
        left[at] = False
        if not left.any():
            return out
        d = distance(pivots.v, pivots.v[at], p, pivots.level, pivots.weight, pivots.level[at], pivots.weight[at])
        at = int(np.where(left, d, np.inf).argmin()) if np.isfinite(d[left]).any() else int(left.argmax())


def _blocks(pivots: _Pivots, p: int, count: np.ndarray) -> _Blocks:
    most = max(1, min(BLOCK, VALUES // max(1, pivots.v.shape[1])))
    first, pieces, rows = np.zeros(len(count), np.int64), np.ones(len(count), np.int64), []
    room = 0
    for c in _chain(pivots, p):
        n = int(count[c])
        if n > most:
            pieces[c] = -(-n // most)
            first[c] = len(rows)
            rows += [-(-n // int(pieces[c]))] * int(pieces[c])
            room = 0
        else:
            if n > room or not rows:
                rows.append(0)
                room = most
            first[c] = len(rows) - 1
            rows[-1] += n
            room -= n
    at = np.arange(len(rows))
    holds = (at >= first[:, None]) & (at < (first + pieces)[:, None]) & (count > 0)[:, None]
    return _Blocks(first, pieces, np.array(rows, np.int64), holds)


def _home(batch: pa.RecordBatch, blocks: _Blocks, own: np.ndarray) -> np.ndarray:
    return blocks.first[own] + np.asarray(batch.column("id")) % blocks.pieces[own]


_VISIT = "id long, level int, weight double, v array<double>, cell int, at double, reach double"


def _visits(pivots: _Pivots, p: int, blocks: _Blocks, count: np.ndarray, low: np.ndarray, high: np.ndarray, k: int, first: bool, tally: bool = False):
    """Blocks (column ``cell``) a query has to visit: its home (``first``), or
    all others with a cell within its distance ``reach``; ``at`` is the
    distance to its own pivot.  With ``tally`` only (cell, visits)."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            d = pivots.distances(batch, p)
            own = d.argmin(1)
            near, home = d[np.arange(len(d)), own], _home(batch, blocks, own)
            if first:  # k rows are certain within the k-th smallest d + U
                far = np.where(count > 0, d + high, np.inf)
                order = np.argsort(far, axis=1)
                have = np.cumsum(count[order], axis=1) >= k
                at = np.where(have.any(1), have.argmax(1), 0)
                reach = np.where(have.any(1), np.take_along_axis(far, order, 1)[np.arange(len(d)), at], np.inf)
                q, cell = np.arange(len(d)), home
            else:
                reach = np.asarray(batch.column("reach"))
                bound = np.maximum(np.maximum(d - high, low - d), (d - near[:, None]) / 2)
                need = (bound <= reach[:, None] * (1 + SLACK) + SLACK) & (count > 0)
                need = need.astype(np.float32) @ blocks.holds.astype(np.float32) > 0
                need[np.arange(len(d)), home] = False
                q, cell = np.nonzero(need)
            if tally:
                n = np.bincount(cell, minlength=len(blocks.count))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(n[some], pa.int64())], names=["cell", "n"])
                continue
            for i in range(0, len(q), QUERIES):  # a batch of queries times all its blocks may be long
                part, to = q[i:i + QUERIES], cell[i:i + QUERIES]
                some = batch.select(["id", "level", "weight", "v"]).take(pa.array(part))
                yield pa.RecordBatch.from_arrays([*some.columns, pa.array(to, pa.int32()), pa.array(near[part]), pa.array(reach[part])],
                                                 names=["id", "level", "weight", "v", "cell", "at", "reach"])
    return run


class _Side(NamedTuple):
    ids: np.ndarray
    v: np.ndarray
    level: np.ndarray
    weight: np.ndarray
    at: np.ndarray

    @staticmethod
    def of(batch: pa.RecordBatch) -> _Side:
        return _Side(np.asarray(batch.column("id")), _matrix(batch), *_tags(batch), np.asarray(batch.column("at")))


class _Tiles:
    """Distances of queries to training rows (squares for p = 2) in single
    precision, less a number per query, with a bound of their error."""

    def __init__(self, x: _Side, y: _Side, p: int):
        self.p, self.x, self.y = p, x, y
        middle = x.v.mean(0)
        a, b = x.v - middle, y.v - middle
        most = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
        kind = np.float32 if most < 1e15 else np.float64
        self.unit = float(np.finfo(kind).eps) * (x.v.shape[1] + 8)
        norm = (lambda m: np.abs(m).sum(1)) if p == 1 else (lambda m: np.sqrt((m * m).sum(1)))
        self.size_x, self.size_y = norm(a), norm(b)
        self.plain = len(np.union1d(x.level, y.level)) < 2
        self.wx, self.wy = np.abs(x.weight) ** p, np.abs(y.weight) ** p
        self.a = np.ascontiguousarray(a.T if p == 1 else a, kind)
        self.b = np.ascontiguousarray(b.T if p == 1 else b, kind)
        self.kind, self.room = kind, np.empty((2, TILE[p] * CHUNK), kind)

    def of(self, rows: slice, q: np.ndarray):
        """(values, what they are short of, error) of a tile."""
        shape = len(q), rows.stop - rows.start
        out, more = (r[:shape[0] * shape[1]].reshape(shape) for r in self.room)
        far = self.size_x[rows].max() + self.size_y[q]
        if self.p == 1:
            out[:] = 0
            for xs, ys in zip(self.a[:, rows], self.b[:, q]):
                np.subtract(xs, ys[:, None], out=more)
                np.abs(more, out=more)
                np.add(out, more, out=out)
            less, error = np.zeros(len(q)), self.unit * far
        else:
            np.matmul(self.b[q], self.a[rows].T, out=out)
            out *= -2
            out += (self.size_x[rows] ** 2).astype(self.kind)
            less, error = self.size_y[q] ** 2, self.unit * 2 * far * far
        if not self.plain:
            apart = self.x.level[rows] != self.y.level[q][:, None]
            add = (self.wx[rows] + self.wy[q][:, None]) * apart
            out += add.astype(self.kind)
            error = error + self.unit * add.max(1)
        return out, less, error


class _Nearest:
    """The k best rows so far of each query."""

    def __init__(self, x: _Side, y: _Side, reach: np.ndarray, k: int, p: int):
        self.x, self.y, self.k, self.p = x, y, k, p
        self.reach = reach * (1 + SLACK) + SLACK
        self.n = np.zeros(len(y.ids), np.int64)
        self.d = np.full((len(y.ids), k), np.inf)
        self.row = np.zeros((len(y.ids), k), np.int64)

    def add(self, q: np.ndarray, row: np.ndarray) -> None:
        x, y = self.x, self.y
        for i in range(0, len(q), PAIRS):
            a, b = row[i:i + PAIRS], q[i:i + PAIRS]
            d = distance(x.v[a], y.v[b], self.p, x.level[a], x.weight[a], y.level[b], y.weight[b])
            some = ~(d > self.reach[b])
            a, b, d = a[some], b[some], d[some]
            if not len(b):
                continue
            who = np.unique(b)
            old = np.arange(self.k) < self.n[who][:, None]
            b = np.append(np.repeat(who, self.n[who]), b)
            d, a = np.append(self.d[who][old], d), np.append(self.row[who][old], a)
            order = np.lexsort((x.ids[a], d, b))
            a, b, d = a[order], b[order], d[order]
            rank = np.arange(len(b)) - np.searchsorted(b, b)
            top = rank < self.k
            self.d[b[top], rank[top]], self.row[b[top], rank[top]] = d[top], a[top]
            self.n[who] = np.minimum(np.bincount(b, minlength=len(self.n))[who], self.k)
            full = who[self.n[who] == self.k]
            self.reach[full] = np.minimum(self.reach[full], self.d[full, -1])


def _tile(tiles: _Tiles, best: _Nearest, rows: slice, q: np.ndarray) -> None:
    """Adds the pairs of a tile that may be among the k best."""
    value, less, error = tiles.of(rows, q)
    reach = best.reach[q] ** tiles.p
    limit = reach + error + tiles.unit * reach - less
    limit = (limit + tiles.unit * (np.abs(limit) + less)).astype(tiles.kind)
    some = ~(value > limit[:, None])
    if np.count_nonzero(some) > 4 * best.k * len(q) and value.shape[1] > best.k:
        kth = np.partition(value, best.k - 1, axis=1)[:, best.k - 1].astype(float)
        kth += 2 * error + tiles.unit * (np.abs(kth) + less)
        some &= ~(value > kth.astype(tiles.kind)[:, None])
    a, b = np.nonzero(some)
    best.add(q[a], b + rows.start)


def _compare(k: int, p: int, pivots: _Pivots | None = None):
    def run(left: pa.Table, right: pa.Table):
        a, q = left.combine_chunks().to_batches(), right.combine_chunks().to_batches()
        kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int64()]
        cols, compared = [np.array([])] * 4, 0
        if a and q:
            a, q = a[0], q[0]
            pivot = np.asarray(a.column("pivot")) if pivots else np.zeros(a.num_rows, np.int64)
            order = np.lexsort((np.asarray(a.column("at")), pivot))
            a, pivot = a.take(pa.array(order)), pivot[order]
            x, y, label = _Side.of(a), _Side.of(q), np.asarray(a.column("label").fill_null(-1))
            best, tiles = _Nearest(x, y, np.asarray(q.column("reach")), k, p), _Tiles(x, y, p)
            starts = np.arange(0, len(pivot), CHUNK)
            bound = np.full((len(y.ids), len(starts)), -np.inf)
            if pivots:
                bound[:] = np.inf
                seen, at = np.unique(pivot, return_inverse=True)
                far = _Pivots(*(c[seen] for c in pivots)).distances(q, p)
                for c, s in enumerate(starts):
                    for i in np.unique(at[s:s + CHUNK]):  # the runs of one pivot
                        mine, d = x.at[s:s + CHUNK][at[s:s + CHUNK] == i], far[:, i]
                        run_bound = np.maximum(np.maximum(d - mine[-1], mine[0] - d), (d - y.at) / 2)
                        bound[:, c] = np.minimum(bound[:, c], run_bound)
            for c in np.argsort(bound.mean(0), kind="stable"):
                rows = slice(int(starts[c]), int(min(starts[c] + CHUNK, len(pivot))))
                need = np.flatnonzero(~(bound[:, c] > best.reach * (1 + SLACK) + SLACK))
                compared += len(need) * (rows.stop - rows.start)
                for i in range(0, len(need), TILE[p]):
                    _tile(tiles, best, rows, need[i:i + TILE[p]])
            some = np.arange(k) < best.n[:, None]
            row = best.row[some]
            cols = [np.repeat(y.ids, best.n), x.ids[row], best.d[some], label[row]]
            if not len(row) and compared:  # only the count
                cols = [y.ids[:1], [None], [None], [None]]
        count = np.zeros(len(cols[0]), np.int64)
        count[:1] = compared
        return pa.table([pa.array(c, t) for c, t in zip([*cols, count], kinds)], names=["id", "train_id", "distance", "label", "compared"])
    return run


def _spread(spark, rows: int) -> int:
    """Tasks for steps whose work is in Python, whatever the rows weigh."""
    return max(1, min(-(-rows // 1_024), 2 * spark.sparkContext.defaultParallelism), -(-rows // BLOCK))


def _search(cells: DataFrame, visits: DataFrame, count: np.ndarray, k: int, p: int, pivots: _Pivots | None = None,
            asked: dict[int, int] | None = None) -> DataFrame:
    """The k best of each visit: training rows and visits, in parts, met by an
    equi-join on (cell, part); a cell is a block of ``count`` rows here."""
    spark = cells.sparkSession
    if asked is None:
        asked = {r["cell"]: r["count"] for r in visits.groupBy("cell").count().collect()}  # one row per block
    width = pivots.v.shape[1] if pivots else 1
    # about three parts per core where there are few: each part gets its block's rows
    most = max(512, -(-sum(asked.values()) // (3 * spark.sparkContext.defaultParallelism)))
    most = max(1, min(QUERIES, VALUES // max(1, width), most))
    plan = [(int(c), int(-(-n // most))) for c, n in asked.items() if count[c]]
    table = F.broadcast(spark.createDataFrame(plan, "cell int, parts int"))
    left = cells.join(table, "cell").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = visits.join(table, "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")).drop("parts")
    key = ["cell", "part"]
    tasks = max(1, min(2 * sum(n for _, n in plan), 2_000))  # set, as small rows make long tasks
    left, right = left.repartition(tasks, *key), right.repartition(tasks, *key)
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(
        _compare(k, p, pivots), "id long, train_id long, distance double, label int, compared long")


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("id").orderBy("distance", "train_id"))
    return found.where(F.col("train_id").isNotNull()).withColumn("rank", rank).where(F.col("rank") <= k)


def neighbours(train: DataFrame, queries: DataFrame, k: int = 5, p: int = 2, most_pivots: int = PIVOTS) -> Neighbours:
    """The k nearest rows of ``train`` for each row of ``queries`` (both from
    ``rows_of``; ids of queries are distinct) under the L1 or L2 distance."""
    if p not in (1, 2):
        raise ValueError("p is 1 or 2")
    spark = train.sparkSession
    n = train.count()
    empty = spark.createDataFrame([], "id long, rank int, train_id long, distance double, label int")
    if not n:
        return Neighbours(empty, 0, 0)
    pivots = choose_pivots(train, n, p, most_pivots)
    cells = materialize(train.repartition(_spread(spark, n)).mapInArrow(_assign(pivots, p), _ROW + ", pivot int, at double"))
    size = len(pivots.v)
    count, low, high = np.zeros(size, np.int64), np.zeros(size), np.zeros(size)
    for r in cells.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi")).collect():
        count[r["pivot"]], low[r["pivot"]], high[r["pivot"]] = r["n"], r["lo"], r["hi"]
    blocks = _blocks(pivots, p, count)
    table = F.broadcast(spark.createDataFrame([(i, int(f), int(m)) for i, (f, m) in enumerate(zip(blocks.first, blocks.pieces))],
                                              "pivot int, _first int, _pieces int"))  # one row per pivot
    piece = F.col("_first") + F.pmod(F.xxhash64("id", "v"), F.col("_pieces"))
    cells = cells.join(table, "pivot").withColumn("cell", piece.cast("int")).drop("_first", "_pieces")
    bounds = (pivots, p, blocks, count, low, high, k)
    many = _spread(spark, queries.count())
    first = materialize(queries.repartition(many).mapInArrow(_visits(*bounds, True), _VISIT))
    near = materialize(_search(cells, first, blocks.count, k, p, pivots))
    # a full list from the home block sharpens the reach
    kth = _best(near, k).groupBy("id").agg(F.max("distance").alias("kth"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k).drop("n")
    again = first.drop("cell", "at").join(kth, "id", "left").withColumn("reach", F.least("reach", F.coalesce("kth", "reach"))).select(
        "id", "level", "weight", "v", "reach")
    again = materialize(again.repartition(many))
    asked = {r["cell"]: r["n"] for r in again.mapInArrow(_visits(*bounds, False, True), "cell int, n long").groupBy("cell").agg(
        F.sum("n").alias("n")).collect()}  # one row per block
    found = near
    if asked:
        others = again.mapInArrow(_visits(*bounds, False), _VISIT)
        found = materialize(near.unionByName(_search(cells, others, blocks.count, k, p, pivots, asked)))
    compared = found.agg(F.sum("compared")).first()[0] or 0
    lists = materialize(_best(found, k).select("id", F.col("rank").cast("int").alias("rank"), "train_id", "distance", "label"))
    return Neighbours(lists, int(compared), size)


def votes(lists: DataFrame, queries: DataFrame, points: list[tuple[int, str]]) -> DataFrame:
    """(k, weights, id, label, prediction, probability of class 1) from the
    first k of each list, for every (k, weights) of ``points``: the lists of
    the largest k answer all of them in one aggregation.  With ``distance`` a
    neighbour counts 1 / d, unless some d is 0: then those count alone.  Ties
    go to class 0; a query without a list has nulls."""
    if any(w not in ("uniform", "distance") for _, w in points):
        raise ValueError("weights are uniform or distance")
    d, one, sums, each = F.col("distance"), F.col("label") == 1, [], []
    for i, (k, w) in enumerate(points):
        near = F.col("rank") <= k
        worth = F.when(near, F.lit(1.0)) if w == "uniform" else F.when(near & (d > 0), 1 / d)
        same = F.lit(False) if w == "uniform" else near & (d == 0)
        sums.append(F.struct(F.sum(worth).alias("all"), F.sum(F.when(one, worth)).alias("one"),
                             F.count_if(same).alias("same"), F.count_if(same & one).alias("same_one")).alias(f"_{i}"))
        s = F.col(f"_{i}")
        share = F.when(s["same"] > 0, s["same_one"] / s["same"]).otherwise(F.coalesce(s["one"], F.lit(0.0)) / s["all"])
        each.append(F.struct(F.lit(k).alias("k"), F.lit(w).alias("weights"), share.alias("p")))
    found = queries.select("id", "label").join(lists.groupBy("id").agg(*sums), "id", "left")
    p = F.col("v.p")
    return found.select("id", "label", F.explode(F.array(*each)).alias("v")).select(
        "v.k", "v.weights", "id", "label", F.when(p > 0.5 + 1e-12, 1).when(p.isNotNull(), 0).cast("int").alias("prediction"), p.alias("probability"))


def vote(lists: DataFrame, queries: DataFrame, k: int, weights: str = "uniform") -> DataFrame:
    """(id, label, prediction, probability of class 1): ``votes`` of one k and
    weighting."""
    return votes(lists, queries, [(k, weights)]).drop("k", "weights")
