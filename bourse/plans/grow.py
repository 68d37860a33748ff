"""Trees and forests of many fits, grown and scored some trees to a task.

pyspark.ml grows a forest by one job per group of nodes: the histograms of all
nodes are shuffled, the splits and in the end all nodes are held by the driver.
Deep forests on few rows spend nearly all their time and memory there.  Here a
task gets the rows of a fit, one byte per feature value (the number of its
bin), and grows ``PACK`` trees alone; all fits of a search are one job.

The trees are those of pyspark.ml: the same bins, from all rows of a fit (up to
10,000 rows pyspark.ml reads them all too, above it draws as many); Gini gain,
the first best split of the features in their order, ``min_rows`` rows in both
children, no split without gain, leaves of one parent and one class merged.  A
forest draws each tree's rows (Poisson, mean 1) and for each node
ceil(sqrt(width)) features; the draws depend on the tree's number and the rows'
order alone, not on partitions or a depth limit.  So one growth answers every
limit: the upper levels of a deeper tree are the shallower one.

Only fits of at most ``VALUES`` feature values are grown so (``suits``); larger
ones are for pyspark.ml, whose fits no task holds whole.
"""

from __future__ import annotations

from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.persist import materialize

BINS = 32         # most bins of a feature (pyspark.ml's maxBins)
PACK = 10         # trees of a task
VALUES = 1 << 26  # most feature values of a fit
CELLS = 1 << 16   # histogram cells and feature values at once
COLUMNS = 8       # features whose bins a task finds
TREE, FOREST = "DecisionTree", "RandomForest"


class Growth(NamedTuple):
    """What is grown on the rows of a fit, and where it is scored."""
    fit: int
    family: str
    min_rows: int             # of a child
    depths: tuple[int, ...]   # limits
    sizes: tuple[int, ...]    # first so many trees


class Width(NamedTuple):
    dense: int
    levels: int  # indicators of the levels 1..n-1 follow, the highest first

    @property
    def all(self) -> int:
        return self.dense + max(self.levels - 1, 0)


# ---------------------------------------------------------------- bins

def thresholds(x: np.ndarray) -> np.ndarray:
    """pyspark.ml's split candidates of a feature: the means of neighbouring
    values, or those nearest to equal shares of the rows."""
    if not len(x):
        return np.zeros(0)
    value, count = np.unique(x, return_counts=True)
    middle, splits = (value[:-1] + value[1:]) / 2, min(BINS, len(x)) - 1
    if len(middle) <= splits:
        return middle
    seen = np.cumsum(count)
    half = seen[:-1] + seen[1:]
    out, start, stride = [], 0, len(x) / (splits + 1)
    target = stride
    while (i := max(start, int(np.searchsorted(half, 2 * target, side="right")))) < len(middle):
        out.append(middle[i])
        start, target = i + 1, target + stride
    return np.array(out)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.asarray(batch.column("features").flatten(), np.float64).reshape(batch.num_rows, -1)


def _members(batch: pa.RecordBatch, fits: int):
    """(since, test): a row trains the fits from ``since`` on and tests one."""
    return np.asarray(batch.column("since").fill_null(fits)), np.asarray(batch.column("test").fill_null(-1))


def _columns(fits: int):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, (since, _) = _matrix(batch), _members(batch, fits)
            for f in range(fits):
                mine = x[since <= f]
                at = range(0, x.shape[1] if len(mine) else 0, COLUMNS)
                yield pa.RecordBatch.from_arrays([pa.array([f] * len(at), pa.int32()), pa.array(at, pa.int32()),
                                                  pa.array([mine[:, c:c + COLUMNS].T.tobytes() for c in at], pa.binary())],
                                                 names=["fit", "first", "x"])
    return run


def _cut(dense: int):
    def run(key, table):
        fit, first = (k.as_py() for k in key)
        n = min(COLUMNS, dense - first)
        x = np.concatenate([np.frombuffer(b).reshape(n, -1) for b in table.column("x").to_pylist()], axis=1)
        return pa.table([pa.array([fit] * n, pa.int32()), pa.array(range(first, first + n), pa.int32()),
                         pa.array([thresholds(row).tolist() for row in x], pa.list_(pa.float64()))], names=["fit", "feature", "cuts"])
    return run


def find_cuts(rows: DataFrame, fits: int, width: Width) -> list[list[np.ndarray]]:
    """The thresholds per fit and feature: at most 31 numbers each."""
    parts = rows.select("features", "since", "test").mapInArrow(_columns(fits), "fit int, first int, x binary")
    out = [[np.zeros(0)] * width.dense for _ in range(fits)]
    for r in parts.groupBy("fit", "first").applyInArrow(_cut(width.dense), "fit int, feature int, cuts array<double>").collect():
        out[r["fit"]][r["feature"]] = np.array(r["cuts"])
    return out


_BLOCK = "fit int, trains boolean, pos array<long>, id array<long>, label array<int>, level array<int>, x binary"


def _blocks(fits: int, cuts: list[list[np.ndarray]]):
    """Rows of a fit as one row of lists and bin numbers."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, (since, test) = _matrix(batch), _members(batch, fits)
            for f in range(fits):
                for trains, mine in ((True, since <= f), (False, test == f)):
                    some = np.flatnonzero(mine)
                    if not len(some):
                        continue
                    part = np.empty((len(some), x.shape[1]), np.uint8)
                    for j, c in enumerate(cuts[f]):
                        part[:, j] = np.searchsorted(c, x[some, j])
                    ends = pa.array([0, len(some)], pa.int32())
                    lists = [pa.ListArray.from_arrays(ends, batch.column(c).take(pa.array(some))) for c in ("pos", "id", "label", "level")]
                    yield pa.RecordBatch.from_arrays([pa.array([f], pa.int32()), pa.array([trains]), *lists, pa.array([part.tobytes()], pa.binary())],
                                                     names=["fit", "trains", "pos", "id", "label", "level", "x"])
    return run


class _Rows(NamedTuple):
    """Rows of a fit in the order of their positions."""
    x: np.ndarray
    level: np.ndarray
    label: pa.Array
    id: pa.Array

    @staticmethod
    def of(table: pa.Table, trains: bool, dense: int) -> _Rows:
        table = table.filter(pc.equal(table.column("trains"), trains))
        flat = {c: pc.list_flatten(table.column(c)).combine_chunks() for c in ("pos", "id", "label", "level")}
        order = np.argsort(np.asarray(flat["pos"]), kind="stable")
        x = [np.frombuffer(b, np.uint8).reshape(-1, dense) for b in table.column("x").to_pylist()]
        x = np.concatenate(x)[order] if x else np.zeros((0, dense), np.uint8)
        label, ids = (flat[c].take(pa.array(order)) for c in ("label", "id"))
        return _Rows(x, np.asarray(flat["level"])[order], label, ids)

    def bins(self, row: np.ndarray, feature: np.ndarray, width: Width) -> np.ndarray:
        """The bin of a feature in a row, the two broadcast together."""
        if width.levels < 2:
            return self.x.ravel().take(row * width.dense + feature)
        dense = self.x[row, np.minimum(feature, width.dense - 1)]
        return np.where(feature < width.dense, dense, feature - width.dense == width.levels - 1 - self.level[row])


# ---------------------------------------------------------------- growing

class Tree(NamedTuple):
    """Nodes level by level; ``left`` is -1 in a leaf, the right child follows
    the left one."""
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    zero: np.ndarray   # rows of class 0
    one: np.ndarray
    gain: np.ndarray
    level: np.ndarray

    def share(self) -> np.ndarray:
        return self.one / (self.zero + self.one)


def _drawn(rng: np.random.Generator, nodes: int, width: int, n: int) -> np.ndarray:
    """``n`` distinct features for each node (Floyd's draw)."""
    out = np.empty((nodes, n), np.int64)
    for k, top in enumerate(range(width - n, width)):
        pick = rng.integers(0, top + 1, nodes)
        out[:, k] = np.where((out[:, :k] == pick[:, None]).any(1), top, pick)
    return out


def _best(rows: _Rows, y: np.ndarray, weight: np.ndarray, row: np.ndarray, at: np.ndarray, features: np.ndarray,
          zero: np.ndarray, one: np.ndarray, min_rows: int, bins: int, width: Width):
    """(gain, position among the node's features, bin, left zeros, left ones) of each
    node's best split; ``at`` is the node of a row of ``row``, ascending."""
    nodes, n = features.shape
    hist = np.zeros(nodes * n * bins * 2)
    step = max(1, CELLS // n)
    for i in range(0, len(row), step):
        r, a = row[i:i + step], at[i:i + step]
        key = ((a[:, None] * n + np.arange(n)) * 2 + y[r][:, None]) * bins
        key += rows.bins(r[:, None], features[a], width)
        if len(row) <= step:
            hist = np.bincount(key.ravel(), np.repeat(weight[r], n), len(hist))
        else:
            low = int(a[0]) * n * bins * 2
            part = np.bincount(key.ravel() - low, np.repeat(weight[r], n))
            hist[low:low + len(part)] += part
    left = hist.reshape(nodes, n, 2, bins)[..., :-1].cumsum(axis=3)
    l0, l1 = left[:, :, 0], left[:, :, 1]
    t0, t1 = zero[:, None, None], one[:, None, None]
    total, r0, r1 = t0 + t1, t0 - l0, t1 - l1
    ln, rn = l0 + l1, r0 + r1
    with np.errstate(divide="ignore", invalid="ignore"):
        whole = 1.0 - (t0 / total) ** 2 - (t1 / total) ** 2
        gain = whole - ln / total * (1.0 - (l0 / ln) ** 2 - (l1 / ln) ** 2) - rn / total * (1.0 - (r0 / rn) ** 2 - (r1 / rn) ** 2)
    gain[(ln < min_rows) | (rn < min_rows)] = -1
    flat = gain.reshape(nodes, -1)
    pick = flat.argmax(1)
    who, (k, s) = np.arange(nodes), np.divmod(pick, bins - 1)
    return flat[who, pick], k, s, l0[who, k, s], l1[who, k, s]


def grow_tree(rows: _Rows, y: np.ndarray, weight: np.ndarray, min_rows: int, depth: int, bins: int, width: Width,
              rng: np.random.Generator | None = None) -> Tree:
    """A tree on the rows by their weight (a count); with ``rng`` every node
    sees some drawn features."""
    n = width.all if rng is None else int(np.ceil(np.sqrt(width.all)))
    row = np.flatnonzero(weight)
    zero, one = np.array([weight[row] @ (y[row] == 0)]), np.array([weight[row] @ (y[row] == 1)])
    at = np.zeros(len(row), np.int64)
    out = [(zero, one, np.zeros(1, np.int64))]
    splits: list[tuple[np.ndarray, ...]] = []  # node, feature, bin, left, gain
    first, count = 0, 1
    for level in range(depth):
        open_ = (zero > 0) & (one > 0) & (zero + one >= 2 * min_rows)
        if bins < 2 or not open_.any():
            break
        who = np.flatnonzero(open_)
        keep = open_[at]
        row, at = row[keep], (np.cumsum(open_) - 1)[at[keep]]
        z, o = zero[who], one[who]
        features = np.broadcast_to(np.arange(n), (len(who), n)) if rng is None else _drawn(rng, len(who), width.all, n)
        starts = np.searchsorted(at, np.arange(len(who) + 1))
        step = max(1, CELLS // (2 * bins * n))
        found = []
        for i in range(0, len(who), step):
            to = slice(i, min(i + step, len(who)))
            a, b = starts[i], starts[to.stop]
            found.append(_best(rows, y, weight, row[a:b], at[a:b] - i, features[to], z[to], o[to], min_rows, bins, width))
        gain, k, s, l0, l1 = (np.concatenate(c) for c in zip(*found))
        cut = gain > 0
        if not cut.any():
            break
        feature = features[np.arange(len(who)), k]
        child = 2 * (np.cumsum(cut) - 1)
        keep = cut[at]
        row, at = row[keep], at[keep]
        right = rows.bins(row, feature[at], width) > s[at]
        at = child[at] + right
        order = np.argsort(at, kind="stable")
        row, at = row[order], at[order]
        splits.append((first + who[cut], feature[cut], s[cut], count + child[cut], gain[cut]))
        zero, one = (np.stack([a, b - a], 1).ravel() for a, b in ((l0[cut], z[cut]), (l1[cut], o[cut])))
        out.append((zero, one, np.full(len(zero), level + 1)))
        first, count = count, count + len(zero)
    zero, one, levels = (np.concatenate(c) for c in zip(*out))
    feature, bin_, left, gains = np.full(count, -1), np.full(count, -1), np.full(count, -1), np.full(count, -1.0)
    for node, f, s, to, g in splits:
        feature[node], bin_[node], left[node], gains[node] = f, s, to, g
    return Tree(feature, bin_, left, zero, one, gains, levels)


def cut_back(tree: Tree, depth: int) -> Tree:
    """The tree of this depth limit: leaves of one parent and one class are
    merged, from below; nodes keep their order."""
    n = int(np.searchsorted(tree.level, depth, side="right"))
    left = np.where(tree.level[:n] < depth, tree.left[:n], -1)
    one = tree.one[:n] > tree.zero[:n]
    ends = np.searchsorted(tree.level[:n], np.arange(depth + 2))
    for level in range(min(depth, int(tree.level[-1])) - 1, -1, -1):
        node = np.arange(ends[level], ends[level + 1])
        node = node[left[node] >= 0]
        a, b = left[node], left[node] + 1
        left[node[(left[a] < 0) & (left[b] < 0) & (one[a] == one[b])]] = -1
    stays = np.zeros(n, bool)
    stays[0] = True
    for level in range(len(ends) - 1):
        node = np.arange(ends[level], ends[level + 1])
        node = left[node[stays[node] & (left[node] >= 0)]]
        stays[node] = stays[node + 1] = True
    number, inner = np.cumsum(stays) - 1, left >= 0
    left = np.where(inner, number[left], -1)[stays]
    inner = inner[stays]
    cols = [c[:n][stays] for c in tree]
    return Tree(np.where(inner, cols[0], -1), np.where(inner, cols[1], -1), left, cols[3], cols[4], np.where(inner, cols[5], -1.0), cols[6])


def leaf_of(tree: Tree, rows: _Rows, width: Width) -> np.ndarray:
    """The leaf that each row reaches."""
    node, row = np.zeros(len(rows.x), np.int64), np.arange(len(rows.x))
    while len(row := row[tree.left[node[row]] >= 0]):
        at = node[row]
        node[row] = tree.left[at] + (rows.bins(row, tree.feature[at], width) > tree.bin[at])
    return node


# ---------------------------------------------------------------- tasks

_NODES = ("feature array<int>, threshold array<double>, left array<int>, zero array<double>, one array<double>, gain array<double>")
_GROWN = ("fit int, family string, min_rows int, depth int, first int, total array<double>, id array<long>, label array<int>, "
          f"tree int, levels int, {_NODES}")
_KINDS = {"int": pa.int32(), "string": pa.string(), "array<double>": pa.list_(pa.float64()), "array<long>": pa.list_(pa.int64()),
          "array<int>": pa.list_(pa.int32())}
_SCHEMA = pa.schema([(c, _KINDS[t]) for c, t in (x.strip().split(" ") for x in _GROWN.split(","))])


def _grow(plan: list[Growth], cuts: list[list[np.ndarray]], width: Width, seed: int, keep: bool):
    """Per (fit, pack): for each growth and depth limit the sums of the shares
    of class 1 over runs of trees, a run ending at each size; with ``keep``
    the nodes of each tree too."""
    def run(key, table):
        fit, pack = (k.as_py() for k in key)
        train, test = _Rows.of(table, True, width.dense), _Rows.of(table, False, width.dense)
        y = np.asarray(train.label).astype(np.int64)
        bins = max([2 if width.levels > 1 else 1, *(len(c) + 1 for c in cuts[fit])])
        cut = np.full((width.dense, bins), np.nan)  # a leaf's place is the last one
        for f, c in enumerate(cuts[fit]):
            cut[f, :len(c)] = c
        out = []
        for g in plan:
            if g.fit != fit or (g.family == TREE) != (pack < 0):
                continue
            sums: dict[tuple, np.ndarray] = {}
            trees = [0] if pack < 0 else range(pack * PACK, min((pack + 1) * PACK, max(g.sizes)))
            for t in trees:
                rng = None if pack < 0 else np.random.default_rng((seed, t))
                weight = np.ones(len(y)) if rng is None else rng.poisson(1.0, len(y)).astype(float)
                if not weight.any():
                    weight[:1] = 1.0  # a tree of no rows has no leaf
                whole = grow_tree(train, y, weight, g.min_rows, max(g.depths), bins, width, rng)
                first = max([s for s in g.sizes if s <= t] + [pack * PACK if pack > 0 else 0])
                for depth in g.depths:
                    tree = cut_back(whole, depth)
                    if len(test.x):
                        share = tree.share()[leaf_of(tree, test, width)]
                        sums[depth, first] = sums[depth, first] + share if (depth, first) in sums else share
                    if keep:
                        at = np.where(tree.feature < width.dense, cut[np.minimum(tree.feature, width.dense - 1), tree.bin], 0.5)
                        out.append({"tree": t, "depth": depth, "levels": int(tree.level[-1]), "feature": tree.feature.astype(np.int32), "threshold": at,
                                    "left": tree.left.astype(np.int32), "zero": tree.zero, "one": tree.one, "gain": tree.gain} | _about(g))
            for (depth, first), total in sums.items():
                named = {"id": test.id.to_pylist(), "label": test.label.to_pylist()} if not first else {}
                out.append({"depth": depth, "first": first, "total": total} | named | _about(g))
        return pa.Table.from_pylist([], _SCHEMA) if not out else pa.table(
            [pa.array([r.get(f.name) for r in out], f.type) for f in _SCHEMA], _SCHEMA)
    return run


def _about(g: Growth) -> dict:
    return {"fit": g.fit, "family": g.family, "min_rows": g.min_rows}


_KEY = ["fit", "family", "min_rows", "depth"]
_PREDICTED = "fit int, family string, min_rows int, depth int, size int, id long, label int, probability double, prediction int"


def _mean(sizes: dict[tuple, tuple[int, ...]]):
    """The runs of trees of a growth and depth limit summed up to each size."""
    def run(key, table):
        key = [k.as_py() for k in key]
        runs = sorted(table.select(["first", "total"]).to_pylist(), key=lambda r: r["first"])
        named = table.filter(pc.equal(table.column("first"), 0))
        ids, labels = (pc.list_flatten(named.column(c)).combine_chunks() for c in ("id", "label"))
        out = []
        for size in sizes[tuple(key[:3])]:
            p = sum(np.array(r["total"]) for r in runs if r["first"] < size) / size
            about = [pa.array([v] * len(p), t) for v, t in zip([*key, size], (pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32()))]
            out.append(pa.table([*about, ids, labels, pa.array(p), pa.array((p > 0.5 + 1e-12).astype(np.int32))],
                                names=[*_KEY, "size", "id", "label", "probability", "prediction"]))
        return pa.concat_tables(out)
    return run


def suits(train: DataFrame, test: DataFrame) -> Width | None:
    """The width of the rows if a task can hold a fit on all of ``train``, its
    labels are 0 and 1 and every entry is a number; else None."""
    ok = F.col("features").isNotNull() & F.forall("features", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    level = F.col("level") if "level" in train.columns else F.lit(0)
    labelled = F.coalesce(F.col("label").isin(0, 1), F.lit(False))
    facts = [df.agg(F.count(F.lit(1)).alias("n"), F.count_if(ok & level.isNotNull()).alias("ok"), F.count_if(labelled).alias("labelled"),
                    F.min(F.size("features")).alias("least"), F.max(F.size("features")).alias("most")).first() for df in (train, test)]
    (a, b), sizes = facts, {x for f in facts if f["n"] for x in (f["least"], f["most"])}
    if not a["n"] or any(f["ok"] < f["n"] for f in facts) or a["labelled"] < a["n"] or len(sizes) != 1:
        return None
    from pyspark.ml.functions import vector_to_array

    dense, wide = int(a["most"]), train.select(F.size(vector_to_array("fv"))).first()[0]
    if not dense or a["n"] * dense > VALUES or b["n"] * dense > VALUES:
        return None
    return Width(dense, wide - dense + 1 if wide > dense else 0)


def grow(rows: DataFrame, plan: list[Growth], width: Width, seed: int, keep: bool = False) -> DataFrame:
    """All growths of ``plan`` on ``rows`` (pos, id, label, level, features,
    and the fits it trains and tests, see ``_members``): their runs of trees,
    and with ``keep`` their nodes; written once."""
    spark, fits = rows.sparkSession, max(g.fit for g in plan) + 1
    cuts = find_cuts(rows, fits, width)
    blocks = materialize(rows.mapInArrow(_blocks(fits, cuts), _BLOCK))
    packs = {(g.fit, p) for g in plan for p in ([-1] if g.family == TREE else range(-(-max(g.sizes) // PACK)))}
    table = F.broadcast(spark.createDataFrame(sorted(packs), "fit int, pack int"))  # one row per task
    key = ["fit", "pack"]
    dealt = blocks.join(table, "fit").repartition(4 * len(packs), *key)
    return materialize(dealt.groupBy(*key).applyInArrow(_grow(plan, cuts, width, seed, keep), _GROWN))


def predictions(grown: DataFrame, plan: list[Growth]) -> DataFrame:
    """(fit, family, min_rows, depth, size, id, label, probability,
    prediction) of the test rows; an even vote goes to class 0."""
    sizes = {(g.fit, g.family, g.min_rows): g.sizes for g in plan}
    return grown.where(F.col("tree").isNull()).groupBy(*_KEY).applyInArrow(_mean(sizes), _PREDICTED)


# ---------------------------------------------------------------- models

class Model:
    """The trees of a growth with ``keep`` (one fit, one depth limit of a
    family), as what ``estimator`` fits.  The nodes stay in their table; a
    pyspark.ml model is written from there, without the driver holding it."""

    def __init__(self, grown: DataFrame, family: str, estimator, width: Width):
        self._trees, self._estimator, self._width = grown.where((F.col("family") == family) & F.col("tree").isNotNull()), estimator, width

    @cached_property
    def _about(self):
        return self._trees.agg(F.max("levels").alias("depth"), F.count(F.lit(1)).alias("trees")).first()

    @property
    def depth(self) -> int:
        return int(self._about["depth"])

    @property
    def getNumTrees(self) -> int:  # noqa: N802  pyspark.ml's name
        return int(self._about["trees"])

    def write(self) -> Model:
        return self

    def save(self, path: str) -> None:
        """As pyspark.ml saves it; what is no node comes from a fit of the
        estimator on two rows."""
        from pyspark.ml.functions import array_to_vector

        spark = self._trees.sparkSession
        two = spark.createDataFrame([(0,), (1,)], "label int").withColumn("fv", array_to_vector(F.array_repeat(F.lit(0.0), self._width.all)))
        self._estimator.fit(two).write().save(path)
        saved = spark.read.parquet(f"{path}/data").schema
        names = ["feature", "threshold", "left", "zero", "one", "gain"]
        node = self._trees.select("tree", F.posexplode(F.arrays_zip(*names)).alias("id", "n")).select("tree", "id", *[f"n.{c}" for c in names])
        total, inner = F.col("zero") + F.col("one"), F.col("left") >= 0
        split = F.struct(F.col("feature").alias("featureIndex"), F.when(inner, F.array("threshold")).otherwise(
            F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
        cols = {"id": F.col("id"), "prediction": F.when(F.col("one") > F.col("zero"), 1.0).otherwise(0.0),
                "impurity": 1 - F.pow(F.col("zero") / total, 2) - F.pow(F.col("one") / total, 2), "impurityStats": F.array("zero", "one"),
                "rawCount": total, "gain": F.col("gain"), "leftChild": F.col("left"), "rightChild": F.when(inner, F.col("left") + 1).otherwise(-1),
                "split": split}
        forest = "treeID" in saved.names
        whole = F.struct(*[cols[f.name].cast(f.dataType).alias(f.name) for f in (saved["nodeData"].dataType if forest else saved)])
        out = node.select(F.col("tree").alias("treeID"), whole.alias("nodeData")) if forest else node.select(whole.alias("n")).select("n.*")
        out.write.mode("overwrite").parquet(f"{path}/data")
