"""Model selection (L05, L06, L08, L10): three families on expanding folds.

The grid has 46 points (12 trees, 18 forests, 16 k-nearest-neighbour voters)
on 3 folds: 138 scores.  What points share is computed once:

* the folds are cut and written once, every fold spread over all partitions,
* trees and forests whose rows a task can hold are grown there (``grow``), all
  folds in one job: one growth per fold, split and tree answers every depth
  limit, and a forest's first 50, 100 and 200 trees are the three sizes,
* larger ones are fitted by pyspark.ml, a forest of the largest size per fold,
  depth and split (``trees.score``); a fit shuffles the histograms of every
  node once per partition, so there is one per ``FIT_ROWS`` rows,
* one neighbour list per fold and distance, as long as the largest k, answers
  every k and weighting (``knn.votes``).

Jobs run through a pool of ``WORKERS`` driver threads, each of which only
submits Spark jobs.  The best point of each family is refitted on all
training rows and scored on the test rows; the family with the highest test
precision wins (the reference's selection leak, kept), the first one on ties.

Rows are (id, label, split, features array<double>) from ``assemble``, and
level / weight where a categorical column is carried as a level.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from itertools import product
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import knn
from ..operators.persist import materialize
from ..session import checkpoint_dir
from . import evaluate as ev
from . import grow as gr
from . import learn as ln
from . import trees as tr

FAMILIES = ("DecisionTree", "RandomForest", "KNN")
WORKERS = 2  # a driver plans and tracks so many jobs at once
N_SPLITS = 3
FIT_ROWS = 16_384  # rows per partition of a fit
# The reference's search space.  A depth of None is no limit.
TREE_GRID = {"max_depth": [3, 5, 10, None], "min_samples_split": [2, 5, 10]}
FOREST_GRID = {"n_estimators": [50, 100, 200], "max_depth": [5, 10, None], "min_samples_split": [2, 5]}
KNN_GRID = {"n_neighbors": [3, 5, 7, 9], "weights": ["uniform", "distance"], "p": [1, 2]}
DEFAULTS = {"DecisionTree": {"max_depth": 5, "min_samples_split": 2},
            "RandomForest": {"n_estimators": 100, "max_depth": 5, "min_samples_split": 2},
            "KNN": {"n_neighbors": 5, "weights": "uniform", "p": 2}}


class Fitted(NamedTuple):
    family: str
    params: dict
    model: object          # a pyspark.ml model, a grown one (``grow.Model``), or the training rows of KNN
    predictions: DataFrame  # id, label, prediction, probability


class Selection(NamedTuple):
    points: DataFrame       # model, model_order, point, params, scores, mean_score
    families: DataFrame     # model, model_order, params, metric, accuracy
    winner: Fitted


def points(grid: dict) -> list[dict]:
    return [dict(zip(grid, values)) for values in product(*grid.values())]


def _key(params: dict) -> str:
    return json.dumps(params, sort_keys=True)


def _depth(params: dict) -> int:
    return ln.MAX_DEPTH_NONE if params["max_depth"] is None else params["max_depth"]


def estimator(family: str, params: dict):
    depth = _depth(params)
    if family == "DecisionTree":
        return ln.decision_tree(depth, params["min_samples_split"])
    return ln.random_forest(params["n_estimators"], depth, params["min_samples_split"])


def _knn_rows(df: DataFrame) -> DataFrame:
    level = "level" if "level" in df.columns else None
    return knn.rows_of(df, level=level, weight="weight" if level else None)


def fit_predict(family: str, params: dict, train: DataFrame, test: DataFrame) -> Fitted:
    """L03 / L04 / L05 with L09: fit on ``train``, predict ``test``.  Both
    have the vector column ``fv`` next to ``features``."""
    if family == "KNN":
        found = knn.neighbours(_knn_rows(train), _knn_rows(test), params["n_neighbors"], params["p"])
        return Fitted(family, params, train, knn.vote(found.lists, test, params["n_neighbors"], params["weights"]))
    model = estimator(family, params).fit(train)
    return Fitted(family, params, model, ln.predict(model, test))


def _forest(train: DataFrame, params: dict, name: str) -> tr.Forest:
    """A fitted forest as its node table."""
    model = estimator("RandomForest", params).fit(train)
    path = f"{checkpoint_dir(train.sparkSession).rstrip('/')}/{name}-{model.uid}"
    model.write().overwrite().save(path)
    return tr.node_table(train.sparkSession, path, tr.depth_of(model), tr.trees_of(model))


def _precision(pred: DataFrame, by: list[str]) -> list:
    """Class-1 precision per group, 0 without a predicted 1."""
    tp, fp = F.count_if((F.col("prediction") == 1) & (F.col("label") == 1)), F.count_if((F.col("prediction") == 1) & (F.col("label") == 0))
    return [(*[r[c] for c in by], r["tp"] / (r["tp"] + r["fp"]) if r["tp"] + r["fp"] else 0.0)
            for r in pred.groupBy(*by).agg(tp.alias("tp"), fp.alias("fp")).collect()]


def _grown_rows(df: DataFrame, pos: str, since, test):
    """Rows for ``grow``: they train the fits from ``since`` on and test one."""
    level = F.col("level").cast("int") if "level" in df.columns else F.lit(0)
    return df.select(F.col(pos).cast("long").alias("pos"), F.col("id").cast("long").alias("id"), F.col("label").cast("int").alias("label"),
                     level.alias("level"), F.col("features").cast("array<double>").alias("features"),
                     since.cast("int").alias("since"), test.cast("int").alias("test"))


def _grow_folds(folded: DataFrame, cuts: dict, width: gr.Width) -> dict:
    """The scores of all tree and forest points on all folds."""
    wanted = [(TREE_GRID, "DecisionTree", (1,)), (FOREST_GRID, "RandomForest", tuple(sorted(FOREST_GRID["n_estimators"])))]
    plan, names = [], {}
    for f in cuts:
        for grid, family, sizes in wanted:
            depths = tuple(sorted({_depth(p) for p in points(grid)}))
            plan += [gr.Growth(f, family, m, depths, sizes) for m in sorted({ln.min_rows(p["min_samples_split"]) for p in points(grid)})]
            for p in points(grid):
                names.setdefault((f, family, ln.min_rows(p["min_samples_split"]), _depth(p), p.get("n_estimators", 1)), []).append(_key(p))
    since = F.lit(None)
    for f in sorted(cuts, reverse=True):
        since = F.when(F.col("row_idx") < cuts[f], f).otherwise(since)
    # a row trains every fold from the first whose cut is behind it
    rows = _grown_rows(folded, "row_idx", since, F.col("test_fold"))
    pred = gr.predictions(gr.grow(rows, plan, width, ln.SEED), plan)
    return {(at[1], key, at[0]): score for *at, score in _precision(pred, ["fit", "family", "min_rows", "depth", "size"]) for key in names.get(tuple(at), [])}


def _grow_best(best: dict, folded: DataFrame, test: DataFrame, width: gr.Width) -> dict[str, Fitted]:
    """The trees and forests of ``best`` fitted on all training rows."""
    plan = [gr.Growth(0, f, ln.min_rows(p["min_samples_split"]), (_depth(p),), (p.get("n_estimators", 1),)) for f, p in best.items()]
    asked = materialize(test.withColumn("_pos", F.monotonically_increasing_id()))
    rows = _grown_rows(folded, "row_idx", F.lit(0), F.lit(None)).unionByName(_grown_rows(asked, "_pos", F.lit(None), F.lit(0)))
    grown = gr.grow(rows, plan, width, ln.SEED, keep=True)
    pred = materialize(gr.predictions(grown, plan))
    out = {}
    for f, p in best.items():
        mine = pred.where(F.col("family") == f).select("id", "label", "prediction", "probability")
        out[f] = Fitted(f, p, gr.Model(grown, f, estimator(f, p), width), mine)
    return out


def _cuts(folded: DataFrame, n_splits: int) -> dict:
    """The first row of each test block."""
    rows = folded.where(F.col("test_fold").isNotNull()).groupBy("test_fold").agg(F.min("row_idx").alias("at")).collect()
    return {r["test_fold"]: r["at"] for r in rows}


def _fold_jobs(folded: DataFrame, value, n_splits: int, width: gr.Width | None = None):
    """(name, job) of all fits; a job gives {(family, params, fold): score}.
    With a ``width`` trees and forests are grown in tasks."""
    cuts = _cuts(folded, n_splits)
    if width is not None:
        yield lambda w: _grow_folds(folded, cuts, w), width
    for f in reversed(range(n_splits)):  # the longest fits first
        train, test = folded.where(F.col("row_idx") < cuts[f]), folded.where(F.col("test_fold") == f)

        def tree(params, train=train, test=test, f=f):
            pred = ln.predict(estimator("DecisionTree", params).fit(train), test).withColumn("g", F.lit(0))
            return {("DecisionTree", _key(params), f): p for _, p in _precision(pred, ["g"])}

        def forest(params, train=train, test=test, f=f):
            sizes = FOREST_GRID["n_estimators"]
            grown = _forest(train, params | {"n_estimators": max(sizes)}, f"fold-{f}")
            rows = test.select("id", "features", *(["level"] if "level" in test.columns else []))
            pred = tr.score(grown, rows, sizes, value).join(test.select("id", "label"), "id")
            return {("RandomForest", _key({"n_estimators": n} | params), f): p for n, p in _precision(pred, ["size"])}

        def near(p, train=train, test=test, f=f):
            lists = knn.neighbours(_knn_rows(train), _knn_rows(test), max(KNN_GRID["n_neighbors"]), p).lists
            rest = {(x["n_neighbors"], x["weights"]): _key(x) for x in points(KNN_GRID) if x["p"] == p}
            pred = knn.votes(lists, test, list(rest))
            return {("KNN", rest[k, w], f): s for k, w, s in _precision(pred, ["k", "weights"])}

        if width is None:
            for params in reversed(points({k: v for k, v in FOREST_GRID.items() if k != "n_estimators"})):
                yield forest, params
        for p in KNN_GRID["p"]:
            yield near, p
        if width is None:
            for params in points(TREE_GRID):
                yield tree, params


def _dealt(folded: DataFrame) -> DataFrame:
    """The folds in partitions by a hash of the row's position, written; the
    order inside is fixed, since a forest draws its rows in it."""
    folded = materialize(folded)
    parts = max(1, -(-folded.count() // FIT_ROWS))
    return materialize(folded.repartition(parts, "row_idx").sortWithinPartitions("row_idx"))


def _headline(pred: DataFrame) -> tuple[float, float]:
    h = ev.headline(pred).first()
    return float(h["precision_1"]), float(h["accuracy"])


def search(train: DataFrame, test: DataFrame, n_splits: int = N_SPLITS, workers: int = WORKERS, value=tr.dense_value,
           order: list[str] | None = None) -> Selection:
    """L06 + L08 (see the module)."""
    spark = train.sparkSession
    folded = _dealt(ln.fold_ids(train, n_splits, order))
    width = gr.suits(folded, test)
    scores: dict[tuple, float] = {}
    with ThreadPoolExecutor(workers) as pool:
        for done in [pool.submit(job, arg) for job, arg in _fold_jobs(folded, value, n_splits, width)]:
            scores |= done.result()
    rows, best = [], {}
    for order_, (family, grid) in enumerate(zip(FAMILIES, (TREE_GRID, FOREST_GRID, KNN_GRID))):
        top = None
        for i, params in enumerate(points(grid)):
            got = [scores[family, _key(params), f] for f in range(n_splits)]
            mean = sum(got) / n_splits
            rows.append((family, order_, i, _key(params), got, mean))
            if top is None or mean > top:
                top, best[family] = mean, params
    table = spark.createDataFrame(rows, "model string, model_order int, point int, params string, scores array<double>, mean_score double")
    with ThreadPoolExecutor(workers) as pool:
        grown = pool.submit(_grow_best, {f: best[f] for f in FAMILIES if f != "KNN"}, folded, test, width) if width is not None else None
        others = {f: pool.submit(fit_predict, f, best[f], train if f == "KNN" else folded, test) for f in FAMILIES if f == "KNN" or grown is None}
        found = {f: x.result() for f, x in others.items()} | (grown.result() if grown else {})
    fitted = [found[f] for f in FAMILIES]
    heads = [_headline(x.predictions) for x in fitted]
    families = spark.createDataFrame([(x.family, i, _key(x.params), m, a) for i, (x, (m, a)) in enumerate(zip(fitted, heads))],
                                     "model string, model_order int, params string, metric double, accuracy double")
    name = ev.best_model(families).first()["model"]
    return Selection(table, families, next(x for x in fitted if x.family == name))


def best_points(table: DataFrame) -> DataFrame:
    """(model, point): the first point with the highest mean score of each
    family, from the result table alone."""
    return table.groupBy("model").agg(F.max_by("point", F.struct("mean_score", -F.col("point"))).alias("point"))


def default_models(train: DataFrame, test: DataFrame) -> list[Fitted]:
    """The three families with their default parameters."""
    with ThreadPoolExecutor(WORKERS) as pool:
        return list(pool.map(lambda f: fit_predict(f, DEFAULTS[f], train, test), FAMILIES))


def default_models_report(fitted: list[Fitted]) -> DataFrame:
    """Accuracy, class report and confusion counts of each model: one row
    per model and report class."""
    out = None
    for x in fitted:
        pred = materialize(x.predictions)
        counts = F.broadcast(ev.confusion_counts(pred))  # one row
        rep = ev.classification_report(pred).join(counts).withColumn("model", F.lit(x.family))
        out = rep if out is None else out.unionByName(rep)
    return out.select("model", "class", "precision", "recall", "f1_score", "support", "tn", "fp", "fn", "tp")
