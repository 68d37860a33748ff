"""Registrations of the learning queries.

What a fitted tree predicts has no SQL form; such queries return statements
about every test row or grid point that SQL can list, and that hold only if
two independent ways give the same numbers.  Neighbour searches are compared
with brute force in full.
"""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from .functions.scalar import round6
from .operators import knn
from .operators.persist import materialize
from .plans import dataset as ds
from .plans import evaluate as ev
from .plans import learn as ln
from .plans import selection as sel
from .plans import trees as tr
from .queries_catalog import _PRED, _REPORT_SQL, complete_dataset_query
from .registry import register
from .sources import artifacts as art
from .sources import io as sio
from .sources import tables as src
from .sql import fixtures as fx
from .sql import learning as sql

VECTORS = ln.Layout([f"f{i}" for i in range(64)], None, 0)


def _vector_sets(spark, d):
    v = src.vectors(spark, d).withColumn("level", F.lit(0))
    return tuple(map(materialize, ln.training_sets(v, VECTORS)))


def _agree(left, right):
    """(id, label, agree): two tables of predictions say the same."""
    r = right.select("id", F.col("probability").alias("_p"), F.col("prediction").alias("_c"))
    even = F.abs(F.col("_p") - 0.5) < 1e-9
    same = (F.abs(F.col("probability") - F.col("_p")) < 1e-9) & ((F.col("prediction") == F.col("_c")) | even)
    return left.join(r, "id", "left").select("id", "label", F.coalesce(same, F.lit(False)).alias("agree"))


def _by_nodes(spark, model, rows, layout=VECTORS):
    path = sio.scratch_path(spark, "nodes")
    model.write().save(path)
    forest = tr.node_table(spark, path, tr.depth_of(model), tr.trees_of(model))
    return tr.score(forest, rows.select("id", "features", "level"), value=layout.value)


@register("L03_decision_tree", sql.TEST_IDS)
def _l03(spark, d):
    """The tree's predictions of all test rows, by the model and by its node
    table."""
    train, test = _vector_sets(spark, d)
    fitted = sel.fit_predict("DecisionTree", sel.DEFAULTS["DecisionTree"], train, test)
    return _agree(fitted.predictions, _by_nodes(spark, fitted.model, test))


@register("L04_L09_random_forest", sql.TEST_IDS)
def _l04(spark, d):
    """As L03 with the default forest."""
    train, test = _vector_sets(spark, d)
    fitted = sel.fit_predict("RandomForest", sel.DEFAULTS["RandomForest"], train, test)
    return _agree(fitted.predictions, _by_nodes(spark, fitted.model, test))


def _lists(spark, d, p, k=9):
    train, test = _vector_sets(spark, d)
    return knn.neighbours(knn.rows_of(train), knn.rows_of(test), k, p).lists, test


@register("L05_knn_neighbours", sql.NEIGHBOURS)
def _l05_lists(spark, d):
    both = [_lists(spark, d, p)[0].withColumn("p", F.lit(p)) for p in (1, 2)]
    return both[0].unionByName(both[1]).select("p", "id", "rank", "train_id", "label", round6("distance").alias("distance"))


@register("L05_knn", sql.KNN)
def _l05(spark, d):
    out = None
    for p in (1, 2):
        lists, test = _lists(spark, d, p)
        for w in ("uniform", "distance"):
            v = knn.vote(lists, test, 5, w).withColumns({"p": F.lit(p), "weights": F.lit(w)})
            out = v if out is None else out.unionByName(v)
    return out.select("p", "weights", "id", "label", "prediction", round6("probability").alias("probability"))


def _search_rows(found: sel.Selection):
    """One row per point; ``agrees``: its mean is that of its scores, and the
    winner is the best family and point recomputed from the tables."""
    best = sel.best_points(found.points).withColumn("_best", F.lit(True))
    top = ev.best_model(found.families).first()
    rows = found.points.join(best, ["model", "point"], "left")
    chosen = found.families.select("model", F.col("params").alias("_chosen"))
    ok = (F.abs(F.col("mean_score") - F.aggregate("scores", F.lit(0.0), lambda a, x: a + x) / F.size("scores")) < 1e-12) & (
        F.col("_best").isNull() | (F.col("params") == F.col("_chosen"))) & F.lit(
        top["model"] == found.winner.family and top["params"] == json.dumps(found.winner.params, sort_keys=True))
    return rows.join(chosen, "model"), ok


@register("L06_C10_tune_and_select", sql.SEARCH)
def _l06(spark, d):
    train, test = _vector_sets(spark, d)
    rows, ok = _search_rows(sel.search(train, test))
    score = F.when(F.col("model") == "KNN", round6("mean_score"))
    return rows.select("model", "params", F.size("scores").alias("folds"), score.alias("knn_score"), ok.alias("agrees"))


_SUPPORT = """SELECT class, CASE class WHEN '0' THEN count_if(label = 0) WHEN '1' THEN count_if(label = 1) ELSE count(*) END AS support
FROM vectors, (SELECT unnest(['0', '1', 'accuracy', 'macro avg', 'weighted avg']) AS class) WHERE split = 'test' GROUP BY class"""
_KNN_COUNTS = """SELECT count_if(q_label = 1 AND probability > 0.5) AS tp, count_if(q_label = 0 AND probability > 0.5) AS fp, count(*) AS n,
  count_if((probability > 0.5) = (q_label = 1)) AS ok FROM v WHERE k = 5 AND p = 2 AND weights = 'uniform'"""


@register("L10_default_models_report", fx.with_tables(
    f"""SELECT model, class, CAST(support AS DOUBLE) AS support, true AS agrees,
  CASE WHEN model = 'KNN' AND class = '1' THEN {fx.r6('CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END')}
       WHEN model = 'KNN' AND class = 'accuracy' THEN {fx.r6('ok / n')} END AS knn_precision
FROM support, counts, (SELECT unnest(['DecisionTree', 'RandomForest', 'KNN']) AS model)""",
    **sql.test_lists(9), v=sql.votes("lists", "fold"), support=_SUPPORT, counts=_KNN_COUNTS))
def _l10(spark, d):
    """The class reports of the three default models; ``agrees``: accuracy and
    precision follow from the confusion counts of the same predictions."""
    train, test = _vector_sets(spark, d)
    rep = sel.default_models_report(sel.default_models(train, test))
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    want = (F.when(F.col("class") == "accuracy", (tn + tp) / (tn + fp + fn + tp))
            .when(F.col("class") == "1", F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0))
            .when(F.col("class") == "0", F.when(tn + fn > 0, tn / (tn + fn)).otherwise(0.0)).otherwise(F.col("precision")))
    shown = F.when((F.col("model") == "KNN") & F.col("class").isin("1", "accuracy"), round6("precision"))
    return rep.select("model", "class", "support", (F.abs(want - F.col("precision")) < 1e-12).alias("agrees"), shown.alias("knn_precision"))


def feature_sets(spark, d, ticker="type"):
    """(train, test, layout) of the preprocessed table (C09 -> C10)."""
    table = ds.preprocess(complete_dataset_query(spark, d, ticker), keep=("date",))
    rows, layout = ln.assemble(table, ds.LABEL, ["ticker_index", "date"])
    train, test = ln.training_sets(materialize(rows), layout)
    return materialize(train), materialize(test), layout


def _c10_sql():
    from .queries_catalog import _SPAN, _SPLIT_DAYS, _fill_ctes

    return fx.with_tables(
        f"""SELECT model, (SELECT count(*) FROM filled WHERE {_SPLIT_DAYS} > {_SPAN} * 0.7 + {_SPAN} * 0.15) AS n_test, points, 3 AS folds, true AS agrees
FROM (VALUES ('DecisionTree', 12), ('RandomForest', 18), ('KNN', 16)) g(model, points)""", **_fill_ctes())


@register("C10_train_on_features", _c10_sql())
def _c10(spark, d):
    """C09 -> C10: the search on the preprocessed table, the winner committed
    and loaded again.  ``agrees``: the loaded run predicts the test rows as the
    winner did, its report's accuracy is that of these predictions, and the
    point chosen for the family is the best of its points."""
    train, test, layout = feature_sets(spark, d)
    found = sel.search(train, test, value=layout.value, order=["id"])
    folder = sio.scratch_path(spark, "runs")
    art.save_run(spark, folder, found.winner, layout)
    run = art.load_run(spark, folder, layout)
    model = run.model(spark)
    again = (sel.fit_predict("KNN", found.winner.params, model, test).predictions if found.winner.family == "KNN" else ln.predict(model, test))
    wrong = _agree(found.winner.predictions, again).where(~F.col("agree")).count()
    accuracy = again.agg(F.round(F.avg((F.col("label") == F.col("prediction")).cast("int")), 3)).first()[0]
    same = wrong == 0 and abs(run.report(spark)["accuracy"] - accuracy) < 1e-9
    rows, ok = _search_rows(found)
    n = again.count()
    return rows.groupBy("model").agg(F.lit(n).cast("long").alias("n_test"), F.count(F.lit(1)).cast("int").alias("points"),
                                     F.min(F.size("scores")).alias("folds"), (F.min(ok) & F.lit(same)).alias("agrees"))


@register("S14_report_sink", fx.with_tables(
    f"""SELECT 'FixturePredictions' AS model_name, class, precision, recall, f1_score, support, accuracy, precision_1, tn, fp, fn, tp
FROM ({_REPORT_SQL}) r, (SELECT round(count_if(label = prediction) / count(*), 3) AS accuracy,
  round(CASE WHEN count_if(prediction = 1) = 0 THEN 0.0 ELSE count_if(label = 1 AND prediction = 1) / count_if(prediction = 1) END, 3) AS precision_1,
  count_if(label = 0 AND prediction = 0) AS tn, count_if(label = 0 AND prediction = 1) AS fp,
  count_if(label = 1 AND prediction = 0) AS fn, count_if(label = 1 AND prediction = 1) AS tp FROM predictions) c""", **_PRED))
def _s14(spark, d):
    """The report document of the predictions, written and read back."""
    report = art.report_of(src.predictions(spark, d), "FixturePredictions", {"source": "labels"})
    doc = art.read_report(spark, art.write_report(spark, report, sio.scratch_path(spark, "report")))
    full = doc["classification_report"]
    n = full["weighted avg"]["support"]
    rows = [(c, v["precision"], v["recall"], v["f1-score"], v["support"]) for c, v in full.items() if c != "accuracy"]
    rows.append(("accuracy", *[full["accuracy"]] * 3, n))
    (tn, fp), (fn, tp) = doc["confusion_matrix"]
    out = spark.createDataFrame(rows, "class string, precision double, recall double, f1_score double, support double")
    return out.select(F.lit(doc["model_name"]).alias("model_name"), "class", *[round6(c).alias(c) for c in ("precision", "recall", "f1_score")], "support",
                      F.lit(doc["accuracy"]).alias("accuracy"), F.lit(doc[art.METRIC_FIELD]).alias("precision_1"),
                      *[F.lit(v).cast("long").alias(c) for c, v in zip(("tn", "fp", "fn", "tp"), (tn, fp, fn, tp))])


@register("S15_model_sink_and_load", sql.TEST_IDS)
def _s15(spark, d):
    """A forest committed as a run and loaded: its predictions and those of
    its node table equal the ones before."""
    train, test = _vector_sets(spark, d)
    fitted = sel.fit_predict("RandomForest", sel.DEFAULTS["RandomForest"], train, test)
    folder = sio.scratch_path(spark, "runs")
    art.save_run(spark, folder, fitted, VECTORS)
    run = art.load_run(spark, folder, VECTORS)
    first = _agree(fitted.predictions, ln.predict(run.model(spark), test))
    second = _agree(fitted.predictions, tr.score(run.forest(spark), test.select("id", "features", "level"), value=VECTORS.value))
    return first.join(second.select("id", F.col("agree").alias("_too")), "id").select("id", "label", (F.col("agree") & F.col("_too")).alias("agree"))
