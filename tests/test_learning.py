"""Node tables, the search, the feature layout and committed runs."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from bourse.operators import knn
from bourse.plans import evaluate as ev
from bourse.plans import learn as ln
from bourse.plans import selection as sel
from bourse.plans import trees as tr
from bourse.sources import artifacts as art

# The reference's saved report.
GOLDEN = {"accuracy": 0.602, "best_params": {"max_depth": 5, "min_samples_split": 2, "n_estimators": 100},
          "confusion_matrix": [[125, 1], [85, 5]], "model_name": "RandomForest", "precision_score of positive class (test-set)": 0.833,
          "classification_report": {
              "0": {"f1-score": 0.7440476190476191, "precision": 0.5952380952380952, "recall": 0.9920634920634921, "support": 126.0},
              "1": {"f1-score": 0.10416666666666667, "precision": 0.8333333333333334, "recall": 0.05555555555555555, "support": 90.0},
              "accuracy": 0.6018518518518519,
              "macro avg": {"f1-score": 0.42410714285714285, "precision": 0.7142857142857143, "recall": 0.5238095238095238, "support": 216.0},
              "weighted avg": {"f1-score": 0.4774305555555556, "precision": 0.6944444444444444, "recall": 0.6018518518518519, "support": 216.0}}}


def table(spark, n=160, tickers=5, seed=0):
    """Rows like a preprocessed table: ticker number, date, features, split."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x = rng.normal(size=3)
        t = i % tickers
        rows.append((t, f"2020-{1 + i // 14:02d}-{1 + i % 14:02d}", *map(float, x), int(rng.integers(0, 9)),
                     int(x[0] + 0.4 * (t == 2) + 0.3 * rng.normal() > 0), "train" if i < n * 0.6 else "validation" if i < n * 0.8 else "test"))
    return spark.createDataFrame(rows, "ticker_index int, date string, a double, b double, c double, k int, label int, split string").withColumn(
        "date", F.to_date("date"))


@pytest.fixture(scope="module")
def sets(spark):
    rows, layout = ln.assemble(table(spark), "label", ["ticker_index", "date"])
    train, test = ln.training_sets(rows.cache(), layout)
    return train.cache(), test.cache(), layout


def test_layout_and_order(sets):
    train, test, layout = sets
    assert layout == (["a", "b", "c", "k"], "ticker_index", 5) and layout.width() == 8
    ids = sorted(r.id for r in train.union(test).select("id").collect())
    assert ids == list(range(160))
    at = {r.id: r.level for r in train.union(test).select("id", "level").collect()}
    assert [at[i] for i in range(160)] == sorted(at.values())  # ticker, then date
    layout.check(layout._replace(levels=3))
    for other in (layout._replace(columns=["a", "b", "k", "c"]), layout._replace(columns=["a", "b", "c"]), layout._replace(level=None), layout._replace(levels=6)):
        with pytest.raises(ln.LayoutError):
            layout.check(other)


def test_vector_and_value_agree(spark, sets):
    train, _, layout = sets
    numbers = F.array(*[F.coalesce(layout.value(F.lit(i)), F.lit(-99.0)) for i in range(layout.width())])
    from pyspark.ml.functions import vector_to_array
    for r in train.select(vector_to_array("fv").alias("v"), numbers.alias("n"), "level").collect():
        assert list(r.v) == list(r.n)
        assert sum(r.v[4:]) == (r.level > 0)


def test_level_weight_is_the_scale_of_the_indicators(sets):
    """Distances with the level equal those over standardised indicators."""
    train, test, layout = sets
    rows, asked = train.collect(), test.collect()
    level = np.array([r.level for r in rows])
    hot = np.eye(5)[:, 1:]
    std = np.where(hot[level].std(0) > 1e-15, hot[level].std(0), 1)
    x = np.array([[*r.features, *(hot[r.level] / std)] for r in rows])
    found = {}
    for r in sorted(knn.neighbours(sel._knn_rows(train), sel._knn_rows(test), 4, 1).lists.collect(), key=lambda r: r.rank):
        found.setdefault(r.id, []).append((r.train_id, r.distance))
    for q in asked:
        d = np.abs(x - np.array([*q.features, *(hot[q.level] / std)])).sum(1)
        best = sorted(zip(d, [r.id for r in rows]))[:4]
        assert [a for a, _ in found[q.id]] == [i for _, i in best]
        assert [b for _, b in found[q.id]] == pytest.approx([b for b, _ in best])


@pytest.mark.parametrize("family", ["DecisionTree", "RandomForest"])
@pytest.mark.parametrize("limit", [tr.BROADCAST_NODES, 0])
def test_node_table_equals_the_model(spark, sets, tmp_path, monkeypatch, family, limit):
    train, test, layout = sets
    monkeypatch.setattr(tr, "BROADCAST_NODES", limit)
    params = {"max_depth": 6, "min_samples_split": 2, "n_estimators": 7}
    model = sel.estimator(family, params).fit(train)
    model.write().save(f"{tmp_path}/m")
    forest = tr.node_table(spark, f"{tmp_path}/m", tr.depth_of(model), tr.trees_of(model))
    want = {r.id: (r.prediction, r.probability) for r in ln.predict(model, test).collect()}
    got = {r.id: (r.prediction, r.probability) for r in tr.score(forest, test.select("id", "features", "level"), value=layout.value).collect()}
    assert got.keys() == want.keys()
    for i, (c, p) in want.items():
        assert got[i][1] == pytest.approx(p, abs=1e-12) and (got[i][0] == c or abs(p - 0.5) < 1e-9)
    if family == "RandomForest":  # the first trees are a smaller forest
        three = {r.id: r.probability for r in tr.score(forest, test.select("id", "features", "level"), [3, 7], layout.value).where("size = 3").collect()}
        shares = tr.leaves(forest, test.select("id", "features", "level"), layout.value).where("tree < 3").groupBy("id").agg(F.avg("share").alias("p"))
        assert three == {r.id: pytest.approx(r.p) for r in shares.collect()}


def test_single_leaf_and_one_class(spark, tmp_path):
    rows = ln.as_vectors(spark.createDataFrame([(i, [float(i)], 0, "train") for i in range(6)], "id long, features array<double>, label int, split string"))
    model = ln.decision_tree().fit(rows)
    model.write().save(f"{tmp_path}/m")
    forest = tr.node_table(spark, f"{tmp_path}/m", tr.depth_of(model), 1)
    assert forest.depth == 0 and {r.probability for r in tr.score(forest, rows.select("id", "features")).collect()} == {0.0}
    assert {(r.prediction, r.probability) for r in ln.predict(model, rows).collect()} == {(0, 0.0)}


def test_search_scores_every_point(spark, sets, monkeypatch):
    train, test, layout = sets
    monkeypatch.setattr(sel, "TREE_GRID", {"max_depth": [2, None], "min_samples_split": [2]})
    monkeypatch.setattr(sel, "FOREST_GRID", {"n_estimators": [2, 4], "max_depth": [3], "min_samples_split": [2]})
    monkeypatch.setattr(sel, "KNN_GRID", {"n_neighbors": [1, 3], "weights": ["uniform", "distance"], "p": [1, 2]})
    found = sel.search(train, test, value=layout.value, order=["id"])
    rows = found.points.collect()
    assert len(rows) == 2 + 2 + 8 and all(len(r.scores) == 3 and r.mean_score == pytest.approx(sum(r.scores) / 3) for r in rows)
    # the winner is the best test precision of the families' best points
    best = {r.model: r.point for r in sel.best_points(found.points).collect()}
    for family, point in best.items():
        mine = [r for r in rows if r.model == family]
        top = max(r.mean_score for r in mine)
        assert point == min(r.point for r in mine if r.mean_score == top)
        chosen = next(r for r in mine if r.point == point)
        assert found.families.where(F.col("model") == family).first().params == chosen.params
    top = max(found.families.collect(), key=lambda r: (r.metric, -r.model_order))
    assert (top.model, top.params) == (found.winner.family, json.dumps(found.winner.params, sort_keys=True))
    assert ev.headline(found.winner.predictions).first()["precision_1"] == top.metric
    # a tree point by hand
    folded = ln.fold_ids(train, 3)
    part = folded.where("test_fold = 1")
    early = folded.where(F.col("row_idx") < part.agg(F.min("row_idx")).first()[0])
    pred = ln.predict(sel.estimator("DecisionTree", {"max_depth": 2, "min_samples_split": 2}).fit(early), part)
    want = sel._precision(pred.withColumn("g", F.lit(0)), ["g"])[0][1]
    assert next(r for r in rows if r.model == "DecisionTree" and r.point == 0).scores[1] == pytest.approx(want)


def test_grid_has_the_points_of_the_reference():
    assert [len(sel.points(g)) for g in (sel.TREE_GRID, sel.FOREST_GRID, sel.KNN_GRID)] == [12, 18, 16]


def test_report_equals_the_saved_one(spark):
    counts = [(0, 0)] * 125 + [(0, 1)] + [(1, 0)] * 85 + [(1, 1)] * 5
    doc = art.report_of(spark.createDataFrame(counts, "label int, prediction int"), "RandomForest", GOLDEN["best_params"])
    assert doc.keys() == GOLDEN.keys()
    report, want = doc.pop("classification_report"), dict(GOLDEN)
    full = want.pop("classification_report")
    assert doc == want
    assert report["accuracy"] == pytest.approx(full["accuracy"])
    assert {k: pytest.approx(v) for k, v in full.items() if k != "accuracy"} == {k: v for k, v in report.items() if k != "accuracy"}


def test_runs_are_whole_or_absent(spark, sets, tmp_path, monkeypatch):
    train, test, layout = sets
    folder = f"{tmp_path}/runs"
    with pytest.raises(FileNotFoundError):
        art.load_run(spark, folder)
    first = sel.fit_predict("DecisionTree", {"max_depth": 3, "min_samples_split": 2}, train, test)
    one = art.save_run(spark, folder, first, layout)
    want = {r.id: r.probability for r in first.predictions.collect()}

    def loaded():
        run = art.load_run(spark, folder, layout)
        return run, {r.id: r.probability for r in ln.predict(run.model(spark), test).collect()}

    assert loaded()[1] == want
    # a run that breaks between its writes leaves the old one
    second = sel.fit_predict("RandomForest", {"n_estimators": 3, "max_depth": 2, "min_samples_split": 2}, train, test)
    for broken in ("write_report", "_commit"):
        with monkeypatch.context() as m:
            m.setattr(art, broken, lambda *a: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                art.save_run(spark, folder, second, layout)
        run, got = loaded()
        assert got == want and run.manifest["model_name"] == "DecisionTree"
    two = art.save_run(spark, folder, second, layout)
    assert two > one and loaded()[0].manifest["model_name"] == "RandomForest"
    assert art.load_run(spark, folder, name=one).manifest["model_name"] == "DecisionTree"
    with pytest.raises(ln.LayoutError):
        art.load_run(spark, folder, layout._replace(columns=["a"]))
    # KNN keeps its training rows
    art.save_run(spark, folder, sel.fit_predict("KNN", sel.DEFAULTS["KNN"], train, test), layout)
    rows = art.load_run(spark, folder, layout).model(spark)
    assert rows.count() == train.count()
    # a changed file is refused
    run = art.load_run(spark, folder, name=two)
    path = next((tmp_path / "runs" / run.manifest["run"] / "report").glob("part-*"))
    path.write_text(path.read_text().replace("0", "1", 1))
    with pytest.raises(art.CorruptRunError):
        art.load_run(spark, folder, name=two)


@pytest.mark.parametrize("limit", [1, 30, 60])
def test_large_forest_is_walked_in_packs_of_trees(spark, sets, tmp_path, monkeypatch, limit):
    """A forest above the limit is broadcast some trees at a time; only trees
    above it are joined by a shuffle."""
    train, test, layout = sets
    model = sel.estimator("RandomForest", {"max_depth": 3, "min_samples_split": 2, "n_estimators": 6}).fit(train)
    model.write().save(f"{tmp_path}/m")
    forest = tr.node_table(spark, f"{tmp_path}/m", tr.depth_of(model), 6)
    seen, walk = [], tr._walk
    monkeypatch.setattr(tr, "BROADCAST_NODES", limit)
    monkeypatch.setattr(tr, "_walk", lambda *a: seen.append((a[2], a[5])) or walk(*a))
    rows = test.select("id", "features", "level")
    got = {(r.id, r.tree): r.share for r in tr.leaves(forest, rows, layout.value).collect()}
    sizes = {r.tree: r["count"] for r in forest.nodes.groupBy("tree").count().collect()}
    assert sorted(t for trees, _ in seen for t in trees) == list(range(6))
    assert all((sum(sizes[t] for t in trees) <= limit) if small else min(sizes[t] for t in trees) > limit for trees, small in seen)
    monkeypatch.setattr(tr, "BROADCAST_NODES", 10**6)
    assert got == {(r.id, r.tree): r.share for r in tr.leaves(forest, rows, layout.value).collect()} and len(got) == 6 * test.count()


def test_every_fold_lies_in_every_partition(spark, sets, monkeypatch):
    """Range-sorted folds would leave a fold's rows in a few partitions."""
    train, _, _ = sets
    monkeypatch.setattr(sel, "FIT_ROWS", 32)
    folded = sel._dealt(ln.fold_ids(train, 3))
    assert folded.rdd.getNumPartitions() == 4 and folded.count() == train.count()
    where = folded.select("test_fold", "row_idx", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("m")).collect()
    assert {(r.test_fold, r.p) for r in where} == {(f, p) for f in (None, 0, 1, 2) for p in range(4)}
    for p in range(4):
        mine = [r.row_idx for r in sorted(where, key=lambda r: r.m) if r.p == p]
        assert mine == sorted(mine)
