"""Trees and forests grown in tasks, against pyspark.ml and plain Python."""

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.sql import functions as F

from bourse.operators import knn
from bourse.plans import grow as gr
from bourse.plans import learn as ln
from bourse.plans import selection as sel
from bourse.plans import trees as tr
from tests.test_learning import table


@pytest.fixture(scope="module")
def sets(spark):
    rows, layout = ln.assemble(table(spark, 160, 6, 3), "label", ["ticker_index", "date"])
    train, test = ln.training_sets(rows.cache(), layout)
    return train.withColumn("row_idx", F.col("id")).cache(), test.cache(), layout


def grown(train, test, plan, width, keep=False):
    asked = test.withColumn("_pos", F.col("id"))
    rows = sel._grown_rows(train, "row_idx", F.lit(0), F.lit(None)).unionByName(sel._grown_rows(asked, "_pos", F.lit(None), F.lit(0)))
    return gr.grow(rows, plan, width, ln.SEED, keep)


def by_id(pred):
    return {r.id: (r.prediction, r.probability) for r in pred.collect()}


def plain_thresholds(x, bins=32):
    """pyspark.ml's loop over the distinct values."""
    values = sorted(set(x))
    counts = [sum(1 for v in x if v == u) for u in values]
    splits = min(bins, len(x)) - 1
    if len(values) - 1 <= splits:
        return [(a + b) / 2 for a, b in zip(values, values[1:])]
    stride, out, now = len(x) / (splits + 1), [], counts[0]
    target = stride
    for i in range(1, len(values)):
        before, now = now, now + counts[i]
        if abs(before - target) < abs(now - target):
            out.append((values[i - 1] + values[i]) / 2)
            target += stride
    return out


@pytest.mark.parametrize("seed", range(6))
def test_thresholds(seed):
    rng = np.random.default_rng(seed)
    for x in (rng.normal(size=200), rng.integers(0, 60, 300).astype(float), rng.integers(0, 5, 50).astype(float), np.repeat([1.0, 2.0], [90, 1]),
              np.round(rng.exponential(size=400), 1), rng.normal(size=7), np.ones(9)):
        assert list(gr.thresholds(x)) == plain_thresholds(list(x))


def test_trees_are_those_of_pyspark(spark, sets):
    train, test, layout = sets
    width = gr.suits(train, test)
    assert width == gr.Width(len(layout.columns), layout.levels) and width.all == layout.width()
    plan = [gr.Growth(0, gr.TREE, m, (1, 3, 30), (1,)) for m in (1, 2, 5)]
    got = gr.predictions(grown(train, test, plan, width), plan).cache()
    for split in (2, 5, 10):
        for depth in (1, 3, 30):
            want = by_id(ln.predict(ln.decision_tree(depth, split).fit(train), test))
            mine = by_id(got.where((F.col("min_rows") == ln.min_rows(split)) & (F.col("depth") == depth)))
            assert mine.keys() == want.keys() and all(mine[i] == (c, pytest.approx(p, abs=1e-12)) for i, (c, p) in want.items())


def test_one_growth_answers_depths_and_sizes(spark, sets):
    """A limited, smaller forest is part of the large one, whatever the
    partitions; trees of a forest differ."""
    train, test, _ = sets
    width = gr.suits(train, test)
    plan = [gr.Growth(0, gr.FOREST, 2, (2, 4, 30), (3, 12, 25))]
    all_ = gr.predictions(grown(train, test, plan, width), plan).cache()
    assert all_.groupBy("depth", "size").count().where(f"count = {test.count()}").count() == 9
    for depth, size in ((2, 3), (4, 12), (30, 25)):
        one = [gr.Growth(0, gr.FOREST, 2, (depth,), (size,))]
        alone = by_id(gr.predictions(grown(train.repartition(7), test.repartition(3), one, width), one))
        part = by_id(all_.where(f"depth = {depth} and size = {size}"))
        assert part.keys() == alone.keys() and all(part[i] == (c, pytest.approx(p, abs=1e-12)) for i, (c, p) in alone.items())
    assert len({p for _, p in by_id(all_.where("depth = 30 and size = 25")).values()}) > 10


@pytest.mark.parametrize("family, kind", [("DecisionTree", DecisionTreeClassificationModel), ("RandomForest", RandomForestClassificationModel)])
def test_grown_model_is_a_pyspark_model(spark, sets, tmp_path, family, kind):
    train, test, layout = sets
    params = {"max_depth": 6, "min_samples_split": 2, "n_estimators": 12}
    fitted = sel._grow_best({family: params if family == "RandomForest" else {k: params[k] for k in ("max_depth", "min_samples_split")}},
                            train, test, gr.suits(train, test))[family]
    fitted.model.write().save(f"{tmp_path}/m")
    model, want = kind.load(f"{tmp_path}/m"), by_id(fitted.predictions)
    assert (tr.depth_of(fitted.model), tr.trees_of(fitted.model)) == (tr.depth_of(model), tr.trees_of(model))
    forest = tr.node_table(spark, f"{tmp_path}/m", tr.depth_of(fitted.model), tr.trees_of(fitted.model))
    for got in (by_id(ln.predict(model, test)), by_id(tr.score(forest, test.select("id", "features", "level"), value=layout.value))):
        assert got.keys() == want.keys()
        assert all(abs(got[i][1] - p) < 1e-9 and (got[i][0] == c or abs(p - 0.5) < 1e-9) for i, (c, p) in want.items())


def test_what_does_not_suit(spark, sets, monkeypatch):
    train, test, _ = sets
    assert gr.suits(train.withColumn("label", F.when(F.col("id") > 3, F.col("label"))), test) is None
    assert gr.suits(train.withColumn("label", F.lit(2)), test) is None
    assert gr.suits(train, test.withColumn("features", F.when(F.col("id") != test.first().id, F.col("features")))) is None
    assert gr.suits(train.withColumn("features", F.transform("features", lambda x: x / F.lit(float("inf")) * F.lit(float("inf")))), test) is None
    monkeypatch.setattr(gr, "VALUES", train.count() * 4 - 1)
    assert gr.suits(train, test) is None


def test_search_grows_its_fits_in_tasks(spark, sets, monkeypatch):
    """No fit of pyspark.ml, by a job per group of nodes, where a task holds
    the rows; where not, the same points are fitted and trees score the same."""
    train, test, layout = sets
    monkeypatch.setattr(sel, "TREE_GRID", {"max_depth": [2, None], "min_samples_split": [2, 5]})
    monkeypatch.setattr(sel, "FOREST_GRID", {"n_estimators": [2, 11], "max_depth": [3, None], "min_samples_split": [2]})
    monkeypatch.setattr(sel, "KNN_GRID", {"n_neighbors": [3], "weights": ["uniform"], "p": [2]})
    rows = train.drop("row_idx")

    def scores():
        found = sel.search(rows, test, value=layout.value, order=["id"])
        return {(r.model, r.params): list(r.scores) for r in found.points.collect()}, {r.model: r for r in found.families.collect()}

    fits = []
    real = sel.estimator
    with monkeypatch.context() as m:
        m.setattr(sel, "estimator", lambda family, params: type("Counted", (), {"fit": lambda self, df: fits.append(family) or real(family, params).fit(df)})())
        grown_, heads = scores()
        assert not fits
        m.setattr(gr, "VALUES", 0)
        fitted, other = scores()
        assert fits
    assert grown_.keys() == fitted.keys() and all(len(s) == 3 for s in grown_.values())
    for point, s in fitted.items():
        if point[0] != "RandomForest":
            assert grown_[point] == pytest.approx(s)
    assert heads["DecisionTree"] == other["DecisionTree"] and heads["KNN"] == other["KNN"]


def test_votes_of_all_points_at_once(spark):
    lists = spark.createDataFrame([(1, 1, 7, 0.0, 1), (1, 2, 8, 1.0, 0), (1, 3, 9, 2.0, 0), (2, 1, 7, 0.5, 0), (2, 2, 9, 4.0, 1)],
                                  "id long, rank int, train_id long, distance double, label int")
    queries = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "id long, label int")
    got = {(r.k, r.weights, r.id): (r.prediction, r.probability) for r in knn.votes(lists, queries, [(1, "uniform"), (3, "uniform"), (3, "distance")]).collect()}
    assert got == {(1, "uniform", 1): (1, 1.0), (1, "uniform", 2): (0, 0.0), (3, "uniform", 1): (0, pytest.approx(1 / 3)), (3, "uniform", 2): (0, 0.5),
                   (3, "distance", 1): (1, 1.0), (3, "distance", 2): (0, pytest.approx(0.25 / 2.25)),
                   **{(k, w, 3): (None, None) for k, w in ((1, "uniform"), (3, "uniform"), (3, "distance"))}}
    with pytest.raises(ValueError):
        knn.votes(lists, queries, [(1, "other")])
