"""Oracle side of the learning queries: brute-force nearest neighbours, the
grid of points, and the rows that predictions must cover."""

from __future__ import annotations

from . import fixtures as fx

# (id, split, label, features) scaled by the mean and population std of the
# training rows, as doubles.
SCALED = {
    "vectors": fx.VECTORS,
    "tv": "SELECT * FROM vectors WHERE split IN ('train', 'validation')",
    "e": "SELECT unnest(range(1, len(features) + 1)) AS pos, unnest(features) AS x FROM tv",
    "st": "SELECT pos, avg(CAST(x AS DOUBLE)) AS mean, stddev_pop(CAST(x AS DOUBLE)) AS std FROM e GROUP BY pos",
    "sl": "SELECT list(mean ORDER BY pos) AS means, list(CASE WHEN std > 1e-15 THEN std ELSE 1.0 END ORDER BY pos) AS stds FROM st",
    "sc": "SELECT id, split, label, list_transform(features, lambda x, i: (CAST(x AS DOUBLE) - means[i]) / stds[i]) AS v FROM vectors, sl",
}
TEST_IDS = fx.with_tables("SELECT id, label, true AS agree FROM vectors WHERE split = 'test'", vectors=fx.VECTORS)

_GAP = "list_transform(list_zip(q.v, t.v), lambda x: abs(x[1] - x[2]))"
_DISTANCE = (f"CASE WHEN p = 1 THEN list_sum({_GAP}) ELSE sqrt(list_sum(list_transform({_GAP}, lambda g: g * g))) END")


def nearest(pairs: str, keys: str, k: int) -> str:
    """The k nearest training rows of each query of ``pairs`` (q, t, p)."""
    return (f"SELECT {keys}, p, q_id, q_label, t_id, t_label, distance, rank FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {keys}, p, q_id ORDER BY distance, t_id) AS rank FROM ({pairs})) WHERE rank <= {k}")


def votes(lists: str, keys: str) -> str:
    """Probability of class 1 per key, p, k, weights and query."""
    return f"""SELECT {keys}, p, k, weights, q_id, q_label,
  CASE WHEN weights = 'distance' AND count_if(distance = 0) > 0 THEN count_if(distance = 0 AND t_label = 1) / count_if(distance = 0)
       WHEN weights = 'distance' THEN coalesce(sum(CASE WHEN t_label = 1 THEN 1 / distance END), 0) / sum(1 / distance)
       ELSE count_if(t_label = 1) / count(*) END AS probability
FROM {lists}, (SELECT unnest([3, 5, 7, 9]) AS k), (SELECT unnest(['uniform', 'distance']) AS weights)
WHERE rank <= k GROUP BY {keys}, p, k, weights, q_id, q_label"""


def test_lists(k: int) -> dict[str, str]:
    pairs = f"""SELECT 0 AS fold, p, q.id AS q_id, q.label AS q_label, t.id AS t_id, t.label AS t_label, {_DISTANCE} AS distance
FROM sc q, sc t, (SELECT unnest([1, 2]) AS p) WHERE q.split = 'test' AND t.split IN ('train', 'validation')"""
    return SCALED | {"lists": nearest(pairs, "fold", k)}


NEIGHBOURS = fx.with_tables(
    f"SELECT p, q_id AS id, CAST(rank AS INTEGER) AS rank, t_id AS train_id, t_label AS label, {fx.r6('distance')} AS distance FROM lists", **test_lists(9))
KNN = fx.with_tables(
    f"""SELECT p, weights, q_id AS id, q_label AS label, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction, {fx.r6('probability')} AS probability
FROM v WHERE k = 5""", **test_lists(9), v=votes("lists", "fold"))


def fold_lists() -> dict[str, str]:
    pairs = f"""SELECT q.test_fold AS fold, p, q.id AS q_id, q.label AS q_label, t.id AS t_id, t.label AS t_label, {_DISTANCE} AS distance
FROM f q, f t, (SELECT unnest([1, 2]) AS p) WHERE q.test_fold IS NOT NULL AND t.row_idx < first_row + q.test_fold * size"""
    return SCALED | {
        "pos": "SELECT *, row_number() OVER (ORDER BY id) - 1 AS row_idx FROM sc WHERE split IN ('train', 'validation')",
        "cut": "SELECT count(*) - 3 * (count(*) // 4) AS first_row, count(*) // 4 AS size FROM pos",
        "f": "SELECT id, label, v, row_idx, CASE WHEN row_idx >= first_row THEN CAST((row_idx - first_row) // size AS INTEGER) END AS test_fold FROM pos, cut",
        "lists": nearest(pairs.replace("FROM f q, f t,", "FROM f q, f t, cut,"), "fold", 9),
        "v": votes("lists", "fold"),
        "scores": """SELECT p, k, weights, fold, CASE WHEN count_if(probability > 0.5) = 0 THEN 0.0
  ELSE count_if(probability > 0.5 AND q_label = 1) / count_if(probability > 0.5) END AS score FROM v GROUP BY p, k, weights, fold"""}


_KEY = """concat('{"n_neighbors": ', k, ', "p": ', p, ', "weights": "', weights, '"}')"""
_TREE = """SELECT 'DecisionTree' AS model, concat('{"max_depth": ', d, ', "min_samples_split": ', m, '}') AS params
FROM (SELECT unnest(['3', '5', '10', 'null']) AS d), (SELECT unnest([2, 5, 10]) AS m)"""
_FOREST = """SELECT 'RandomForest' AS model, concat('{"max_depth": ', d, ', "min_samples_split": ', m, ', "n_estimators": ', n, '}') AS params
FROM (SELECT unnest(['5', '10', 'null']) AS d), (SELECT unnest([2, 5]) AS m), (SELECT unnest([50, 100, 200]) AS n)"""

#: Every point with its folds; the scores of the neighbour points in full.
SEARCH = fx.with_tables(
    f"""SELECT model, params, 3 AS folds, CAST(NULL AS DOUBLE) AS knn_score, true AS agrees FROM ({_TREE} UNION ALL {_FOREST})
UNION ALL SELECT 'KNN', {_KEY}, 3, {fx.r6('sum(score) / 3')}, true FROM scores GROUP BY p, k, weights""", **fold_lists())
