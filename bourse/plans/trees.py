"""Fitted trees and forests as a relational table, scored by joins.

A node is a row (tree, node, feature, threshold, left, right, share): inner
nodes send a row left if its feature is at most the threshold, leaves have no
feature and hold the share of class 1 among their training rows.  A row starts
at node 0 of every tree and moves down one level per join on (tree, node);
the probability is the mean share of the leaves it reaches.  The first n trees
of a forest are a forest of n trees, so one table answers several sizes.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.persist import materialize

# Trees are broadcast together up to this many nodes (about 64 bytes each).
BROADCAST_NODES = 500_000


class Forest(NamedTuple):
    nodes: DataFrame
    depth: int   # joins down to the deepest leaf
    trees: int


def node_table(spark: SparkSession, model_path: str, depth: int, trees: int) -> Forest:
    """The nodes of a saved pyspark.ml tree or forest classifier."""
    data = spark.read.parquet(f"{model_path.rstrip('/')}/data")
    if "treeID" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.select(F.lit(0).alias("tree"), "*")
    inner, stats = F.col("leftChild") >= 0, F.col("impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda a, x: a + x)
    nodes = data.select(
        "tree", F.col("id").alias("node"), F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner, F.col("split.leftCategoriesOrThreshold")[0]).alias("threshold"),
        F.when(inner, F.col("leftChild")).alias("left"), F.when(inner, F.col("rightChild")).alias("right"),
        F.when(~inner, F.coalesce(F.get(stats, F.lit(1)), F.lit(0.0)) / total).alias("share"))
    return Forest(nodes, depth, trees)


def depth_of(model) -> int:
    return max([t.depth for t in model.trees], default=0) if hasattr(model, "trees") else model.depth


def trees_of(model) -> int:
    return getattr(model, "getNumTrees", 1)


def dense_value(feature: Column) -> Column:
    """The value of a feature of the array ``features``."""
    return F.get("features", feature)


def _walk(forest: Forest, nodes: DataFrame, trees: list[int], rows: DataFrame, value, small: bool) -> DataFrame:
    inner = nodes.where("feature IS NOT NULL").select("tree", "node", "feature", "threshold", "left", "right")
    ends = nodes.where("feature IS NULL").select("tree", "node", "share")
    if small:
        inner, ends = F.broadcast(inner), F.broadcast(ends)
    at = rows.withColumns({"tree": F.explode(F.array(*map(F.lit, trees))), "node": F.lit(0)})
    for _ in range(forest.depth):
        down = F.when(value(F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = at.join(inner, ["tree", "node"], "left").withColumn(
            "node", F.when(F.col("feature").isNull(), F.col("node")).otherwise(down)).drop("feature", "threshold", "left", "right")
    return at.join(ends, ["tree", "node"]).select("id", "tree", "share")


def leaves(forest: Forest, rows: DataFrame, value=dense_value) -> DataFrame:
    """(id, tree, share): the leaf each row reaches in each tree; ``value``
    turns a feature number into its value in the row.  A large forest is
    walked some trees at a time, as many as can be broadcast, so the rows are
    not shuffled with their features at every level; only trees that alone
    are too large are joined by a shuffle."""
    sizes = {r["tree"]: r["n"] for r in forest.nodes.groupBy("tree").agg(F.count(F.lit(1)).alias("n")).collect()}  # one row per tree
    large, packs, room = [], [], 0
    for tree in range(forest.trees):
        n = sizes.get(tree, 0)
        if n > BROADCAST_NODES:
            large.append(tree)
            continue
        if not packs or n > room:
            packs.append([])
            room = BROADCAST_NODES
        packs[-1].append(tree)
        room -= n
    every = [(pack, True) for pack in packs] + ([(large, False)] if large else [])
    out = None
    for trees, small in every:
        nodes = forest.nodes if len(every) == 1 else forest.nodes.where(F.col("tree").isin(trees))
        part = _walk(forest, nodes, trees, rows, value, small)
        if len(every) > 1:
            part = materialize(part)  # one pack is held at a time
        out = part if out is None else out.unionByName(part)
    return out


def score(forest: Forest, rows: DataFrame, sizes: list[int] | None = None, value=dense_value) -> DataFrame:
    """(id, size, probability, prediction) of class 1 by the first ``size``
    trees (default: all); an even vote goes to class 0."""
    sizes = sizes or [forest.trees]
    means = leaves(forest, rows, value).groupBy("id").agg(*[F.avg(F.when(F.col("tree") < n, F.col("share"))).alias(f"p{n}") for n in sizes])
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("size"), F.col(f"p{n}").alias("probability")) for n in sizes]))
    return means.select("id", each.alias("s")).select(
        "id", "s.size", "s.probability", F.when(F.col("s.probability") > 0.5 + 1e-12, 1).otherwise(0).alias("prediction"))
