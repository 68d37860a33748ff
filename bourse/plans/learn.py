"""Training rows, scaling, folds and the tree models
with pyspark.ml; ``selection`` compares and tunes the families.

Input: ``(id, features array<float|double>, label int, split string)``, or a
preprocessed table through ``assemble``.  Scaling statistics are one
aggregation per feature position; fitting and scoring are distributed
pyspark.ml jobs.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 24
TRAIN_SPLITS = ("train", "validation")
TEST_SPLITS = ("test",)
MAX_DEPTH_NONE = 30  # pyspark's ceiling stands in for "no limit"


def split_sets(df: DataFrame, split: str = "split") -> tuple[DataFrame, DataFrame]:
    """(train + validation, test) by the split column (P10 isin)."""
    return df.where(F.col(split).isin(*TRAIN_SPLITS)), df.where(F.col(split).isin(*TEST_SPLITS))


def scaling_stats(train: DataFrame, features: str = "features") -> DataFrame:
    """L02 fit: mean and population std per feature position (one
    aggregation; one row per position)."""
    pos = train.select(F.posexplode(features).alias("pos", "x"))
    return pos.groupBy("pos").agg(F.avg(F.col("x").cast("double")).alias("mean"),
                                  F.stddev_pop(F.col("x").cast("double")).alias("std"))


def standardize(df: DataFrame, stats: DataFrame, features: str = "features") -> DataFrame:
    """L02 apply: (x - mean) / std, std 0 -> 1.  The statistics have one row
    per feature position (bounded by the model width) and are inlined as
    two array literals."""
    rows = sorted(stats.collect(), key=lambda r: r["pos"])
    means = F.array(*[F.lit(float(r["mean"])) for r in rows])
    stds = F.array(*[F.lit(float(r["std"]) if r["std"] and r["std"] > 1e-15 else 1.0) for r in rows])
    scaled = F.transform(
        F.col(features), lambda x, i: (x.cast("double") - F.element_at(means, i + 1)) / F.element_at(stds, i + 1)
    )
    return df.withColumn(features, scaled)


def as_vectors(df: DataFrame, features: str = "features") -> DataFrame:
    return df.withColumn("fv", array_to_vector(F.col(features).cast("array<double>")))


def min_rows(min_split: int) -> int:
    """``min_samples_split`` has no pyspark twin; n maps to
    minInstancesPerNode = max(1, n // 2) (a child must keep half)."""
    return max(1, min_split // 2)


def decision_tree(max_depth: int = 5, min_split: int = 2) -> DecisionTreeClassifier:
    """L03."""
    return DecisionTreeClassifier(featuresCol="fv", labelCol="label", maxDepth=max_depth,
                                  minInstancesPerNode=min_rows(min_split), seed=SEED, cacheNodeIds=True)


def random_forest(n_trees: int = 100, max_depth: int = 5, min_split: int = 2) -> RandomForestClassifier:
    """L04.  ``cacheNodeIds`` keeps each row's place in each tree, which gives
    the same trees without walking (and sending) them again for every level."""
    return RandomForestClassifier(featuresCol="fv", labelCol="label", numTrees=n_trees, maxDepth=max_depth,
                                  minInstancesPerNode=min_rows(min_split), seed=SEED, cacheNodeIds=True)


def predict(model, df: DataFrame) -> DataFrame:
    """Class and class-1 probability (0 if no training row was of it)."""
    out = model.transform(df)
    return out.select("id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.coalesce(F.get(vector_to_array("probability"), F.lit(1)), F.lit(0.0)).alias("probability"))


def row_positions(df: DataFrame, order: list[str]) -> DataFrame:
    """0-based global position in ``order`` without a single-task window:
    a range-partitioned sort (materialised so its partitions are fixed),
    per-partition row counts (one small aggregate, one row per partition)
    turned into offsets, plus the id within the partition."""
    from ..operators.persist import materialize

    sorted_df = materialize(
        df.orderBy(*order).withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    )
    counts = sorted(
        (r["_pid"], r["n"]) for r in sorted_df.groupBy("_pid").agg(F.count(F.lit(1)).alias("n")).collect()
    )
    offsets, acc = [], 0
    for pid, n in counts:
        offsets.append((pid, acc))
        acc += n
    # one row per partition: a bounded broadcast
    table = F.broadcast(df.sparkSession.createDataFrame(offsets, "_pid int, _offset long"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return sorted_df.join(table, "_pid").withColumn("row_idx", (F.col("_offset") + local).cast("long")).drop("_pid", "_mid", "_offset")


def fold_ids(df: DataFrame, n_splits: int = 3, order: list[str] | None = None) -> DataFrame:
    """Expanding-window folds (test size n // (n_splits + 1)).  Adds
    ``row_idx`` (position in ``order``) and ``test_fold`` (the fold whose
    test block holds the row; null for rows only ever trained on).
    Default order is the row id; pass ``["date", "ticker"]`` to cut folds
    in time (the reference cuts in ticker-then-date row order)."""
    order = order or ["id"]
    out = row_positions(df, order)
    n = out.count()
    test_size = n // (n_splits + 1)
    if not test_size:
        raise ValueError(f"{n} rows are too few for {n_splits} expanding folds")
    first = n - n_splits * test_size
    k = F.floor((F.col("row_idx") - F.lit(first)) / F.lit(test_size))
    return out.withColumn("test_fold", F.when(F.col("row_idx") >= first, k.cast("int")))


class LayoutError(ValueError):
    """A table whose columns are not those a model was fitted on."""


class Layout(NamedTuple):
    """What a model reads: dense columns in order, and the level column (one
    categorical feature by its number) with its number of levels."""

    columns: list[str]
    level: str | None
    levels: int

    def check(self, other: Layout) -> None:
        if self.columns != other.columns or self.level != other.level:
            gone, new = [c for c in self.columns if c not in other.columns], [c for c in other.columns if c not in self.columns]
            raise LayoutError(f"not the layout of the model: missing {gone}, new {new}, level {other.level!r} for {self.level!r}, or another order")
        if other.levels > self.levels:
            raise LayoutError(f"{self.level} has {other.levels} levels, the model knows {self.levels}")

    def width(self) -> int:
        return len(self.columns) + max(self.levels - 1, 0)

    def value(self, feature: Column) -> Column:
        """The value of a feature number (see ``with_vectors``) in a row."""
        dense = F.get("features", feature)
        if self.levels < 2:
            return dense
        return F.when(feature < len(self.columns), dense).otherwise(
            (feature - len(self.columns) == F.lit(self.levels - 1) - F.col("level")).cast("double"))


NUMERIC = ("double", "float", "int", "bigint", "smallint", "tinyint")


def assemble(df: DataFrame, label: str, order: list[str], split: str = "split", level: str | None = "ticker_index") -> tuple[DataFrame, Layout]:
    """(id, features array<double>, level, label, split) of a
    preprocessed table, and its layout.  ``id`` is the row's position in
    ``order``, whose columns are no features unless numeric; ``level`` is the
    number of a categorical column without a bound on its levels."""
    level = level if level in df.columns else None
    cols = [c for c, t in df.dtypes if (t in NUMERIC or t.startswith("decimal")) and c not in (label, split, level)]
    levels = (df.agg(F.max(level)).first()[0] or 0) + 1 if level else 0
    at = row_positions(df, order)
    out = at.select(F.col("row_idx").alias("id"), F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("features"),
                    (F.col(level).cast("int") if level else F.lit(0)).alias("level"), F.col(label).cast("int").alias("label"), F.col(split).alias("split"))
    return out, Layout(cols, level, int(levels))


def level_weights(train: DataFrame) -> DataFrame:
    """(level, weight): the scale 1 / std of each level's indicator over the
    training rows; level 0 has no indicator.  One row per level."""
    n = train.groupBy("level").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))
    std = F.sqrt(share * (1 - share))
    return n.select("level", F.when(F.col("level") == 0, 0.0).when(std > 1e-15, 1 / std).otherwise(1.0).alias("weight"))


def with_vectors(df: DataFrame, layout: Layout) -> DataFrame:
    """Adds ``fv``: the dense features, then the indicators of the levels
    1..n-1 (the highest first) as a sparse block of the same vector."""
    df = as_vectors(df)
    if layout.levels < 2:
        return df
    top = layout.levels - 1
    one = df.sparkSession.range(top, top + 1).select(F.col("id").cast("int").alias("_turned"))
    coder = OneHotEncoder(inputCol="_turned", outputCol="_hot").fit(one)  # knows top + 1 levels, drops the last
    hot = coder.transform(df.withColumn("_turned", F.lit(top) - F.col("level")))
    both = VectorAssembler(inputCols=["fv", "_hot"], outputCol="_both").transform(hot).drop("fv", "_hot", "_turned")
    # without the encoder's metadata, indicators split by a threshold as well
    return both.withColumn("fv", F.col("_both").alias("fv", metadata={})).drop("_both")


def training_sets(rows: DataFrame, layout: Layout) -> tuple[DataFrame, DataFrame]:
    """L01 + L02 on assembled rows: (train, test) with features scaled by the
    training rows, the level's weight and the vector ``fv``."""
    train, _ = split_sets(rows)
    scaled = standardize(rows, scaling_stats(train))
    if layout.levels > 1:
        scaled = scaled.join(level_weights(train), "level", "left").withColumn("weight", F.coalesce("weight", F.when(F.col("level") == 0, 0.0).otherwise(1.0)))
    else:
        scaled = scaled.withColumn("weight", F.lit(0.0))
    return split_sets(with_vectors(scaled, layout))
