"""Exact quantiles per group by distributed selection.

Equal values are added up first.  The distinct (group, value) rows are
range-partitioned and sorted; the rows of each group in each range are counted,
and running totals of these counts (one row per range and group) say which
range holds a wanted rank.  Only those ranges are read again, so a task holds a
slice of a group, never the group, and no buffer holds its values.

Defined results: null values do not count; a null group is a group of its own;
a group without values has null quantiles; an empty table gives none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .persist import materialize


def _slices(df: DataFrame, by: str, col: str, weight: str | None, parts: int | None) -> DataFrame:
    """(g, v, rows, part): distinct values with their rows, in sorted ranges."""
    w = F.col(weight) if weight else F.lit(1)
    n = df.select(F.col(by).alias("g"), F.col(col).cast("double").alias("v"), w.cast("long").alias("rows")).where("v IS NOT NULL").groupBy("g", "v").agg(
        F.sum("rows").alias("rows"))
    order = ["g", "v"]
    dealt = n.repartitionByRange(parts, *order) if parts else n.repartitionByRange(*order)
    return materialize(dealt.withColumn("part", F.spark_partition_id()))


def ranks(total: Column, p: float) -> tuple[Column, Column, Column]:
    """The two rows (from 0) around a quantile and how far it lies between
    them (linear interpolation)."""
    at = (total - 1) * F.lit(float(p))
    return F.floor(at).cast("long"), F.ceil(at).cast("long"), at - F.floor(at)


def group_quantiles(df: DataFrame, col: str, by: str, probs: list[float], weight: str | None = None, parts: int | None = None) -> DataFrame:
    """(by, q): the quantiles ``probs`` of ``col`` in each group, in order;
    a row counts ``weight`` times."""
    rows = _slices(df, by, col, weight, parts)
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("g", "part").agg(F.sum("rows").alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    totals = ranges.groupBy("g").agg(F.sum("n").alias("total"))
    wanted = [r for p in probs for r in ranks(F.col("total"), p)[:2]]
    totals = materialize(totals.withColumn("wanted", F.array_distinct(F.array(*wanted))))
    same = F.col("g").eqNullSafe(F.col("_g"))
    holding = ranges.join(totals.select(F.col("g").alias("_g"), "wanted"), same).drop("_g").where(
        F.exists("wanted", lambda r: (r >= F.col("first")) & (r < F.col("first") + F.col("n")))).select(
        F.col("g").alias("_g"), F.col("part").alias("_part"), "first", "wanted")
    some = rows.join(holding, same & (F.col("part") == F.col("_part")))
    run = Window.partitionBy("part", "g").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    upto = some.withColumn("upto", F.col("first") + F.sum("rows").over(run))
    hit = upto.withColumn("rank", F.explode(F.filter("wanted", lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("rows")))))
    found = hit.groupBy("g").agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("at"))  # two rows per quantile
    out = totals.join(found.withColumnRenamed("g", "_g"), same, "left")
    values = []
    for p in probs:
        lo, hi, part = ranks(F.col("total"), p)
        a, b = F.try_element_at("at", lo), F.try_element_at("at", hi)
        values.append(F.when(lo == hi, a).otherwise(a + (b - a) * part))
    return out.select(F.col("g").alias(by), F.array(*values).alias("q"))
