"""C11: dataset profile and the exploratory aggregates.

Every statistic is a single aggregation pass (many aggregates in one
``agg``), unpivoted to long form when it is per column.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.quantiles import group_quantiles


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Count and share per value (share = count / total rows; the
    total is one count read back as a literal)."""
    total = df.count()
    return df.groupBy(col).count().withColumn("share", F.col("count") / F.lit(float(total)))


def shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def summary(df: DataFrame, ticker: str = "ticker", date: str = "date") -> DataFrame:
    """C11: rows, columns, distinct tickers (G11), date range (G12) and total
    nulls (G13), in one aggregation."""
    nulls = sum(F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.count_distinct(ticker).alias("tickers"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        nulls.alias("nulls"),
    )


def zero_share(df: DataFrame, cols: list[str]) -> DataFrame:
    """Share of zero cells over rows x columns."""
    zeros = sum(F.count_if(F.col(c) == 0) for c in cols)
    return df.agg((zeros / (F.count(F.lit(1)) * F.lit(len(cols)))).alias("zero_share"))


def label_correlations(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """Pearson correlation of each column with the label (pairwise
    complete rows), one aggregation, unpivoted to (column, corr)."""
    wide = df.agg(*[F.corr(F.col(c).cast("double"), F.col(label).cast("double")).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "corr")


def top_correlations(corr: DataFrame, n: int = 25) -> DataFrame:
    """The n highest correlations (descending, ties by name)."""
    return corr.orderBy(F.col("corr").desc_nulls_last(), "column").limit(n)


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int, by: str | None = None) -> DataFrame:
    """Equal-width histogram over [lo, hi]; values outside are ignored
    and the top edge belongs to the last bin (numpy's convention)."""
    x = F.col(col)
    width = (hi - lo) / bins
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
    keys = ([by] if by else []) + ["bin"]
    return (
        df.where(x.isNotNull() & (x >= lo) & (x <= hi))
        .withColumn("bin", b)
        .groupBy(*keys)
        .count()
        .withColumns({
            "bin_lo": F.lit(lo) + F.col("bin") * F.lit(width),
            "bin_hi": F.lit(lo) + (F.col("bin") + 1) * F.lit(width),
        })
    )


def histogram_auto(df: DataFrame, col: str, bins: int = 20) -> DataFrame:
    """Equal-width histogram over the column's own [min, max]; the two
    bounds are one small aggregate."""
    row = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    if row["lo"] is None:  # no values: no bins
        return histogram(df, col, 0.0, 1.0, bins)
    return histogram(df, col, float(row["lo"]), float(row["hi"]), bins)


def five_numbers(df: DataFrame, col: str, by: str) -> DataFrame:
    """Min, quartiles, median, max per group (exact, linear
    interpolation), by distributed selection."""
    q = group_quantiles(df, col, by, [0.0, 0.25, 0.5, 0.75, 1.0])
    return q.select(by, *[F.col("q")[i].alias(n) for i, n in enumerate(("min", "q1", "median", "q3", "max"))])


def append_all(frames: list[DataFrame]) -> DataFrame:
    """Append tables whose columns may differ (missing -> null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
