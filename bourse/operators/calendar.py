"""Calendar operators: month-end keys and the dense month grid."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def month_end(c) -> "F.Column":
    return F.last_day(F.col(c) if isinstance(c, str) else c)


def dense_months(df: DataFrame, key: str = "ticker", month: str = "date") -> DataFrame:
    """Add an all-null row for every month missing between a key's first and
    last month (pandas ``resample('ME')`` keeps empty months).

    One pass, no join or union: each row looks at the next month present
    for its key (a window inside the key's partition) and explodes itself
    into its own month plus the missing months up to the next one; the
    value columns are kept on its own month only.  The gap length is
    bounded by the calendar, and the key partitioning is preserved.
    """
    w = Window.partitionBy(key).orderBy(month)
    nxt = F.lead(month).over(w)
    first = F.trunc(month, "month")
    last = F.when(nxt.isNull(), first).otherwise(F.add_months(F.trunc(nxt, "month"), -1))
    values = [c for c in df.columns if c not in (key, month)]
    with_end = df.withColumn("_last", last)
    months = F.transform(F.sequence(first, F.col("_last"), F.expr("interval 1 month")), F.last_day)
    exploded = with_end.select(key, month, *values, F.explode(months).alias("_m"))
    own = F.col("_m") == F.col(month)
    return exploded.select(
        key, F.col("_m").alias(month), *[F.when(own, F.col(c)).alias(c) for c in values]
    )
