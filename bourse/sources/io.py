"""Scans and sinks (S01, S12, S13); ``artifacts`` holds S14 and S15.

Reads take an explicit schema (no inference pass over the data); filters on
the scan are plain column predicates so Catalyst pushes them into the
parquet reader.  Sinks write to the caller's shared storage (on a cluster
the folder named by ``spark.checkpoint.dir`` or any shared path -- never a
machine-local temp folder).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.persist import materialize
from ..session import checkpoint_dir

BARS_SCHEMA = "ticker string, date date, open double, high double, low double, close double, volume double"


def scan_bars(bars: DataFrame, tickers: list[str] | DataFrame | None, start: str, end: str) -> DataFrame:
    """Bars of a ticker universe in ``[start, end)`` (end exclusive).

    A Python list becomes an ``IN`` filter pushed into the scan; a
    DataFrame universe is applied as a ``left_semi`` join (AQE broadcasts it
    when it is measured small)."""
    out = bars.where((F.col("date") >= F.to_date(F.lit(start))) & (F.col("date") < F.to_date(F.lit(end))))
    if tickers is None:
        return out
    if isinstance(tickers, DataFrame):
        return out.join(tickers.select("ticker"), "ticker", "left_semi")
    return out.where(F.col("ticker").isin(list(tickers)))


def read_bars_parquet(spark: SparkSession, path: str, tickers=None, start: str = "1900-01-01",
                      end: str = "9999-12-31") -> DataFrame:
    """S01 from storage: schema given, date range and tickers pushed down."""
    return scan_bars(spark.read.schema(BARS_SCHEMA).parquet(path), tickers, start, end)


class RejectedRowsError(ValueError):
    """Too many rows of a CSV file do not fit its schema."""


def read_csv(spark: SparkSession, path: str, schema: str, max_rejected: float = 0.0) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).
    Rows that do not fit raise ``RejectedRowsError`` above a share of
    ``max_rejected``; ``read_csv_rejecting`` returns them."""
    return read_csv_rejecting(spark, path, schema, max_rejected)[0]


_LINE = "_rejected_line"


def read_csv_rejecting(spark: SparkSession, path: str, schema: str, max_rejected: float = 1.0,
                       header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a CSV file.  ``rejected`` has the line and the
    reason: the first column whose text is not of its type, or another number
    of fields.  One pass counts both; a share of rejected rows above
    ``max_rejected`` raises."""
    fields = spark.createDataFrame([], schema).schema
    read = spark.read.option("header", header).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _LINE)
    rows = materialize(read.schema(f"{schema}, {_LINE} string").csv(path))
    bad = F.col(_LINE).isNotNull()
    seen = rows.agg(F.count(F.lit(1)).alias("all"), F.count_if(bad).alias("bad")).first()
    if seen["bad"] > max_rejected * seen["all"]:
        raise RejectedRowsError(f"{seen['bad']} of {seen['all']} rows of {path} do not fit the schema")
    text = ", ".join(f"`{f.name}` string" for f in fields)
    parsed = F.from_csv(F.col(_LINE), F.lit(text), {"mode": "PERMISSIVE"})
    wrong = [F.when(parsed[f.name].isNotNull() & parsed[f.name].try_cast(f.dataType).isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
             for f in fields]
    rejected = rows.where(bad).select(F.col(_LINE).alias("line"), F.coalesce(*wrong, F.lit("another number of fields")).alias("reason"))
    return rows.where(~bad).drop(_LINE), rejected


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> str:
    """Overwrite ``path`` with ``df`` (parquet by default, or csv with
    a header); optionally partitioned (e.g. by year) for later pruning."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)
    return path


def write_bucketed(df: DataFrame, name: str, buckets: int, path: str | None = None, key: str = "ticker", order: str = "date") -> DataFrame:
    """A table bucketed by ``key`` and sorted by ``order``, read
    back with that partitioning: windows and aggregates over ``key`` need no
    exchange.  ``path`` is a new folder (default: the checkpoint folder)."""
    spark = df.sparkSession
    path = path or scratch_path(spark, name)
    # one file per bucket: rows meet by the buckets' own hash before the write
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(order).format("parquet").option("path", path).saveAsTable(name)
    return spark.table(name)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    base = checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
