"""Lineage cuts and size-checked joins shared by the operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# A set of 8-byte ids is broadcast only up to this many rows (about 32 MB as
# a hashed relation); beyond it the same join shuffles.
BROADCAST_IDS = 1_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: the
    lineage is cut, and a lost executor costs a re-read only."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Remove tables of ``written`` after their last reader."""
    for df in tables:
        path = getattr(df, "written_at", None)
        if path:
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where.getParent(), True)


def join_ids(df: DataFrame, ids: DataFrame, key: str, n_ids: int, how: str = "left_semi") -> DataFrame:
    """Join on an id set: broadcast when it has at most ``BROADCAST_IDS``
    rows (``n_ids`` is its counted size), a shuffle join otherwise."""
    return df.join(F.broadcast(ids) if n_ids <= BROADCAST_IDS else ids, key, how)


def input_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of ``df``: used only to choose numbers of
    buckets, never to choose what is computed."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def narrow(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of a table with any further columns; null
    texts become empty."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
