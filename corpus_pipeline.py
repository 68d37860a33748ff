"""The corpus pipeline: quality rules, line dedup, near-duplicate removal,
source mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result as Parquet to the shared checkpoint folder and reads it back as
the next stage's documents.  All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bourse.llm import line_dedup, minhash, mixing, packing, quality
from bourse.llm.store import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects (operator 9)."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup_by_source(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source (operator 6);
    n_chars follows the text.  Lines are counted by distinct contents, so that
    the one copy that near-dedup keeps still has its text."""
    out = line_dedup.drop_boilerplate(docs, host="source", count_as="__lines", by_content=True)
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.when(F.col("__lines") > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars"))).drop("__lines")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (operator 7)."""
    return minhash.drop_near_duplicates(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample of the documents by calibrated probabilities (operator 1)."""
    return mixing.sample(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences: one row per piece (operator 2)."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup_by_source),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("packing", pack_sequences),
]

#: Tokenizing, sequence planning and the binomial bounds have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
