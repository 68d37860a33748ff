"""The queries of this package: one per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, collocation, html_extract, line_dedup, lm_score, minhash, mixing, packing, quality, substring, token_files, warc, whitening

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.weigh(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("__source").alias("source"), F.col("__lang").alias("lang"), F.col("__topic").alias("topic"),
                      F.col("__tokens").alias("tokens"), F.round("__weight", 6).alias("weight"), F.round("__p", 6).alias("probability"),
                      F.col("__kept").alias("kept"))


def op2_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_lattice_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(_table(spark, sf_dir, "documents"))


def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = ann.valid(_table(spark, sf_dir, "embeddings"))
    return ann.search(vectors, vectors.where("id % 100 = 0"))


def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op6_boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_table(spark, sf_dir, "documents"), count_as="n_removed").select("doc_id", "n_removed", "text")


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_text(_table(spark, sf_dir, "pages"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(_table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(_table(spark, sf_dir, "documents"))


def op13_whitened_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


_QUERIES: list[Query] = [op1_mixed_sources, op2_packed_sequences, op3_lattice_score, op4_nearest_neighbours, op5_warc_round_trip, op6_boilerplate_lines,
                         op7_near_duplicates, op8_repeated_passages, op9_quality_rules, op10_main_text, op11_token_files, op12_collocations,
                         op13_whitened_embeddings]


def queries() -> dict[str, Query]:
    import corpus_pipeline

    return {q.__name__: q for q in _QUERIES} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op1_mixed_sources": mixing.oracle_sql(), "op6_boilerplate_lines": line_dedup.oracle_sql(),
            "op12_collocations": collocation.oracle_sql()}
