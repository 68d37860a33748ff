"""Registration, the SQL twins and the pipeline."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_every_operator_has_one_query():
    names = list(entry.queries())
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names


@pytest.mark.parametrize("name", ["op1_mixed_sources", "op6_boilerplate_lines", "op12_collocations"])
def test_sql_twin(spark, name):
    from tests.oracle_check import compare, duck

    res = compare(entry.queries()[name](spark, SF), entry.oracle_sql()[name], duck(SF))
    assert res["ok"], res


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = corpus_pipeline.run(spark, SF)
    kept = {r.doc_id for r in pieces.select("doc_id").distinct().collect()}
    assert 0 < len(kept) < docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "line dedup", "MinHash near-dedup", "mixing sources", "packing"]
    for _, stage in corpus_pipeline.STAGES[1:2]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        assert out.where("n_chars <> length(text)").count() == docs.where("n_chars <> length(text)").count()
