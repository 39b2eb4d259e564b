"""The pipeline's stages and the registered queries of this subpackage."""

import pytest
from compare import DATA, differences

import corpus_pipeline
from chronoloom.llm import queries


def test_stages(spark):
    d = f"{DATA}/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    n, columns = docs.count(), docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns == columns, name
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(ids) == len(set(ids)) and 0.5 * n < len(ids) <= n, name
    out = corpus_pipeline.run(spark, d)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and 0.5 * n < out.count() <= n


def test_each_operator_has_one_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_agrees_with_sql(spark, name):
    assert differences(spark, f"{DATA}/sf0.01", queries.QUERIES[name], queries.ORACLE_SQL[name]) == ""
