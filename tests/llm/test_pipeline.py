"""The pipeline's stages on a small table, and the queries that have SQL."""

import os

import pytest

import corpus_pipeline
from chemprobe.llm import queries
from tests.llm.conftest import stored
from tests.parity import compare

SF = "/root/testdata/sf0.001"


def test_stages(spark, rows, tmp_path):
    docs = stored(spark, rows).selectExpr("*", "cast(length(text) as bigint) AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    source = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, n = source.columns, source.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, source, str(tmp_path))
        assert out.columns == columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        source = spark.read.parquet(f"{tmp_path}/{k}")
        assert source.count() <= n
        n = source.count()
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert whole.select("doc_id").distinct().count() == source.select("doc_id").distinct().count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")
@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql_parity(spark, name):
    compare(spark, SF, queries.QUERIES[name], queries.SQL[name])
