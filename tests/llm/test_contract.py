"""Registration, check SQL of the training-data queries, and the pipeline's stages."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline

DATA = "/root/testdata/sf0.001"


def test_all_are_registered():
    names = set(contract.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}


@pytest.mark.parametrize("query", ["op2_warc", "op12_phrase_mining", "op13_ranked_search"])
def test_equals_its_sql(spark, query):
    con = duckdb.connect()
    for name in ("pages", "documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    want = con.execute(contract.oracle_sql()[query])
    names = [d[0] for d in want.description]
    got = contract.queries()[query](spark, DATA).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want.fetchall()))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.count()
        stage(spark, docs, DATA).write.parquet(path := str(tmp_path / str(n)))
        docs = spark.read.parquet(path)
        assert n == 4 or docs.columns == columns
        assert 0 < docs.count() <= 2 * before


@pytest.mark.parametrize("missing", ["text", "source"])
def test_pipeline_takes_nulls(spark, tmp_path, missing):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(30)
    docs = docs.withColumn(missing, docs[missing].substr(1, 0) if missing == "text" else docs[missing])
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(path := str(tmp_path / f"{missing}{n}"))
        docs = spark.read.parquet(path)
