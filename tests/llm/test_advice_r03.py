"""Cases of earlier reviews: which rows stay in the near-duplicate stage, and stages on real nulls."""

import pytest

import corpus_pipeline
from waymark.llm import ngram_join, quality_rules

DATA = "/root/testdata/sf0.001"


def words(n, start=0):
    return " ".join(f"w{start + i}" for i in range(n))


def test_representatives_are_rows(spark):
    copy = words(60)
    near = copy.replace("w59", "v")
    rows = [(3, copy), (5, words(60, 1000)), (5, near), (None, copy), (None, near), (None, words(60, 3000)),
            (None, near + " x"), (7, words(40, 5000)), (7, words(40, 5000)), (8, ""), (8, ""), (9, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = ngram_join.representatives(docs).collect()
    want = [(3, copy), (5, words(60, 1000)), (None, words(60, 3000)), (7, words(40, 5000)), (8, ""), (8, ""), (9, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_one_near_copy_without_key_stays(spark):
    rows = [(None, words(60) + f" {c}", c) for c in "abc"]
    got = ngram_join.representatives(spark.createDataFrame(rows, "doc_id long, text string, doc string")).collect()
    assert len(got) == 1


def test_kept_rows_are_the_rows_judged_kept(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = {r.doc_id for r in quality_rules.quality(docs).where("kept").select("doc_id").collect()}
    got = quality_rules.kept(docs.withColumn("kept", docs.doc_id))
    assert got.columns == [*docs.columns, "kept"]
    assert {r.doc_id for r in got.collect()} == kept


@pytest.mark.parametrize("missing", ["text", "source", "doc_id"])
def test_pipeline_takes_real_nulls(spark, tmp_path, missing):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(40)
    null = docs.schema[missing].dataType
    docs = docs.selectExpr(*[f"CAST(IF(doc_id % 3 = 0, NULL, {c}) AS {null.simpleString()}) AS {c}" if c == missing else c
                             for c in docs.columns])
    assert docs.where(docs[missing].isNull()).count() > 0
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, DATA).write.parquet(path := str(tmp_path / str(n)))
        docs = spark.read.parquet(path)
    assert docs.count() > 0
