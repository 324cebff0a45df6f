"""The corpus pipeline: documents through quality rules, line dedup, near-duplicate groups, mixing and tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waymark.llm import byte_bpe, line_dedup, mixing, ngram_join, quality_rules
from waymark.llm.tables import documents, new_folder

RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.kept(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without blocks of lines that an earlier one has; n_chars follows the text."""
    return line_dedup.deduplicated(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near duplicates."""
    return ngram_join.representatives(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    return mixing.applied(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and checksums of the ids and of the text decoded from them."""
    return byte_bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN, keep=("ids",))


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("n-gram Jaccard join", near_stage),
    ("mixing sources to target weights", mixing_stage),
    ("byte-level BPE encoding and decoding", token_stage),
]

#: Models and fits can't be stated in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read back as the next one's documents."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = new_folder(spark, "stage-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
