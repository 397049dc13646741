"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which
:func:`run` writes as Parquet and reads again as the next stage's ``docs``.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cloudloom.checkpoints import ensure_checkpoint_dir
from cloudloom.llm import bpe, decontaminate, pii, quality_rules, simhash


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: rejected documents go, frequent lines leave the text of the others."""
    return quality_rules.keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: one document of each group of near copies (five words, similarity 0.8) stays."""
    return simhash.one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that leak a benchmark item go."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data are masked in the text."""
    return pii.mask_personal_data(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: token ids of each text, and digests of them and of the decoded text."""
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality rules", quality),
    ("near dedup", near_dedup),
    ("decontamination", decontaminated),
    ("personal data", masked),
    ("encoding", encoded),
]

#: SQL cannot express the fingerprints, the random field and the merges; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage outputs are tables in the shared checkpoint folder."""
    folder = f"{ensure_checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
