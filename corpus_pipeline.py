"""The training-data pipeline: documents in, packed token sequences out.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is
written as Parquet and read again as the next one's ``docs``.  All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from thermolens.llm import mixing, packing, pii, quality_rules, simhash
from thermolens.llm.queries import trusted_documents
from thermolens.session import ensure_checkpoint_dir


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and read like the trusted target."""
    return quality_rules.keep_good(docs, trusted_documents(spark, sf_dir))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_representatives(docs, shingle=3, max_bits=3)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by the name of its kind."""
    return pii.masked(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the source mix takes it."""
    return mixing.repeated(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of the documents' pieces in sequences of 2048 tokens."""
    return packing.packed(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("simhash_near_dedup", dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# XXH64 n-gram buckets, SimHash and the tokenizer are not expressible in SQL;
# tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; stage results are tables in the shared checkpoint folder."""
    shared = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        out.write.parquet(f"{shared}/{i}-{name}")
        docs = spark.read.schema(out.schema).parquet(f"{shared}/{i}-{name}")
    return docs
