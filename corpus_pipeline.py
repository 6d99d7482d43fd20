"""Corpus pipeline: quality, near-duplicates, decontamination, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read back as the next stage's ``docs``. All but the last keep the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from clinicgen.llm.common import read, scratch_path
from clinicgen.llm.decontam import decontaminate
from clinicgen.llm.mix import mix_documents
from clinicgen.llm.quality import keep_quality
from clinicgen.llm.shard import shard_documents
from clinicgen.llm.simhash import deduplicate


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    return keep_quality(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return deduplicate(docs, shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate(docs, read(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    return mix_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return shard_documents(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

# learned scores, XXH64 fingerprints and hypergeometric draws have no DuckDB form; tests/llm holds the brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs
