"""Corpus pipeline: quality rules, near duplicates, decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage before kept,
and returns documents (the last one returns the shard table).  Between stages the documents are
written as Parquet below the shared folder and read again: a lost executor costs its tasks, not the stages
before, and stages may number the rows of what they read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from fiscalflow.llm import decontam, mixing, quality_js, sharding, simhash_vp
from fiscalflow.llm._common import shared_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_js.quality_rules(docs).where("__quality.kept").drop("__quality")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the one with the least id."""
    return simhash_vp.keep_one(docs, words=4, max_bits=4, stable=True)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.decontaminate(docs, items).where("not __contamination.contaminated").drop("__contamination")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in files that hold the mix of sources in order."""
    return mixing.mixed_order(docs, stable=True)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.shard_documents(docs, shards=40)


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("mixing_sources", mix_sources),
    ("sharding", shard),
]

# quality distances and fingerprints are not SQL; tests/llm/test_pipeline.py checks by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard table; the documents of each stage stay in a folder of this run below spark.checkpoint.dir."""
    folder = f"{shared_dir(spark)}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
