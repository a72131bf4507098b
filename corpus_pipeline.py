"""Corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing."""

from __future__ import annotations

import uuid

from public_tokenizers import path as tokenizer_path
from pyspark.sql import DataFrame, SparkSession

from gridloom.core.session import shared_folder
from gridloom.llm.decontam import drop_contaminated
from gridloom.llm.neardup import drop_near_duplicates
from gridloom.llm.packing import PackSettings, pack_documents
from gridloom.llm.pii import redact_pii
from gridloom.llm.repetition import filter_repetition


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the repetition rules reject."""
    return filter_repetition(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates, the one with the smallest id."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace identifiers, plain and disguised, by their kind."""
    return redact_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document in sequences of 1024 tokens."""
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("byte_bpe_50k.tiktoken")
    return pack_documents(docs, PackSettings(*paths, capacity=1024, end_id=2))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: Suffix arrays, sketches, tokenizers and packing are beyond SQL; the tests hold every stage
#: and the whole run against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; each result is stored before the next stage reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
