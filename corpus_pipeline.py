"""A training-data pipeline of five text operators over ``documents``.

Each stage works on everything that the one before it kept; the rows between
stages are written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.decontam import decontaminate
from tidemark.llm.mixing import mix_documents
from tidemark.llm.near_dup import drop_near_duplicates
from tidemark.llm.token_files import token_file_report
from tidemark.llm.weak_quality import drop_low_quality
from tidemark.operators.lineage import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier accepts."""
    return drop_low_quality(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, small sources repeated towards the target weights."""
    return mix_documents(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix; one row per document, read back from them."""
    return token_file_report(docs)


STAGES = [
    ("quality_classifier", quality),
    ("minhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mixing),
    ("token_id_files", token_files),
]

#: SQL cannot express the classifier, the hashed permutations or the tokenizer; tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order, from ``documents`` to the rows of the token files."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    *before, (_, last) = STAGES
    for name, stage in before:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return last(spark, docs, sf_dir)
