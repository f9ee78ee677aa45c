"""The registered queries of the text operators, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import oracles
from tidemark.llm.clustering import cluster_vectors
from tidemark.llm.decontam import contamination_report
from tidemark.llm.importance import resample
from tidemark.llm.lang_id import language_report
from tidemark.llm.main_text import extract_main_text
from tidemark.llm.mixing import mixed_rows
from tidemark.llm.near_dup import near_duplicate_groups
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality_rules import quality_rules
from tidemark.llm.secrets import secret_report
from tidemark.llm.token_counts import token_counts
from tidemark.llm.token_files import token_file_report
from tidemark.llm.weak_quality import quality_scores


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_rows(table(spark, sf_dir, "documents"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file_report(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_groups(table(spark, sf_dir, "documents"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_secrets,
        op2_main_text,
        op3_quality_rules,
        op4_language_id,
        op5_quality_classifier,
        op6_mixing,
        op7_token_files,
        op8_decontamination,
        op9_token_counts,
        op10_near_duplicates,
        op11_packing,
        op12_clustering,
        op13_resampling,
    )
}

ORACLES: dict[str, str] = {
    "op3_quality_rules": oracles.QUALITY_RULES,
    "op8_decontamination": oracles.DECONTAMINATION,
    "op10_near_duplicates": oracles.NEAR_DUPLICATES,
    "op12_clustering": oracles.CLUSTERING,
    "op13_resampling": oracles.RESAMPLING,
}
