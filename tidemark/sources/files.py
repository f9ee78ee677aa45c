"""File and table sources (SRC-1..6).

Every read carries an explicit schema; nothing is inferred.
"""

from __future__ import annotations

import posixpath
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from tidemark.schemas import MARKET_SCHEMA, ORDERS_SCHEMA


def read_jsonl(
    spark: SparkSession,
    path: str,
    schema: StructType = MARKET_SCHEMA,
    quarantine_column: str | None = None,
) -> DataFrame:
    """SRC-1: JSON lines under an explicit schema.

    Default PERMISSIVE mode turns a malformed line into an all-NULL row (the
    reference behaviour).  With ``quarantine_column`` the raw text of such a
    line is kept in that column so it can be routed to a reject table.
    """
    if quarantine_column is None:
        return spark.read.schema(schema).json(path)
    full = StructType(schema.fields + [StructField(quarantine_column, StringType(), True)])
    return spark.read.schema(full).option("columnNameOfCorruptRecord", quarantine_column).json(path)


def with_file_lineage(df: DataFrame, name: str | None = None) -> DataFrame:
    """PRJ-2: ``source_file`` = a given literal, else each row's own file name.

    The per-row form uses the file-source metadata column, so a multi-file
    read keeps per-file lineage without any driver work.
    """
    col: Column = F.lit(name) if name is not None else F.col("_metadata.file_name")
    return df.withColumn("source_file", col)


def read_market_batch(spark: SparkSession, path: str, source_file: str | None = None) -> DataFrame:
    """Bronze read of a market batch: SRC-1 + PRJ-2 (default lineage = the path's base name)."""
    name = source_file if source_file is not None else posixpath.basename(path.rstrip("/"))
    return with_file_lineage(read_jsonl(spark, path, MARKET_SCHEMA), name)


def read_orders_csv(spark: SparkSession, path: str, schema: StructType = ORDERS_SCHEMA) -> DataFrame:
    """SRC-2: header CSV, typed on read; a bad int/float fails the job (FAILFAST)."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-4: a catalog table."""
    return spark.table(name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the data source layer (works for any Hadoop filesystem)."""
    try:
        spark.read.format("text").load(path).limit(0).collect()
        return True
    except AnalysisException:
        return False


def first_batch(spark: SparkSession, root: str, names: Sequence[str]) -> str:
    """SRC-6: the first of the named files that exists in the folder ``root``.

    Names are plain file names; one that would lead out of the folder is an
    error, and so is a list of which nothing exists.
    """
    paths = [posixpath.join(root, name.strip()) for name in names]
    outside = [p for p in paths if posixpath.dirname(p) != root.rstrip("/") or "\\" in p]
    if outside:
        raise ValueError(f"batch files are named without their folder: {outside}")
    found = next((p for p in paths if path_exists(spark, p)), None)
    if found is None:
        raise FileNotFoundError(f"none of these batch files is there: {paths}")
    return found
