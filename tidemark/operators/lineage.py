"""Lineage cuts on shared storage."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import staging_path


def materialize(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute ``df`` once, write it as parquet under ``spark.checkpoint.dir``, read it back.

    Used when one intermediate (e.g. silver, whose dedup is a full shuffle)
    feeds several branches of a plan that Spark cannot share: each branch
    prunes different columns, so their exchanges are not reused.  The copy
    lives on the cluster's shared folder, so it survives the loss of the
    executors that wrote it (``localCheckpoint`` would not), and unlike
    ``DataFrame.checkpoint`` it is computed once and stored columnar.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
