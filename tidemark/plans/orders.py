"""Orders medallion: CSV extract → bronze → silver, and its validation suite.

The reference parses the CSV on the driver and ships the rows with
``createDataFrame``.  Here the read is distributed (``spark.read.csv`` with an
explicit schema and FAILFAST, so a bad int/float aborts the job exactly as
``int()``/``float()`` would), and the driver never holds the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import COMPLETE_STATUS, HIGH_AMOUNT_THRESHOLD, HIGH_BUCKET, STANDARD_BUCKET
from tidemark.operators import quality as qa


def bronze(orders: DataFrame, source_file: str, ingested_at_utc: str) -> DataFrame:
    """PIP-1 bronze: the typed extract + lineage literals (ISO text, not a timestamp)."""
    return orders.select(
        "order_id",
        "customer",
        "status",
        "amount",
        F.lit(source_file).alias("source_file"),
        F.lit(ingested_at_utc).alias("ingested_at_utc"),
    )


def amount_bucket(amount: str = "amount"):
    """PRJ-6: ``high`` at or above the threshold, else ``standard`` (NULL → standard)."""
    return F.when(F.col(amount) >= HIGH_AMOUNT_THRESHOLD, HIGH_BUCKET).otherwise(STANDARD_BUCKET)


def silver(bronze_df: DataFrame) -> DataFrame:
    """PIP-1 silver: complete orders only, with the amount bucket."""
    return bronze_df.where(F.col("status") == COMPLETE_STATUS).select(
        "order_id",
        "customer",
        "amount",
        amount_bucket().alias("amount_bucket"),
        "source_file",
        "ingested_at_utc",
    )


def wrong_bucket() -> Column:
    """QA-11: the stored bucket differs from the one that the amount gives."""
    return F.col("amount_bucket") != amount_bucket()


def non_complete_pairs(bronze_df: DataFrame, silver_df: DataFrame) -> DataFrame:
    """QA-10 as one number: ``count(bronze ⋈ silver USING order_id WHERE status != 'complete')``.

    Computed from per-key counts (``Σ n_bronze × n_silver``) so a duplicated
    key never materialises its pairs: both sides aggregate map-side to one
    row per key before the join.
    """
    b = bronze_df.where(F.expr("status != 'complete'")).groupBy("order_id").agg(F.count(F.lit(1)).alias("nb"))
    s = silver_df.groupBy("order_id").agg(F.count(F.lit(1)).alias("ns"))
    return b.join(s, "order_id").agg(F.coalesce(F.sum(F.col("nb") * F.col("ns")), F.lit(0)).cast("bigint").alias("v"))


def validation(bronze_df: DataFrame, silver_df: DataFrame, expected_counts: tuple[int, int] | None = None) -> DataFrame:
    """PIP-5 (orders): every check as one row; two aggregate passes plus two joins.

    ``expected_counts`` reproduces the fixture check (4 bronze / 2 silver rows).
    """
    b_rules = {
        "null_required": qa.any_null(["order_id", "customer", "status", "amount"]),
        "non_positive_amount": F.expr("amount <= 0"),
    }
    s_rules = {
        "non_positive_amount": F.expr("amount <= 0"),
        "bucket_rule": wrong_bucket(),
    }
    parts = [
        qa.rule_counts(bronze_df, b_rules, "bronze_orders"),
        qa.rule_counts(silver_df, s_rules, "silver_orders"),
        qa.unique_key(bronze_df, ["order_id"], "bronze_orders"),
        _value_check(non_complete_pairs(bronze_df, silver_df), "silver_orders", "non_complete_status"),
        qa.key_set_equal(
            bronze_df.where(F.expr("status = 'complete'")), silver_df, ["order_id"], "silver_orders"
        ),
    ]
    if expected_counts is not None:
        parts.append(qa.exact_rows(bronze_df, expected_counts[0], "bronze_orders"))
        parts.append(qa.exact_rows(silver_df, expected_counts[1], "silver_orders"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _value_check(v: DataFrame, table: str, check: str) -> DataFrame:
    return v.select(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.col("v").cast("bigint").alias("violations"),
        (F.col("v") == 0).alias("passed"),
    )
