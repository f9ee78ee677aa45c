"""Orders queries (PIP-1, PRJ-6, FLT-1, FLT-11, JON-1)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import orders
from tidemark.registry import query
from tidemark.registry.sql import BRONZE_ORDERS, ORDERS_FILE, ORDERS_IN, RUN_TS, SILVER_ORDERS, with_ctes
from tidemark.sources import bindings

ORDER_CTES = (ORDERS_IN, BRONZE_ORDERS, SILVER_ORDERS)


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.bronze(bindings.orders_in(spark, sf_dir), ORDERS_FILE, RUN_TS)


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.silver(bronze_orders(spark, sf_dir))


@query("orders_bronze", with_ctes(*ORDER_CTES, select="SELECT * FROM bronze_orders"))
def orders_bronze(spark, sf_dir):
    """PIP-1 bronze: typed extract + source_file + ingested_at_utc text."""
    return bronze_orders(spark, sf_dir)


@query("orders_silver", with_ctes(*ORDER_CTES, select="SELECT * FROM silver_orders"))
def orders_silver(spark, sf_dir):
    """PIP-1 silver / FLT-1: complete orders with the amount bucket."""
    return silver_orders(spark, sf_dir)


@query(
    "orders_amount_bucket",
    with_ctes(
        *ORDER_CTES,
        select="SELECT amount_bucket, CAST(count(*) AS BIGINT) AS orders, round(sum(amount), 4) AS amount "
        "FROM silver_orders GROUP BY amount_bucket",
    ),
)
def orders_amount_bucket(spark, sf_dir):
    """PRJ-6 / FN-6: CASE bucket, summarised per bucket."""
    return silver_orders(spark, sf_dir).groupBy("amount_bucket").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("amount"), 4).alias("amount")
    )


@query(
    "flt_sql_string",
    with_ctes(
        *ORDER_CTES,
        select="SELECT order_id, status, amount FROM bronze_orders "
        "WHERE status != 'complete' AND amount >= 50 AND customer IS NOT NULL",
    ),
)
def flt_sql_string(spark, sf_dir):
    """FLT-11: predicates given as SQL text (``where(str)``)."""
    return (
        bronze_orders(spark, sf_dir)
        .where("status != 'complete' AND amount >= 50 AND customer IS NOT NULL")
        .select("order_id", "status", "amount")
    )


@query(
    "join_inner_orders",
    with_ctes(
        *ORDER_CTES,
        select="SELECT b.order_id, b.status, b.amount, s.amount_bucket FROM bronze_orders b "
        "JOIN silver_orders s USING (order_id)",
    ),
)
def join_inner_orders(spark, sf_dir):
    """JON-1: bronze ⋈ silver USING order_id (sort-merge or broadcast chosen by AQE on size)."""
    b = bronze_orders(spark, sf_dir)
    s = silver_orders(spark, sf_dir)
    return b.join(s.select("order_id", "amount_bucket"), "order_id", "inner").select(
        "order_id", "status", "amount", "amount_bucket"
    )
