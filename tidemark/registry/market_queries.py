"""Market medallion queries (PIP-2, WIN-1, WIN-2, AGG-1, AGG-6, SNK-2 inputs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import market
from tidemark.registry import query
from tidemark.registry.sql import (
    LATEST,
    MARKET_CHAIN,
    RAW_FEED,
    SOURCE_FILE,
    SUMMARY,
    TOPK,
    BRONZE,
    STD,
    with_ctes,
)
from tidemark.schemas import MARKET_FIELDS
from tidemark.sources import bindings


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.with_source_file(bindings.raw_feed(spark, sf_dir), SOURCE_FILE)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return market.silver(bronze(spark, sf_dir))


SILVER_COLS = ", ".join(MARKET_FIELDS + ("source_file",))


@query("market_silver", with_ctes(*MARKET_CHAIN, select=f"SELECT {SILVER_COLS} FROM silver"))
def market_silver(spark, sf_dir):
    """Silver ticks: standardised, valid, de-duplicated on (batch_id, symbol, event_time)."""
    return silver(spark, sf_dir).select(*MARKET_FIELDS, "source_file")


@query("market_gold_summary", with_ctes(*MARKET_CHAIN, LATEST, SUMMARY, select="SELECT * FROM summary"))
def market_gold_summary(spark, sf_dir):
    """Gold summary: one row per symbol from its latest tick (parity form)."""
    return market.gold_summary(silver(spark, sf_dir))


@query(
    "market_top5_stock",
    with_ctes(*MARKET_CHAIN, TOPK, select="SELECT * FROM topk WHERE asset_type = 'stock'"),
)
def market_top5_stock(spark, sf_dir):
    """Gold top-5 stock transactions by price × volume."""
    return market.top_for_type(silver(spark, sf_dir), "stock")


@query(
    "market_top5_crypto",
    with_ctes(*MARKET_CHAIN, TOPK, select="SELECT * FROM topk WHERE asset_type = 'crypto'"),
)
def market_top5_crypto(spark, sf_dir):
    """Gold top-5 crypto transactions by price × volume."""
    return market.top_for_type(silver(spark, sf_dir), "crypto")


@query("win_topk_per_type", with_ctes(*MARKET_CHAIN, TOPK, select="SELECT * FROM topk"))
def win_topk_per_type(spark, sf_dir):
    """WIN-2: top-k per asset type, both types in one result."""
    return market.top_transactions(silver(spark, sf_dir))


@query(
    "win_latest_per_symbol",
    with_ctes(
        *MARKET_CHAIN,
        LATEST,
        select="SELECT symbol, asset_type, price, volume, event_time, batch_id, event_id, rank FROM latest",
    ),
)
def win_latest_per_symbol(spark, sf_dir):
    """WIN-1: newest tick per symbol with its row_number rank (always 1)."""
    latest = market.latest_per_symbol(silver(spark, sf_dir))
    return latest.select("symbol", "asset_type", "price", "volume", "event_time", "batch_id", "event_id", "rank")


@query(
    "agg_dedup_keys",
    with_ctes(
        RAW_FEED,
        BRONZE,
        STD,
        select="""SELECT batch_id, symbol, event_time, event_id AS survivor_id, CAST(n AS BIGINT) AS copies FROM (
  SELECT batch_id, symbol, event_time, event_id,
         row_number() OVER (PARTITION BY batch_id, symbol, event_time ORDER BY event_id) AS rn,
         count(*) OVER (PARTITION BY batch_id, symbol, event_time) AS n
  FROM std) WHERE rn = 1""",
    ),
)
def agg_dedup_keys(spark, sf_dir):
    """AGG-6 on unfiltered standardised rows: one survivor per key (NULL keys group together)."""
    std = market.standardize(bronze(spark, sf_dir))
    return std.groupBy("batch_id", "symbol", "event_time").agg(
        F.min("event_id").alias("survivor_id"), F.count(F.lit(1)).alias("copies")
    )
