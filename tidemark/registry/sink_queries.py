"""Sink round-trip queries (SNK-1, SNK-2, SNK-3, SNK-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.lineage import materialize
from tidemark.plans import market
from tidemark.registry import query
from tidemark.registry.feed_queries import FEED_BUILD_SQL, build_feed
from tidemark.registry.market_queries import silver
from tidemark.registry.sql import LATEST, MARKET_CHAIN, SUMMARY, TOPK, with_ctes
from tidemark.schemas import MARKET_FIELDS, MARKET_SCHEMA
from tidemark.session import staging_path
from tidemark.sinks import writers
from tidemark.sources import files


def _tables(spark, *prefixes: str) -> list[str]:
    return [writers.staging_table(spark, p) for p in prefixes]


@query("snk_overwrite_roundtrip", with_ctes(*MARKET_CHAIN, LATEST, SUMMARY, select="SELECT * FROM summary"))
def snk_overwrite_roundtrip(spark, sf_dir):
    """SNK-1: a managed table overwritten with a different schema (silver → gold summary), then read."""
    ticks, name = _tables(spark, "silver_market_ticks", "gold_market_summary")
    writers.overwrite_table(silver(spark, sf_dir), ticks)
    writers.overwrite_table(spark.table(ticks).select(*MARKET_FIELDS), name)
    writers.overwrite_table(market.gold_summary(spark.table(ticks)), name)
    return spark.table(name)


@query(
    "snk_split_by_type",
    with_ctes(
        *MARKET_CHAIN,
        TOPK,
        select="SELECT CASE asset_type WHEN 'stock' THEN 'gold_top_stock_transactions' "
        "ELSE 'gold_top_crypto_transactions' END AS target, * FROM topk",
    ),
)
def snk_split_by_type(spark, sf_dir):
    """SNK-2: one top-k result, computed once, split into a stock table and a crypto table."""
    targets = ("gold_top_stock_transactions", "gold_top_crypto_transactions")
    names = dict(zip(("stock", "crypto"), _tables(spark, *targets), strict=True))
    writers.split_by_value(market.top_transactions(silver(spark, sf_dir)), "asset_type", names)
    stock, crypto = (spark.table(n).select(F.lit(t).alias("target"), "*") for n, t in zip(names.values(), targets, strict=True))
    return stock.unionByName(crypto)


@query("snk_jsonl_roundtrip", FEED_BUILD_SQL)
def snk_jsonl_roundtrip(spark, sf_dir):
    """SNK-3: the normalised feed batch written as sorted-key JSON lines and read back."""
    path = staging_path(spark, "feed_jsonl")
    writers.write_jsonl(build_feed(spark, sf_dir), path)
    return files.read_jsonl(spark, path, MARKET_SCHEMA)


@query(
    "snk_drop_tables",
    with_ctes(
        *MARKET_CHAIN,
        LATEST,
        select="SELECT 'silver_market_ticks' AS layer, 'dropped' AS state, CAST(count(*) AS BIGINT) AS rows_before FROM silver "
        "UNION ALL SELECT 'gold_market_summary', 'dropped', CAST(count(*) AS BIGINT) FROM latest",
    ),
)
def snk_drop_tables(spark, sf_dir):
    """SNK-5: managed tables are made and counted, dropped (twice: idempotent), and the catalog's listing afterwards."""
    layers = ("silver_market_ticks", "gold_market_summary")
    names = _tables(spark, *layers)
    writers.overwrite_table(silver(spark, sf_dir), names[0])
    writers.overwrite_table(market.gold_summary(spark.table(names[0])), names[1])
    counts = [spark.table(n).agg(F.count(F.lit(1)).alias("rows_before")).withColumn("name", F.lit(n)) for n in names]
    before = materialize(counts[0].unionByName(counts[1]), "row-counts")
    writers.drop_tables(spark, names)
    writers.drop_tables(spark, names)
    states = writers.table_states(spark, names).join(before, "name")
    layer = F.regexp_extract("name", r"([a-z_]+)_[0-9a-f]{12}$", 1).alias("layer")
    return states.select(layer, "state", "rows_before")
