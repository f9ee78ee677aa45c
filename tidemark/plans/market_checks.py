"""PIP-5 (market): the validation suite over bronze, silver and the gold tables.

One aggregate pass per table (rules evaluated together with ``count_if``),
plus one grouped count for key uniqueness, instead of one job per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ALLOWED_ASSET_TYPES, ALLOWED_SOURCES, DEDUP_KEYS, TOP_K, VALUE_TOLERANCE
from tidemark.operators import quality as qa
from tidemark.schemas import MARKET_FIELDS

# --- FIXED VALUES: columns that may not be NULL -----------------------------------------
SILVER_REQUIRED = MARKET_FIELDS
GOLD_REQUIRED = ("symbol", "asset_type", "latest_price", "volume", "last_updated")


def silver_rules() -> dict:
    return {
        "null_required": qa.any_null(SILVER_REQUIRED),
        "invalid_source": ~F.col("source").isin(*ALLOWED_SOURCES),
        "invalid_asset_type": ~F.col("asset_type").isin(*ALLOWED_ASSET_TYPES),
        "invalid_numeric": (F.col("price") <= 0) | (F.col("volume") <= 0),
    }


def gold_rules() -> dict:
    return {
        "invalid_rows": qa.any_null(GOLD_REQUIRED) | (F.col("latest_price") <= 0) | (F.col("volume") <= 0),
    }


def topk_rules(expected_asset_type: str) -> dict:
    tv = F.col("transaction_value")
    return {
        "wrong_asset_type": F.col("asset_type") != expected_asset_type,
        "invalid_rank": (F.col("rank") < 1) | (F.col("rank") > TOP_K),
        "invalid_transaction_value": tv.isNull()
        | (tv <= 0)
        | (F.abs(tv - F.col("price") * F.col("volume")) > VALUE_TOLERANCE),
    }


def topk_checks(top: DataFrame, asset_type: str, table: str) -> DataFrame:
    """QA-8: at most k rows, right type, rank in 1..k, value = price × volume (within 1e-4)."""
    return qa.rule_counts(top, topk_rules(asset_type), table, {"max_rows": qa.at_most(TOP_K)})


def observers() -> dict[str, qa.Observed]:
    """The checks of bronze, silver and gold that can be taken while these are written."""
    return {
        "bronze": qa.Observed({}, "bronze_market_events", {"non_empty": qa.at_least(1)}),
        "silver": qa.Observed(silver_rules(), "silver_market_ticks", {"non_empty": qa.at_least(1)}),
        "summary": qa.Observed(gold_rules(), "gold_market_summary", {"non_empty": qa.at_least(1)}),
    }


def validation_of_written(observed: DataFrame, silver: DataFrame, top_stock: DataFrame, top_crypto: DataFrame) -> DataFrame:
    """The suite where the checks of :func:`observers` are at hand; silver is read for its keys only."""
    parts = [
        observed,
        qa.unique_key(silver, list(DEDUP_KEYS), "silver_market_ticks"),
        topk_checks(top_stock, "stock", "gold_top_stock_transactions"),
        topk_checks(top_crypto, "crypto", "gold_top_crypto_transactions"),
    ]
    return reduce(DataFrame.unionByName, parts)


def validation(
    bronze: DataFrame,
    silver: DataFrame,
    gold: DataFrame,
    top_stock: DataFrame,
    top_crypto: DataFrame,
) -> DataFrame:
    parts = [
        qa.min_rows(bronze, 1, "bronze_market_events"),
        qa.rule_counts(silver, silver_rules(), "silver_market_ticks", {"non_empty": qa.at_least(1)}),
        qa.unique_key(silver, list(DEDUP_KEYS), "silver_market_ticks"),
        qa.rule_counts(gold, gold_rules(), "gold_market_summary", {"non_empty": qa.at_least(1)}),
        topk_checks(top_stock, "stock", "gold_top_stock_transactions"),
        topk_checks(top_crypto, "crypto", "gold_top_crypto_transactions"),
    ]
    return reduce(DataFrame.unionByName, parts)
