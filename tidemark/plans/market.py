"""Market medallion: raw feed → bronze → silver → gold (summary, top-k per asset type).

Each layer is a ``DataFrame → DataFrame`` function, so the whole chain is one
lazy plan for Catalyst (the ``queries()`` path) or can be cut into managed
tables (the job path in :mod:`tidemark.plans.jobs`).

Scale notes
-----------
* Silver is one projection + one filter above the scan (Catalyst collapses
  them); the only shuffle is the dedup on the three keys.
* Dedup, latest-per-symbol and top-k are ``row_number`` filters.  Catalyst
  plans them as a *partial* ``WindowGroupLimit`` before the exchange and a
  final one after it, so a hot key (or the two-value ``asset_type``) reaches
  the shuffle as at most k rows per map task instead of all its rows.
* Ties are broken by a total order (``event_id`` when the feed carries it,
  else every remaining column), so reruns give identical tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.constants import ALLOWED_ASSET_TYPES, ALLOWED_SOURCES, DEDUP_KEYS, TOP_K
from tidemark.functions import lower_trim, positive_finite, try_double, try_timestamp, upper_trim
from tidemark.schemas import GOLD_SUMMARY_ORDER, MARKET_FIELDS, TOP_TRANSACTION_ORDER

TIEBREAK_COLUMN = "event_id"


def with_source_file(raw: DataFrame, source_file: str | Column) -> DataFrame:
    """PRJ-2: bronze = raw feed + lineage column."""
    col = F.lit(source_file) if isinstance(source_file, str) else source_file
    return raw.withColumn("source_file", col)


def standardize(bronze: DataFrame) -> DataFrame:
    """FN-1..4 in one projection: trim/case the vocabularies, parse numbers and times."""
    extras = [c for c in bronze.columns if c not in MARKET_FIELDS]
    return bronze.select(
        lower_trim("source").alias("source"),
        lower_trim("asset_type").alias("asset_type"),
        upper_trim("symbol").alias("symbol"),
        try_double("price").alias("price"),
        try_double("volume").alias("volume"),
        try_timestamp("event_time").alias("event_time"),
        try_timestamp("ingestion_time").alias("ingestion_time"),
        F.col("batch_id"),
        *extras,
    )


def silver_predicate() -> Column:
    """FLT-2, FLT-4, FLT-5, FLT-6 as one conjunction.

    Written so each parsed value is referenced as few times as possible:
    Catalyst inlines the projection into the pushed-down filter, so every
    reference re-evaluates the parse.  ``symbol != ''`` is unknown (dropped)
    for a NULL symbol, so it needs no separate NULL test.
    """
    return (
        F.col("source").isin(*ALLOWED_SOURCES)
        & F.col("asset_type").isin(*ALLOWED_ASSET_TYPES)
        & (F.col("symbol") != "")
        & positive_finite("price")
        & positive_finite("volume")
        & F.col("event_time").isNotNull()
    )


def tiebreak(df: DataFrame, exclude: Sequence[str] = ()) -> list[Column]:
    """Total order used after the semantic sort keys."""
    if TIEBREAK_COLUMN in df.columns:
        return [F.col(TIEBREAK_COLUMN).asc_nulls_last()]
    return [F.col(c).asc_nulls_first() for c in df.columns if c not in exclude]


def dedup_keys(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS) -> DataFrame:
    """AGG-6: one row per key tuple (NULL keys equal), survivor = lowest tie-break."""
    w = Window.partitionBy(*keys).orderBy(*tiebreak(df, exclude=keys))
    return df.withColumn("_dedup_rn", F.row_number().over(w)).where("_dedup_rn = 1").drop("_dedup_rn")


def silver(bronze: DataFrame) -> DataFrame:
    """PIP-2 silver: standardise → validity filter → dedup on (batch_id, symbol, event_time)."""
    return dedup_keys(standardize(bronze).where(silver_predicate()))


def latest_per_symbol(silver_df: DataFrame) -> DataFrame:
    """WIN-1: newest tick per symbol (partitioned by symbol only, as the summary is)."""
    order = [F.col("event_time").desc_nulls_last(), F.col("batch_id").desc_nulls_last()]
    if TIEBREAK_COLUMN in silver_df.columns:
        order.append(F.col(TIEBREAK_COLUMN).desc_nulls_last())
    else:
        order += [F.col(c).desc_nulls_last() for c in silver_df.columns if c not in ("symbol", "event_time", "batch_id")]
    w = Window.partitionBy("symbol").orderBy(*order)
    return silver_df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") == 1)


def gold_summary(silver_df: DataFrame) -> DataFrame:
    """AGG-1 (parity form): one row per symbol from its latest tick.

    The reference aggregates *after* keeping one row per symbol, so every
    group holds a single row: ``first``/``max``/``min`` reduce to that row's
    values and ``high == low == latest_price``.  We project those values
    directly instead of running a second aggregate, which saves a sort-based
    aggregation over strings; the change fields are typed NULL placeholders.
    """
    latest = latest_per_symbol(silver_df)
    null_double = F.lit(None).cast(DoubleType())
    return latest.select(
        "symbol",
        "asset_type",
        F.col("price").alias("latest_price"),
        null_double.alias("previous_price"),
        null_double.alias("price_change"),
        null_double.alias("price_change_percent"),
        "volume",
        F.col("price").alias("high"),
        F.col("price").alias("low"),
        F.col("event_time").alias("last_updated"),
    ).select(*GOLD_SUMMARY_ORDER)


def with_transaction_value(silver_df: DataFrame) -> DataFrame:
    """PRJ-5: ``price * volume``."""
    return silver_df.withColumn("transaction_value", F.col("price") * F.col("volume"))


def top_transactions(silver_df: DataFrame, k: int = TOP_K) -> DataFrame:
    """WIN-2 / SRT-4: top-k rows per asset type by transaction value (deterministic ties)."""
    valued = with_transaction_value(silver_df)
    order = [
        F.col("transaction_value").desc_nulls_last(),
        F.col("symbol").asc_nulls_first(),
        F.col("event_time").asc_nulls_first(),
        *tiebreak(valued, exclude=("asset_type", "transaction_value", "symbol", "event_time")),
    ]
    w = Window.partitionBy("asset_type").orderBy(*order)
    ranked = valued.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select(*TOP_TRANSACTION_ORDER)


def top_for_type(silver_df: DataFrame, asset_type: str, k: int = TOP_K) -> DataFrame:
    """SNK-2 input: the top-k table for one asset type.

    The equality on the window's partition key is pushed below the window, so
    each of the two gold tables computes only its own half.
    """
    return top_transactions(silver_df, k).where(F.col("asset_type") == asset_type)
