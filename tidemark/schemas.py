"""Explicit schemas and column contracts.

Nothing in the pipeline infers a schema: every file read goes through one of
the StructTypes below, and every layer is checked against its column contract
(order ignored) by ``tidemark.operators.quality.schema_contract``.
"""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# --- FIXED VALUES: fields of the market feed, in the order of its records --------------
MARKET_FIELDS = (
    "source",
    "asset_type",
    "symbol",
    "price",
    "volume",
    "event_time",
    "ingestion_time",
    "batch_id",
)

# Raw market batch: every field arrives as text.  ``nullable=False`` is not
# enforced by file sources, so QA checks it instead.
MARKET_SCHEMA = StructType([StructField(name, StringType(), nullable=False) for name in MARKET_FIELDS])

# --- FIXED VALUES: the orders extract ---------------------------------------------------
ORDERS_SCHEMA = StructType(
    [
        StructField("order_id", LongType(), nullable=False),
        StructField("customer", StringType(), nullable=False),
        StructField("status", StringType(), nullable=False),
        StructField("amount", DoubleType(), nullable=False),
    ]
)

# --- FIXED VALUES: vendor payloads ------------------------------------------------------
# Vendor daily-bar payload: {"status": {"rCode": 200}, "data": {"tradesTable": {"rows": [...]}}}
BAR_ROW_SCHEMA = StructType(
    [
        StructField("date", StringType()),
        StructField("close", StringType()),
        StructField("volume", StringType()),
    ]
)
BARS_PAYLOAD_SCHEMA = StructType(
    [
        StructField("status", StructType([StructField("rCode", IntegerType())])),
        StructField(
            "data",
            StructType(
                [
                    StructField(
                        "tradesTable",
                        StructType([StructField("rows", ArrayType(BAR_ROW_SCHEMA))]),
                    )
                ]
            ),
        ),
    ]
)

# Vendor ticker payload: flat strings.
TICKER_SCHEMA = StructType(
    [
        StructField("price", StringType()),
        StructField("volume", StringType()),
        StructField("time", StringType()),
    ]
)

# --- FIXED VALUES: columns of the layers, in their output order ------------------------
GOLD_SUMMARY_ORDER = (
    "symbol",
    "asset_type",
    "latest_price",
    "previous_price",
    "price_change",
    "price_change_percent",
    "volume",
    "high",
    "low",
    "last_updated",
)
TOP_TRANSACTION_ORDER = (
    "rank",
    "source",
    "asset_type",
    "symbol",
    "price",
    "volume",
    "transaction_value",
    "event_time",
    "ingestion_time",
    "batch_id",
    "source_file",
)
BRONZE_ORDER_COLUMNS = frozenset(
    ("order_id", "customer", "status", "amount", "source_file", "ingested_at_utc")
)
SILVER_ORDER_COLUMNS = frozenset(
    ("order_id", "customer", "amount", "amount_bucket", "source_file", "ingested_at_utc")
)

# Column contracts: the same columns, order ignored.
BRONZE_MARKET_COLUMNS = frozenset(MARKET_FIELDS + ("source_file",))
SILVER_MARKET_COLUMNS = BRONZE_MARKET_COLUMNS
GOLD_SUMMARY_COLUMNS = frozenset(GOLD_SUMMARY_ORDER)
TOP_TRANSACTION_COLUMNS = frozenset(TOP_TRANSACTION_ORDER)
