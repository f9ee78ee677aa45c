"""DuckDB SQL building blocks for the oracles.

These restate the bindings and the medallion layers in plain SQL, written
independently of the Spark code, so an oracle is ``WITH <ctes> SELECT ...``.
"""

from __future__ import annotations

SOURCE_FILE = "market_batch.jsonl"
ORDERS_FILE = "sample_orders.csv"
RUN_TS = "2031-02-03T04:05:06.000007+00:00"



def positive_decimal(text: str) -> str:
    """Positive decimal text with an exponent of at most a million either way."""
    return (
        f"coalesce(regexp_matches({text}, '^[+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$') "
        f"AND regexp_matches(regexp_replace({text}, '[eE].*$', ''), '[1-9]') "
        f"AND (NOT regexp_matches({text}, '[eE]') OR abs(TRY_CAST({exponent_of(text)} AS BIGINT)) <= 1000000), false)"
    )


def exponent_of(text: str) -> str:
    return f"regexp_extract({text}, '[eE][+]?(-?[0-9]+)$', 1)"


def plain_decimal(text: str) -> str:
    """The plain digits of a positive decimal text, NULL for others."""
    mantissa = f"regexp_replace(ltrim({text}, '+'), '[eE].*$', '')"
    digits = f"replace({mantissa}, '.', '')"
    point = f"(length(split_part({mantissa}, '.', 1)) + coalesce(TRY_CAST({exponent_of(text)} AS BIGINT), 0))"
    before = f"CASE WHEN {point} <= 0 THEN '' ELSE left(rpad({digits}, CAST(greatest({point}, length({digits})) AS INT), '0'), {point}) END"
    after = f"CASE WHEN {point} <= 0 THEN repeat('0', -{point}) || {digits} ELSE substr({digits}, {point} + 1) END"
    return (
        f"CASE WHEN {positive_decimal(text)} THEN concat_ws('.', "
        f"regexp_replace('0' || {before}, '^0+([0-9])', '\\1'), nullif({after}, '')) END"
    )


RAW_FEED = """raw_feed AS (
  SELECT
    CASE WHEN event_type IN ('click','view','signup') THEN ' NASDAQ '
         WHEN event_type = 'purchase' THEN 'CoinBase' ELSE 'other' END AS source,
    CASE WHEN event_type IN ('click','view','signup') THEN 'Stock'
         WHEN event_type = 'purchase' THEN ' crypto' ELSE 'fx' END AS asset_type,
    CASE WHEN event_id % 89 = 0 THEN '  '
         ELSE ' ' || event_type || '-' || CAST(user_id AS VARCHAR) || ' ' END AS symbol,
    CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 103 = 0 THEN '-1.5'
         ELSE CAST(value AS VARCHAR) END AS price,
    json_extract_string(props, '$.k') AS volume,
    CASE WHEN event_id % 101 = 0 THEN 'not a time'
         ELSE strftime(ts, '%Y-%m-%dT00:00:00+00:00') END AS event_time,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS ingestion_time,
    strftime(ts, '%Y-%m') AS batch_id,
    event_id
  FROM events)"""

BRONZE = f"""bronze AS (
  SELECT source, asset_type, symbol, price, volume, event_time, ingestion_time, batch_id,
         '{SOURCE_FILE}' AS source_file, event_id
  FROM raw_feed)"""

STD = """std AS (
  SELECT lower(trim(source)) AS source, lower(trim(asset_type)) AS asset_type,
         upper(trim(symbol)) AS symbol,
         TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(volume AS DOUBLE) AS volume,
         TRY_CAST(event_time AS TIMESTAMP) AS event_time,
         TRY_CAST(ingestion_time AS TIMESTAMP) AS ingestion_time,
         batch_id, source_file, event_id
  FROM bronze)"""

VALID = """valid AS (
  SELECT * FROM std
  WHERE source IN ('nasdaq','coinbase') AND asset_type IN ('stock','crypto')
    AND symbol IS NOT NULL AND symbol <> ''
    AND price IS NOT NULL AND price > 0 AND isfinite(price)
    AND volume IS NOT NULL AND volume > 0 AND isfinite(volume)
    AND event_time IS NOT NULL)"""

SILVER = """silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_id, symbol, event_time ORDER BY event_id) AS rn
    FROM valid) WHERE rn = 1)"""

LATEST = """latest AS (
  SELECT * EXCLUDE (rn), CAST(rn AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol
        ORDER BY event_time DESC NULLS LAST, batch_id DESC NULLS LAST, event_id DESC NULLS LAST) AS rn
    FROM silver) WHERE rn = 1)"""

SUMMARY = """summary AS (
  SELECT symbol, asset_type, price AS latest_price,
         CAST(NULL AS DOUBLE) AS previous_price, CAST(NULL AS DOUBLE) AS price_change,
         CAST(NULL AS DOUBLE) AS price_change_percent,
         volume, price AS high, price AS low, event_time AS last_updated
  FROM latest)"""

TOPK = """topk AS (
  SELECT CAST(rn AS INTEGER) AS rank, source, asset_type, symbol, price, volume, transaction_value,
         event_time, ingestion_time, batch_id, source_file FROM (
    SELECT *, price * volume AS transaction_value,
           row_number() OVER (PARTITION BY asset_type
               ORDER BY price * volume DESC NULLS LAST, symbol ASC NULLS FIRST,
                        event_time ASC NULLS FIRST, event_id ASC NULLS LAST) AS rn
    FROM silver) WHERE rn <= 5)"""

TICKS = """ticks AS (
  SELECT CASE WHEN event_type = 'purchase' THEN 'coinbase' ELSE 'nasdaq' END AS source,
         CASE WHEN event_type = 'purchase' THEN 'crypto' ELSE 'stock' END AS asset_type,
         upper(event_type || '-' || CAST(user_id AS VARCHAR)) AS symbol,
         value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume,
         ts AS event_time,
         strftime(ts, '%Y-%m') AS batch_id,
         event_id
  FROM events
  WHERE event_type <> 'error' AND CAST(json_extract_string(props, '$.k') AS DOUBLE) > 0)"""

PREV = """prev AS (
  SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY event_time, event_id) AS previous_price
  FROM ticks)"""

ORDERS_IN = """orders_in AS (
  SELECT CAST(o_orderkey AS BIGINT) AS order_id,
         'Customer#' || CAST(o_custkey AS VARCHAR) AS customer,
         CASE o_orderstatus WHEN 'F' THEN 'complete' WHEN 'O' THEN 'pending'
              WHEN 'P' THEN 'cancelled' END AS status,
         o_totalprice / 5000.0 AS amount
  FROM orders)"""

BRONZE_ORDERS = f"""bronze_orders AS (
  SELECT *, '{ORDERS_FILE}' AS source_file, '{RUN_TS}' AS ingested_at_utc FROM orders_in)"""

SILVER_ORDERS = """silver_orders AS (
  SELECT order_id, customer, amount,
         CASE WHEN amount >= 50 THEN 'high' ELSE 'standard' END AS amount_bucket,
         source_file, ingested_at_utc
  FROM bronze_orders WHERE status = 'complete')"""

MARKET_CHAIN = (RAW_FEED, BRONZE, STD, VALID, SILVER)


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select
