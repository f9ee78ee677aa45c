"""Feed re-aim queries (SRC-7..10, SET-1, FLT-13, FN-10/11/12, QA-14, PIP-3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import feed
from tidemark.registry import query
from tidemark.registry.sql import RUN_TS, positive_decimal, with_ctes
from tidemark.sources import bindings, feeds

FEED_BATCH = "feed-batch-0001"

# DuckDB restatement of the stock bars (flat events, before any JSON).
BARS = """bars AS (
  SELECT 'STK' || CAST(user_id AS VARCHAR) AS symbol, user_id, event_id, ts, CAST(ts AS DATE) AS day,
         event_id % 7 = 0 AS blank_date, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS vol
  FROM events WHERE event_type IN ('click','view','signup')),
packs AS (
  SELECT *, event_id // 5 AS pack,
         row_number() OVER (PARTITION BY symbol, event_id // 5 ORDER BY ts DESC, event_id DESC) AS rk FROM bars),
firstok AS (
  SELECT symbol, pack, any_value(user_id) AS user_id, min(rk) FILTER (WHERE NOT blank_date) AS rk
  FROM packs GROUP BY symbol, pack),
bar_records AS (
  SELECT 'nasdaq' AS source, 'stock' AS asset_type, f.symbol,
         CASE WHEN f.user_id % 37 <> 0 AND f.rk IS NOT NULL THEN printf('%.2f', l.value) END AS price,
         CASE WHEN f.user_id % 37 <> 0 AND f.rk IS NOT NULL THEN CAST(l.vol AS VARCHAR) END AS volume,
         CASE WHEN f.user_id % 37 <> 0 AND f.rk IS NOT NULL
              THEN strftime(l.day, '%Y-%m-%d') || 'T00:00:00+00:00' END AS event_time,
         CASE WHEN f.user_id % 37 = 0 THEN 'vendor_status' WHEN f.rk IS NULL THEN 'no_rows' END AS error
  FROM firstok f LEFT JOIN packs l ON l.symbol = f.symbol AND l.pack = f.pack AND l.rk = f.rk)"""

LOOKBACK = """windowed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY day DESC, ts DESC, event_id DESC) AS INTEGER) AS bar_rank
  FROM bars WHERE day >= (SELECT max(day) FROM bars) - INTERVAL 45 DAY),
lim AS (SELECT * FROM windowed WHERE bar_rank <= 5)"""

TICKERS = """tickers AS (
  SELECT event_id,
         CASE user_id % 4 WHEN 0 THEN 'BTC-USD' WHEN 1 THEN 'ETH-USD' WHEN 2 THEN 'SOL-USD' ELSE 'DOGE-USD' END AS product_id,
         CASE WHEN event_id % 11 <> 0 THEN CAST(value AS VARCHAR) END AS price_text,
         json_extract_string(props, '$.k') AS volume_text,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS time_text
  FROM events WHERE event_type = 'purchase'),
ticker_records AS (
  SELECT event_id, 'coinbase' AS source, 'crypto' AS asset_type, product_id,
         CASE product_id WHEN 'BTC-USD' THEN 'BTCUSD' WHEN 'ETH-USD' THEN 'ETHUSD' WHEN 'SOL-USD' THEN 'SOLUSD' END AS symbol,
         CASE WHEN price_text IS NOT NULL THEN price_text END AS price,
         CASE WHEN price_text IS NOT NULL THEN volume_text END AS volume,
         CASE WHEN price_text IS NOT NULL THEN time_text END AS event_time,
         CASE WHEN price_text IS NULL THEN 'incomplete_ticker'
              WHEN product_id = 'DOGE-USD' THEN 'unknown_product' END AS error
  FROM tickers)"""


def bar_records(spark, sf_dir):
    return feeds.parse_daily_bars(bindings.bars_json(spark, sf_dir))


def ticker_records(spark, sf_dir):
    parsed = feeds.parse_tickers(bindings.ticker_json(spark, sf_dir))
    return feeds.map_products(parsed, feeds.product_symbols(spark))


def _ok(df):
    return df.where(F.col("error").isNull())


@query("src_nested_bars_first", with_ctes(BARS, select="SELECT * FROM bar_records"))
def src_nested_bars_first(spark, sf_dir):
    """SRC-7 / FN-10 / FN-11 / FLT-12: nested payload → first valid bar → feed record (or error)."""
    return bar_records(spark, sf_dir)


@query(
    "src_lookback_limit",
    with_ctes(BARS, LOOKBACK, select="SELECT symbol, event_id, day, bar_rank FROM lim"),
)
def src_lookback_limit(spark, sf_dir):
    """SRC-9 / FN-14: bars within 45 days of the newest day, at most 5 per symbol."""
    rows = bindings.stock_bar_rows(spark, sf_dir)
    asof = rows.select(F.max("day")).scalar()
    win = feeds.lookback_window(rows, asof, order=(F.col("ts").desc(), F.col("event_id").desc()))
    return win.select("symbol", "event_id", "day", "bar_rank")


@query(
    "src_ticker_json",
    with_ctes(
        BARS,
        TICKERS,
        select="SELECT event_id, product_id, price, volume, event_time, "
        "CASE WHEN price IS NULL THEN 'incomplete_ticker' END AS error FROM ticker_records",
    ),
)
def src_ticker_json(spark, sf_dir):
    """SRC-8 / FN-15: flat ticker JSON → price, volume, time (incomplete payloads flagged)."""
    return feeds.parse_tickers(bindings.ticker_json(spark, sf_dir))


@query(
    "src_symbol_map",
    with_ctes(BARS, TICKERS, select="SELECT event_id, product_id, symbol, error FROM ticker_records"),
)
def src_symbol_map(spark, sf_dir):
    """SRC-10: product id → feed symbol through the fixed, broadcast dimension."""
    return ticker_records(spark, sf_dir).select("event_id", "product_id", "symbol", "error")


@query(
    "feed_errors",
    with_ctes(
        BARS,
        TICKERS,
        select="SELECT source, error, CAST(count(*) AS BIGINT) AS payloads FROM ("
        "SELECT source, error FROM bar_records UNION ALL SELECT source, error FROM ticker_records) "
        "WHERE error IS NOT NULL GROUP BY source, error",
    ),
)
def feed_errors(spark, sf_dir):
    """PIP-3: payloads that give no record, counted by feed and reason."""
    return feed.error_counts(bar_records(spark, sf_dir), ticker_records(spark, sf_dir))


FEED_UNION = (
    "SELECT source, asset_type, symbol, price, volume, event_time FROM bar_records WHERE error IS NULL "
    "UNION ALL SELECT source, asset_type, symbol, price, volume, event_time FROM ticker_records WHERE error IS NULL"
)
UNION_SQL = with_ctes(BARS, TICKERS, select=FEED_UNION)


@query("set_union_feeds", UNION_SQL)
def set_union_feeds(spark, sf_dir):
    """SET-1: union-all of the stock and crypto feed records."""
    return feed.union_feeds(_ok(bar_records(spark, sf_dir)), _ok(ticker_records(spark, sf_dir)))


def _normalised_sql(source_sql: str) -> str:
    return f"""SELECT source, asset_type, symbol, price, volume, event_time,
       '{RUN_TS}' AS ingestion_time, '{FEED_BATCH}' AS batch_id
FROM ({source_sql})
WHERE {positive_decimal("price")} AND {positive_decimal("volume")}
  AND symbol <> '' AND event_time <> ''"""


CRYPTO_ONLY_SQL = with_ctes(
    BARS,
    TICKERS,
    select=_normalised_sql(
        "SELECT source, asset_type, symbol, price, volume, event_time FROM ticker_records WHERE error IS NULL"
    ),
)

FEED_BUILD_SQL = with_ctes(BARS, TICKERS, select=_normalised_sql(FEED_UNION))


def build_feed(spark, sf_dir, include_stocks=True, include_crypto=True):
    """PIP-3: parse → map → union → normalise (lenient: rejected rows are set aside)."""
    stocks = _ok(bar_records(spark, sf_dir)) if include_stocks else None
    crypto = _ok(ticker_records(spark, sf_dir)) if include_crypto else None
    accepted, _ = feed.normalize(
        feed.union_feeds(stocks, crypto), batch_id=FEED_BATCH, ingestion_time=RUN_TS, strict=False
    )
    return accepted


@query("market_feed_build", FEED_BUILD_SQL)
def market_feed_build(spark, sf_dir):
    """PIP-3 / PRJ-8 / PRJ-9 / FN-12 / FN-13: the normalised feed batch (accepted rows)."""
    return build_feed(spark, sf_dir)


@query("flt_crypto_only", CRYPTO_ONLY_SQL)
def flt_crypto_only(spark, sf_dir):
    """FLT-13: the feed toggle — crypto branch only (stocks never enter the plan)."""
    return build_feed(spark, sf_dir, include_stocks=False)


PRJ_SQL = with_ctes(
    BARS,
    TICKERS,
    f"feed_batch AS ({_normalised_sql(FEED_UNION)})",
    select="SELECT batch_id, ingestion_time, CAST(count(*) AS BIGINT) AS records FROM feed_batch "
    "GROUP BY batch_id, ingestion_time",
)


@query("prj_batch_stamp", PRJ_SQL)
def prj_batch_stamp(spark, sf_dir):
    """PRJ-9: one batch id and one ingestion time stamped on every record."""
    return build_feed(spark, sf_dir).groupBy("batch_id", "ingestion_time").agg(F.count(F.lit(1)).alias("records"))
