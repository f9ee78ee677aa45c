"""Vendor payload sources (SRC-7..10).

The reference fetches one HTTP payload per symbol and parses it with Python
dicts.  Network fetching is out of scope; what is kept is the *parsing*,
re-expressed over a DataFrame of payload texts so any number of symbols is
parsed in parallel:

* SRC-7 nested daily bars: ``from_json`` → status check → keep rows whose
  date, close and volume are all non-empty → first row → feed record.
* SRC-8 flat ticker: ``from_json`` → non-empty price, volume, time.
* SRC-9 request window: bars on or after ``asof - 45 days``, newest 5 per symbol.
* SRC-10 product id → symbol through a fixed dimension table, broadcast
  because its size is fixed by the constant map (3 rows), not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.constants import BARS_PER_SYMBOL, CRYPTO_PRODUCTS, LOOKBACK_DAYS, VENDOR_OK_CODE
from tidemark.functions import bar_date_iso, clean_number_text
from tidemark.schemas import BARS_PAYLOAD_SCHEMA, TICKER_SCHEMA


def _nonempty(c: Column) -> Column:
    """Python truthiness of a JSON string field: present and not ``""``."""
    return F.coalesce(c, F.lit("")) != ""


def parse_daily_bars(payloads: DataFrame, symbol: str = "symbol", payload: str = "payload") -> DataFrame:
    """SRC-7: one feed record per payload, or an ``error`` describing why not.

    Output: source, asset_type, symbol, price, volume, event_time (text), error.
    """
    parsed = payloads.select(F.col(symbol).alias("symbol"), F.from_json(payload, BARS_PAYLOAD_SCHEMA).alias("p"))
    rows = F.filter(
        F.col("p.data.tradesTable.rows"),
        lambda r: _nonempty(r["date"]) & _nonempty(r["close"]) & _nonempty(r["volume"]),
    )
    first = F.try_element_at(rows, F.lit(1))
    stage = parsed.select("symbol", F.col("p.status.rCode").alias("code"), first.alias("bar"))
    event_time = bar_date_iso(F.col("bar.date"))
    error = (
        F.when(F.col("code").isNull() | (F.col("code") != VENDOR_OK_CODE), F.lit("vendor_status"))
        .when(F.col("bar").isNull(), F.lit("no_rows"))
        .when(event_time.isNull(), F.lit("bad_date"))
    )
    ok = error.isNull()
    return stage.select(
        F.lit("nasdaq").alias("source"),
        F.lit("stock").alias("asset_type"),
        "symbol",
        F.when(ok, clean_number_text(F.col("bar.close"))).alias("price"),
        F.when(ok, clean_number_text(F.col("bar.volume"))).alias("volume"),
        F.when(ok, event_time).alias("event_time"),
        error.alias("error"),
    )


def parse_tickers(payloads: DataFrame, product: str = "product_id", payload: str = "payload") -> DataFrame:
    """SRC-8: flat ticker text → (product_id, price, volume, event_time, error)."""
    keep = [c for c in payloads.columns if c not in (product, payload)]
    p = payloads.select(*keep, F.col(product).alias("product_id"), F.from_json(payload, TICKER_SCHEMA).alias("t"))
    complete = _nonempty(F.col("t.price")) & _nonempty(F.col("t.volume")) & _nonempty(F.col("t.time"))
    return p.select(
        *keep,
        "product_id",
        F.when(complete, F.col("t.price")).alias("price"),
        F.when(complete, F.col("t.volume")).alias("volume"),
        F.when(complete, F.col("t.time")).alias("event_time"),
        F.when(~complete, F.lit("incomplete_ticker")).alias("error"),
    )


def product_symbols(spark: SparkSession) -> DataFrame:
    """SRC-10: the fixed product → symbol dimension (size fixed by the constant map)."""
    fixed = spark.createDataFrame(list(CRYPTO_PRODUCTS.items()), "product_id string, symbol string")
    return fixed.hint("broadcast")


def map_products(tickers: DataFrame, products: DataFrame) -> DataFrame:
    """SRC-10: attach the feed symbol; unknown products get ``unknown_product``.

    The fixed dimension carries its own broadcast hint; a table that the
    caller brings is joined as its size at run time allows.
    """
    joined = tickers.join(products, "product_id", "left")
    keep = [c for c in tickers.columns if c not in ("product_id", "price", "volume", "event_time", "error")]
    return joined.select(
        *keep,
        F.lit("coinbase").alias("source"),
        F.lit("crypto").alias("asset_type"),
        "product_id",
        "symbol",
        "price",
        "volume",
        "event_time",
        F.coalesce(F.col("error"), F.when(F.col("symbol").isNull(), F.lit("unknown_product"))).alias("error"),
    )


def lookback_window(
    bars: DataFrame,
    asof: Column,
    key: str = "symbol",
    day: str = "day",
    order: tuple[Column, ...] = (),
    days: int = LOOKBACK_DAYS,
    limit: int = BARS_PER_SYMBOL,
) -> DataFrame:
    """SRC-9: rows with ``day >= asof - days``, newest ``limit`` per key.

    The limit is a ``row_number`` filter, so Catalyst applies it per map task
    before the shuffle (partial WindowGroupLimit): a key with a third of all
    rows still ships at most ``limit`` rows per task.
    """
    recent = bars.where(F.col(day) >= F.date_sub(asof, days))
    w = Window.partitionBy(key).orderBy(F.col(day).desc(), *order)
    return recent.withColumn("bar_rank", F.row_number().over(w)).where(F.col("bar_rank") <= limit)
