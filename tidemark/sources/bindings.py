"""Bindings: the driver's test tables reshaped into the inputs the pipeline expects.

The pipeline consumes a raw market feed (eight text fields), clean ticks, and an
orders extract.  The driver supplies TPC-H-like tables instead, so each binding
is a projection of a whole table; work grows with the table and nothing is
sampled.  ``raw_feed`` deliberately injects dirty values (padding, bad numbers,
bad times, unknown vocabularies) on a deterministic id rule so that every
cleaning branch is exercised at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F



def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def _props_k() -> Column:
    return F.get_json_object("props", "$.k")


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events → raw market feed (all text) + ``event_id`` as the tie-break key."""
    return load(spark, sf_dir, "events").selectExpr(
        "CASE WHEN event_type IN ('click', 'view', 'signup') THEN ' NASDAQ ' "
        "WHEN event_type = 'purchase' THEN 'CoinBase' ELSE 'other' END AS source",
        "CASE WHEN event_type IN ('click', 'view', 'signup') THEN 'Stock' "
        "WHEN event_type = 'purchase' THEN ' crypto' ELSE 'fx' END AS asset_type",
        "CASE WHEN event_id % 89 = 0 THEN '  ' "
        "ELSE concat(' ', event_type, '-', CAST(user_id AS STRING), ' ') END AS symbol",
        "CASE WHEN event_id % 97 = 0 THEN 'bad' WHEN event_id % 103 = 0 THEN '-1.5' "
        "ELSE CAST(value AS STRING) END AS price",
        "get_json_object(props, '$.k') AS volume",
        "CASE WHEN event_id % 101 = 0 THEN 'not a time' "
        "ELSE date_format(ts, \"yyyy-MM-dd'T'00:00:00+00:00\") END AS event_time",
        "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'\") AS ingestion_time",
        "date_format(ts, 'yyyy-MM') AS batch_id",
        "event_id",
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events (minus errors) → clean typed ticks for the analytics layer."""
    out = load(spark, sf_dir, "events").where("event_type != 'error'").selectExpr(
        "CASE WHEN event_type = 'purchase' THEN 'coinbase' ELSE 'nasdaq' END AS source",
        "CASE WHEN event_type = 'purchase' THEN 'crypto' ELSE 'stock' END AS asset_type",
        "upper(concat(event_type, '-', CAST(user_id AS STRING))) AS symbol",
        "value AS price",
        "CAST(get_json_object(props, '$.k') AS DOUBLE) AS volume",
        "CAST(ts AS TIMESTAMP) AS event_time",
        "date_format(ts, 'yyyy-MM') AS batch_id",
        "event_id",
    )
    return out.where("volume > 0")


def landed_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ticks with the time at which they land: most at once, some an hour later, every 13th event twelve days later."""
    later = "CASE WHEN event_id % 13 = 0 THEN INTERVAL 12 DAYS WHEN event_id % 7 = 0 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOURS END"
    return ticks(spark, sf_dir).withColumn("landing_time", F.expr(f"event_time + {later}"))


def orders_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders → the orders extract (order_id, customer, status, amount)."""
    o = load(spark, sf_dir, "orders")
    st = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").cast("long").alias("order_id"),
        F.concat(F.lit("Customer#"), F.col("o_custkey").cast("string")).alias("customer"),
        F.when(st == "F", "complete").when(st == "O", "pending").when(st == "P", "cancelled").alias("status"),
        (F.col("o_totalprice") / F.lit(5000.0)).alias("amount"),
    )


def tenants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer → (bundle_target, principal) pairs for the table-name suffix rule."""
    c = load(spark, sf_dir, "customer")
    target = F.when(F.col("c_custkey") % 2 == 0, F.lit("Dev")).otherwise(F.lit("prod-EU"))
    principal = F.concat(
        F.col("c_name"), F.lit("."), F.lower(F.col("c_mktsegment")), F.lit("@Example.com")
    )
    return c.select(F.col("c_custkey").alias("tenant_id"), target.alias("bundle_target"), principal.alias("principal"))


def stock_bar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stock-side events as vendor daily-bar rows (text fields as the vendor sends them).

    One row per event: symbol ``STK<user_id>``, ``MM/dd/yyyy`` date (blank on a
    deterministic id rule, to exercise the truthiness filter), ``$``-and-comma
    close, comma-grouped volume (``k * 1000``).
    """
    ev = load(spark, sf_dir, "events").where(F.col("event_type").isin("click", "view", "signup"))
    return ev.select(
        F.concat(F.lit("STK"), F.col("user_id").cast("string")).alias("symbol"),
        F.col("user_id"),
        F.col("event_id"),
        F.col("ts"),
        F.to_date("ts").alias("day"),
        F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(F.date_format("ts", "MM/dd/yyyy")).alias("date"),
        F.concat(F.lit("$"), F.format_number("value", 2)).alias("close"),
        F.format_number(_props_k().cast("bigint") * 1000, 0).alias("volume"),
    )


def bars_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor payloads over all stock bars, at most 5 rows each, newest first.

    A payload holds a symbol's events whose ids share ``event_id div 5``, so
    every bar reaches the parser and no group grows with the data.  Symbols
    whose user id is a multiple of 37 answer with a non-200 status.
    """
    rows = stock_bar_rows(spark, sf_dir)
    grouped = rows.groupBy("symbol", "user_id", F.expr("event_id div 5").alias("pack")).agg(
        F.sort_array(
            F.collect_list(F.struct("ts", "event_id", F.struct("date", "close", "volume").alias("r"))), asc=False
        ).alias("bars")
    )
    code = F.when(F.col("user_id") % 37 == 0, F.lit(404)).otherwise(F.lit(200))
    payload = F.to_json(
        F.struct(
            F.struct(code.alias("rCode")).alias("status"),
            F.struct(F.struct(F.transform("bars", lambda b: b["r"]).alias("rows")).alias("tradesTable")).alias("data"),
        )
    )
    return grouped.select("symbol", payload.alias("payload"))


def ticker_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ticker payload per purchase event: ``{"price", "volume", "time"}`` texts.

    Product ids cycle through the three known products plus one unknown
    (``DOGE-USD``); every 11th event omits its price.
    """
    ev = load(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    m = F.col("user_id") % 4
    product = (
        F.when(m == 0, "BTC-USD").when(m == 1, "ETH-USD").when(m == 2, "SOL-USD").otherwise("DOGE-USD")
    )
    price = F.when(F.col("event_id") % 11 != 0, F.col("value").cast("string"))
    payload = F.to_json(
        F.struct(
            price.alias("price"),
            _props_k().alias("volume"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        )
    )
    return ev.select("event_id", product.alias("product_id"), payload.alias("payload"))
