"""Feed parsing and strict/lenient normalisation (SRC-7/8/10, QA-14, PIP-3)."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import DataQualityError
from tidemark.plans import feed, jobs
from tidemark.sources import feeds


def _bars(status, rows):
    return json.dumps({"status": {"rCode": status}, "data": {"tradesTable": {"rows": rows}}})


def test_daily_bars_first_valid_row(spark):
    payloads = spark.createDataFrame(
        [
            ("AAPL", _bars(200, [{"date": "", "close": "$1.00", "volume": "1"},
                                  {"date": "07/10/2026", "close": "$1,315.32", "volume": "34,132,320"}])),
            ("MSFT", _bars(500, [{"date": "07/10/2026", "close": "$1", "volume": "1"}])),
            ("NVDA", _bars(200, [{"date": "07/10/2026", "close": None, "volume": "1"}])),
            ("TSLA", "not json"),
        ],
        "symbol string, payload string",
    )
    out = {r["symbol"]: r for r in feeds.parse_daily_bars(payloads).collect()}
    assert (out["AAPL"]["price"], out["AAPL"]["volume"], out["AAPL"]["event_time"]) == (
        "1315.32", "34132320", "2026-07-10T00:00:00+00:00")
    assert out["MSFT"]["error"] == "vendor_status"
    assert out["NVDA"]["error"] == "no_rows"
    assert out["TSLA"]["error"] == "vendor_status"


def test_tickers_and_product_map(spark):
    payloads = spark.createDataFrame(
        [("BTC-USD", json.dumps({"price": "64122.77", "volume": "2795.77", "time": "2026-07-12T15:58:21Z"})),
         ("ETH-USD", json.dumps({"price": "", "volume": "1", "time": "t"})),
         ("XRP-USD", json.dumps({"price": "1", "volume": "1", "time": "t"}))],
        "product_id string, payload string",
    )
    out = {r["product_id"]: r for r in feeds.map_products(feeds.parse_tickers(payloads), feeds.product_symbols(spark)).collect()}
    assert out["BTC-USD"]["symbol"] == "BTCUSD" and out["BTC-USD"]["error"] is None
    assert out["ETH-USD"]["error"] == "incomplete_ticker"
    assert out["XRP-USD"]["error"] == "unknown_product"


def _records(spark, rows):
    return spark.createDataFrame(rows, "source string, asset_type string, symbol string, price string, volume string, event_time string")


def test_reject_reason_order_and_strict_mode(spark):
    rows = [
        ("kraken", "fx", "", "bad", "bad", ""),
        (" NASDAQ ", "fx", "", "bad", "bad", ""),
        ("nasdaq", "Stock", " ", "bad", "bad", ""),
        ("nasdaq", "stock", "aapl", "bad", "bad", " "),
        ("nasdaq", "stock", "aapl", "-1", "bad", "t"),
        ("nasdaq", "stock", "aapl", "385.10", "0", "t"),
        ("nasdaq", "stock", "aapl", "1e1000001", "1", "t"),
        ("nasdaq", "stock", "aapl", "1", " 2.5E-99999999999 ", "t"),
        ("nasdaq", "stock", " aapl\t", "385.10", "34132320", "t"),
    ]
    tagged = feed.with_reject_reason(_records(spark, rows)).collect()
    assert [r["reject_reason"] for r in tagged] == list(feed.REASONS) + ["accepted"]
    accepted, rejected = feed.normalize(_records(spark, rows), batch_id="b", ingestion_time="now", strict=False)
    assert accepted.count() + rejected.count() == len(rows) == 9
    a = accepted.first()
    assert (a["symbol"], a["price"], a["volume"], a["batch_id"]) == ("AAPL", "385.10", "34132320", "b")
    with pytest.raises(DataQualityError):
        feed.normalize(_records(spark, rows), strict=True)


def test_batch_stamp_is_one_value_per_batch(spark):
    rows = [("nasdaq", "stock", "A", "1", "1", "t"), ("coinbase", "crypto", "B", "2", "2", "t")]  # price, volume, time
    accepted, _ = feed.normalize(_records(spark, rows))
    assert accepted.select(F.countDistinct("batch_id"), F.countDistinct("ingestion_time")).first() == (1, 1)


def test_feed_build_job_writes_normalised_jsonl(spark, tmp_path):
    from tidemark.plans import jobs
    from tidemark.schemas import MARKET_SCHEMA

    bars = spark.createDataFrame(
        [("AAPL", _bars(200, [{"date": "07/10/2026", "close": "$315.32", "volume": "34,132,320"}]))],
        "symbol string, payload string",
    )
    tickers = spark.createDataFrame(
        [("BTC-USD", json.dumps({"price": "64122.77", "volume": "2795.77064009", "time": "2026-07-12T15:58:21.998137659Z"}))],
        "product_id string, payload string",
    )
    out = jobs.feed_build(bars, tickers, feeds.product_symbols(spark), str(tmp_path / "feed"), batch_id="b-1")
    rows = {r["symbol"]: r for r in spark.read.schema(MARKET_SCHEMA).json(out).collect()}
    assert rows["AAPL"]["price"] == "315.32" and rows["AAPL"]["volume"] == "34132320"
    assert rows["AAPL"]["event_time"] == "2026-07-10T00:00:00+00:00"
    assert rows["BTCUSD"]["source"] == "coinbase" and rows["BTCUSD"]["batch_id"] == "b-1"
    first_line = spark.read.text(out).first()[0]
    keys = list(json.loads(first_line))
    assert keys == sorted(keys)  # sorted keys, one object per line


@pytest.mark.parametrize(
    "symbol,payload",
    [("A", _bars(404, [])), ("A", _bars(200, [])), ("A", _bars(200, [{"date": "13/40/2026", "close": "$1", "volume": "1"}]))],
)
def test_strict_build_stops_on_vendor_errors(spark, tmp_path, symbol, payload):
    good = _bars(200, [{"date": "07/10/2026", "close": "$2.50", "volume": "10"}])
    bars = spark.createDataFrame([("G", good), (symbol, payload)], "symbol string, payload string")
    products = feeds.product_symbols(spark)
    with pytest.raises(DataQualityError):
        jobs.feed_build(bars, None, products, str(tmp_path / "out"))
    jobs.feed_build(bars, None, products, str(tmp_path / "out"), strict=False, reject_dir=str(tmp_path / "rejects"))
    assert [r["symbol"] for r in spark.read.json(str(tmp_path / "out")).collect()] == ["G"]
    assert [r["symbol"] for r in spark.read.json(str(tmp_path / "rejects")).collect()] == ["A"]


@pytest.mark.parametrize("product,payload", [("BTC-USD", '{"price": "1"}'), ("DOGE-USD", '{"price": "1", "volume": "2", "time": "t"}')])
def test_strict_build_stops_on_ticker_errors(spark, tmp_path, product, payload):
    tickers = spark.createDataFrame([(product, payload)], "product_id string, payload string")
    with pytest.raises(DataQualityError):
        jobs.feed_build(None, tickers, feeds.product_symbols(spark), str(tmp_path / "out"))


def test_products_of_the_caller_are_joined_without_a_forced_broadcast(spark):
    tickers = feeds.parse_tickers(spark.createDataFrame([("P1", '{"price":"1","volume":"2","time":"t"}')], "product_id string, payload string"))
    own = spark.createDataFrame([("P1", "S1")], "product_id string, symbol string")
    hinted = lambda df: "strategy=broadcast" in df._jdf.queryExecution().analyzed().toString()
    assert not hinted(feeds.map_products(tickers, own)) and hinted(feeds.map_products(tickers, feeds.product_symbols(spark)))
    assert feeds.map_products(tickers, own).first()["symbol"] == "S1"


def test_a_build_parses_every_payload_once(spark, tmp_path, monkeypatch):
    from tidemark.plans import jobs

    calls = spark.sparkContext.accumulator(0)

    def seen(text):
        calls.add(1)
        return text

    payload = '{"price":"10.5","volume":"2","time":"2031-01-01T00:00:00Z"}'
    texts = spark.createDataFrame([("BTC-USD", payload)] * 20, "product_id string, payload string")
    texts = texts.withColumn("payload", F.udf(seen)("payload"))
    jobs.feed_build(None, texts, feeds.product_symbols(spark), str(tmp_path / "out"), strict=True)
    assert calls.value == 20 and spark.read.json(str(tmp_path / "out")).count() == 20
