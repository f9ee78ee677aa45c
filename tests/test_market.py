"""Market medallion on the reference's own fixtures, plus the traps of the survey (T1-T9)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import LATEST_BATCH, LATEST_TOP, SAMPLE_BATCH, SAMPLE_TOP, write_jsonl
from tidemark.plans import market
from tidemark.schemas import GOLD_SUMMARY_COLUMNS, TOP_TRANSACTION_COLUMNS
from tidemark.sources import files


def _bronze(spark, tmp_path, records, extra_lines=(), name="batch.jsonl"):
    path = write_jsonl(tmp_path / name, records, extra_lines)
    return files.read_market_batch(spark, path)


def test_sample_batch_top_transactions(spark, tmp_path):
    silver = market.silver(_bronze(spark, tmp_path, SAMPLE_BATCH, name="sample_market_batch.jsonl"))
    top = market.top_transactions(silver).collect()
    got = {t: [(r["rank"], r["symbol"], r["transaction_value"]) for r in sorted(top, key=lambda r: r["rank"]) if r["asset_type"] == t]
           for t in ("stock", "crypto")}
    assert got == SAMPLE_TOP
    assert {r["source_file"] for r in top} == {"sample_market_batch.jsonl"}


def test_latest_batch_matches_golden_output(spark, tmp_path):
    silver = market.silver(_bronze(spark, tmp_path, LATEST_BATCH))
    assert silver.count() == 8
    top = market.top_transactions(silver)
    assert set(top.columns) == TOP_TRANSACTION_COLUMNS
    for t, expected in LATEST_TOP.items():
        rows = market.top_for_type(silver, t).orderBy("rank").collect()
        got = [(r["rank"], r["symbol"], r["price"], r["volume"], r["transaction_value"]) for r in rows]
        assert got == expected


def test_summary_parity_and_timestamp_precision(spark, tmp_path):
    silver = market.silver(_bronze(spark, tmp_path, LATEST_BATCH))
    summary = market.gold_summary(silver)
    assert set(summary.columns) == GOLD_SUMMARY_COLUMNS
    rows = {r["symbol"]: r for r in summary.collect()}
    assert len(rows) == 8
    for r in rows.values():
        assert r["high"] == r["low"] == r["latest_price"]
        assert r["previous_price"] is None and r["price_change"] is None and r["price_change_percent"] is None
    btc = summary.where("symbol = 'BTCUSD'").select(F.col("last_updated").cast("timestamp_ntz")).first()[0]
    assert btc == dt.datetime(2031, 2, 2, 11, 22, 33, 123456)  # 9 digits truncated to micros


DIRTY = [
    # padding and case → kept as nasdaq / AAPL
    dict(source=" NASDAQ ", asset_type="Stock", symbol=" aapl ", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="BAD1", price="bad", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="BAD2", price="10", volume="5",
         event_time="not a time", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="ZERO", price="10", volume="0",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="NEG", price="-1", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="NAN", price="NaN", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="kraken", asset_type="stock", symbol="KRK", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="fx", symbol="FX", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="  ", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    # duplicate key, other price → one survivor
    dict(source="nasdaq", asset_type="stock", symbol="DUP", price="11", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="nasdaq", asset_type="stock", symbol="DUP", price="12", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    # missing batch_id / ingestion_time → kept (T8); NULL duplicate keys → one row (T9)
    dict(source="nasdaq", asset_type="stock", symbol="NOBATCH", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00"),
    dict(source="nasdaq", asset_type="stock", symbol="NOBATCH", price="13", volume="5",
         event_time="2026-07-01T00:00:00+00:00"),
    # same symbol in both asset types (T6): summary keeps one row, the newer (crypto)
    dict(source="nasdaq", asset_type="stock", symbol="X", price="10", volume="5",
         event_time="2026-07-01T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    dict(source="coinbase", asset_type="crypto", symbol="X", price="20", volume="5",
         event_time="2026-07-02T00:00:00+00:00", ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b1"),
    # unquoted number is read as text (T5)
]


def test_dirty_rows(spark, tmp_path):
    bronze = _bronze(spark, tmp_path, DIRTY, extra_lines=['not json', '{"source": "nasdaq", "asset_type": "stock", '
                     '"symbol": "UNQ", "price": 64122.77, "volume": 2, "event_time": "2026-07-01T00:00:00Z", '
                     '"ingestion_time": "2026-07-01T00:01:00Z", "batch_id": "b1"}'])
    assert bronze.count() == len(DIRTY) + 2  # malformed line is an all-NULL bronze row (T4)
    assert bronze.where("symbol = 'UNQ'").first()["price"] == "64122.77"
    silver = market.silver(bronze)
    symbols = sorted(r["symbol"] for r in silver.collect())
    assert symbols == ["AAPL", "DUP", "NOBATCH", "UNQ", "X", "X"]
    aapl = silver.where("symbol = 'AAPL'").first()
    assert aapl["source"] == "nasdaq" and aapl["asset_type"] == "stock"
    summary = {r["symbol"]: r for r in market.gold_summary(silver).collect()}
    assert summary["X"]["asset_type"] == "crypto" and summary["X"]["latest_price"] == 20.0


def test_dedup_is_deterministic_with_event_id(spark):
    rows = [("b", "S", "2026-07-01T00:00:00+00:00", 5, "9"), ("b", "S", "2026-07-01T00:00:00+00:00", 3, "7")]
    df = spark.createDataFrame(rows, "batch_id string, symbol string, event_time string, event_id long, price string")
    out = market.dedup_keys(df).collect()
    assert [(r["event_id"], r["price"]) for r in out] == [(3, "7")]


def test_ties_in_top_k_are_broken_deterministically(spark):
    base = dict(source="nasdaq", asset_type="stock", volume="10", event_time="2026-07-01T00:00:00+00:00",
                ingestion_time="2026-07-01T00:01:00+00:00", batch_id="b")
    rows = [dict(base, symbol=s, price="5") for s in ("C", "A", "B", "E", "D", "F")]
    df = spark.createDataFrame(rows).withColumn("source_file", F.lit("f"))
    top = market.top_transactions(market.silver(df)).orderBy("rank").collect()
    assert [r["symbol"] for r in top] == ["A", "B", "C", "D", "E"]


def test_ansi_mode_does_not_raise_on_bad_text(spark, tmp_path):
    assert spark.conf.get("spark.sql.ansi.enabled") in ("true", None, "True")
    bronze = _bronze(spark, tmp_path, [dict(SAMPLE_BATCH[0], price="bad", event_time="nope")])
    assert market.silver(bronze).count() == 0


@pytest.mark.parametrize("asset_type", ["stock", "crypto"])
def test_split_filter_is_pushed_below_window(spark, tmp_path, asset_type):
    silver = market.silver(_bronze(spark, tmp_path, LATEST_BATCH))
    plan = market.top_for_type(silver, asset_type)._jdf.queryExecution().optimizedPlan().toString()
    window_at = plan.find("Window")
    filter_at = plan.find(f"= {asset_type})")
    assert window_at != -1 and filter_at > window_at  # the filter sits under (after, in tree text) the window
