"""Hypothesis properties of the layers."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.plans import feed, market
from tidemark.schemas import MARKET_FIELDS

TEXT = st.sampled_from(["", " ", "bad", "NaN", "-1", "0", "1", "2.5", "10", "385.10", " 7 "])
RECORD = st.fixed_dictionaries(
    {
        "source": st.sampled_from(["nasdaq", " NASDAQ ", "coinbase", "kraken", ""]),
        "asset_type": st.sampled_from(["stock", "Crypto ", "fx", ""]),
        "symbol": st.sampled_from(["A", " b ", "C", "  ", ""]),
        "price": TEXT,
        "volume": TEXT,
        "event_time": st.sampled_from(
            ["2026-07-01T00:00:00+00:00", "2026-07-01T00:00:00Z", "2026-07-02T00:00:00+00:00", "x", ""]
        ),
        "ingestion_time": st.just("2026-07-02T00:00:00+00:00"),
        "batch_id": st.sampled_from(["b1", "b2"]),
    }
)
SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _bronze(spark, records):
    rows = [tuple(r[f] for f in MARKET_FIELDS) + (i,) for i, r in enumerate(records)]
    schema = ", ".join(f"{f} string" for f in MARKET_FIELDS) + ", event_id long"
    return spark.createDataFrame(rows, schema).withColumn("source_file", F.lit("f"))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


@given(st.lists(RECORD, max_size=25))
@SETTINGS
def test_silver_is_idempotent_and_unique(spark, records):
    silver = market.silver(_bronze(spark, records))
    # silver(silver) = silver: re-standardising typed values is a no-op on the kept rows
    again = market.dedup_keys(silver.where(market.silver_predicate()))
    assert _rows(again) == _rows(silver)
    assert silver.groupBy("batch_id", "symbol", "event_time").count().where("count > 1").count() == 0


@given(st.lists(RECORD, max_size=25), st.integers(min_value=1, max_value=4))
@SETTINGS
def test_top_k_bounded_and_ranked(spark, records, k):
    top = market.top_transactions(market.silver(_bronze(spark, records)), k).collect()
    for t in ("stock", "crypto"):
        ranks = sorted(r["rank"] for r in top if r["asset_type"] == t)
        assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) <= k
        values = [r["transaction_value"] for r in sorted((r for r in top if r["asset_type"] == t), key=lambda r: r["rank"])]
        assert values == sorted(values, reverse=True)


@given(st.lists(RECORD, max_size=25))
@SETTINGS
def test_accepted_plus_rejected_is_input(spark, records):
    df = _bronze(spark, records).select("source", "asset_type", "symbol", "price", "volume", "event_time")
    accepted, rejected = feed.normalize(df, batch_id="b", ingestion_time="t", strict=False)
    assert accepted.count() + rejected.count() == len(records)
