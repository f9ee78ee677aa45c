"""The reference's jobs end to end on its own fixtures, through catalog tables."""

from __future__ import annotations

import json
import re

from tests.fixtures import LATEST_BATCH, ORDERS_CSV, SAMPLE_BATCH, write_jsonl
from tidemark.plans import jobs


def test_market_jobs_end_to_end(spark, tmp_path):
    root = tmp_path / "sample_data"
    root.mkdir()
    write_jsonl(root / "sample_market_batch.jsonl", SAMPLE_BATCH)
    write_jsonl(root / "latest_market_batch.jsonl", LATEST_BATCH)
    names = jobs.market_job(spark, str(root), "dev", principal="Tester@Example.com")
    assert names["bronze"].startswith("bronze_market_events_dev_tester_example_com_")
    assert spark.table(names["silver"]).count() == 8  # latest file preferred over sample
    res = jobs.market_validation(spark, "dev", principal="Tester@Example.com")
    assert res.where("NOT passed").count() == 0
    out = jobs.dashboard_export(spark, "dev", str(tmp_path / "dash"), principal="Tester@Example.com",
                                generated_at="2031-02-03T04:06:07.000008+00:00")
    doc = json.loads(spark.read.text(out).first()[0])
    assert list(doc) == sorted(doc)
    assert [r["symbol"] for r in doc["gold"]["top_stock_transactions"]] == ["DELT", "CHAR", "ECHO", "BRVO", "ALFA"]
    assert doc["gold"]["top_stock_transactions"][0]["rank"] == "1"
    assert doc["gold"]["latest_summary"][0]["last_updated"] == "2031-02-02T11:22:33.123Z"
    assert len(doc["bronze"]["latest_records"]) == 8
    # every value is text, rendered as the committed export renders it
    top = doc["gold"]["top_stock_transactions"][0]
    assert (top["price"], top["volume"], top["transaction_value"]) == ("7.35", "8.8E7", "6.468E8")
    delt = [r for r in doc["gold"]["latest_summary"] if r["symbol"] == "DELT"][0]
    assert (delt["volume"], delt["high"], delt["last_updated"]) == ("8.8E7", "7.35", "2031-02-01T00:00:00.000Z")
    assert [r["symbol"] for r in doc["gold"]["latest_summary"]][:3] == ["BTCUSD", "ETHUSD", "SOLUSD"]
    assert doc["bronze"]["latest_records"][0]["event_time"] == "2031-02-02T11:22:33.123456789Z"
    btc = doc["gold"]["top_crypto_transactions"][0]
    assert btc == {"event_time": "2031-02-02T11:22:33.123Z", "price": "50100.5", "rank": "1", "symbol": "BTCUSD",
                   "transaction_value": "112726.125", "volume": "2.25"}
    assert sorted(doc["tables"]) == ["bronze", "summary", "top_crypto", "top_stocks"]
    dropped = jobs.cleanup(spark, "dev", principal="Tester@Example.com")
    assert len(dropped) == 7 and not spark.catalog.tableExists(names["silver"])


def test_orders_jobs_end_to_end(spark, tmp_path):
    p = tmp_path / "sample_orders.csv"
    p.write_text(ORDERS_CSV)
    names = jobs.orders_job(spark, str(p), "dev", principal="tester")
    assert spark.table(names["bronze"]).first()["source_file"] == "sample_orders.csv"
    res = jobs.orders_validation(spark, "dev", principal="tester", expected_counts=(4, 2))
    assert res.where("NOT passed").count() == 0
    jobs.cleanup(spark, "dev", principal="tester")


def test_bucketed_orders_validate_without_join_shuffles(spark, tmp_path):
    p = tmp_path / "sample_orders.csv"
    p.write_text(ORDERS_CSV)
    names = jobs.orders_job(spark, str(p), "bkt", principal="tester", buckets=4)
    b, s = spark.table(names["bronze"]), spark.table(names["silver"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        anti = b.join(s, "order_id", "left_anti")
        anti.collect()
        assert "Exchange" not in anti._jdf.queryExecution().executedPlan().toString()
        assert jobs.orders_validation(spark, "bkt", principal="tester", expected_counts=(4, 2)).where("NOT passed").count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        jobs.cleanup(spark, "bkt", principal="tester")


def test_checks_taken_while_writing_are_those_of_a_scan(spark, tmp_path):
    root = tmp_path / "sample_data"
    root.mkdir()
    bad = [dict(SAMPLE_BATCH[0], ingestion_time=None), *SAMPLE_BATCH]
    write_jsonl(root / "latest_market_batch.jsonl", bad)
    names = jobs.market_job(spark, str(root), "obs", principal="tester")
    key = lambda r: (r["table"], r["check"])
    taken = jobs.market_validation(spark, "obs", principal="tester", strict=False)
    counted = jobs.market_validation(spark, "obs", principal="tester", strict=False, rescan=True)
    assert sorted(taken.collect(), key=key) == sorted(counted.collect(), key=key)
    scans = lambda df: len(re.findall(rf"SubqueryAlias \S+\.{names['silver']}\b", df._jdf.queryExecution().analyzed().toString()))
    assert (scans(taken), scans(counted)) == (1, 2)
    jobs.cleanup(spark, "obs", principal="tester")
    assert not [r for r in spark.sql("SHOW TABLES").collect() if "_obs_" in r["tableName"]]
