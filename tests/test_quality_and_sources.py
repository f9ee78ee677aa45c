"""Quality operators and file sources."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import SAMPLE_BATCH, write_jsonl
from tidemark.operators import quality as qa
from tidemark.plans import market, market_checks
from tidemark.schemas import MARKET_SCHEMA
from tidemark.sinks import writers
from tidemark.sources import files


def test_market_validation_passes_on_clean_batch(spark, tmp_path):
    bronze = files.read_market_batch(spark, write_jsonl(tmp_path / "b.jsonl", SAMPLE_BATCH))
    silver = market.silver(bronze)
    res = market_checks.validation(
        bronze, silver, market.gold_summary(silver), market.top_for_type(silver, "stock"), market.top_for_type(silver, "crypto")
    )
    assert qa.enforce(res).where(~F.col("passed")).count() == 0


def test_validation_reports_null_ingestion_time(spark, tmp_path):
    rec = dict(SAMPLE_BATCH[0])
    del rec["ingestion_time"]
    bronze = files.read_market_batch(spark, write_jsonl(tmp_path / "b.jsonl", [rec]))
    silver = market.silver(bronze)
    res = {r["check"]: r["violations"] for r in qa.rule_counts(silver, market_checks.silver_rules(), "s").collect()}
    assert res["null_required"] == 1  # silver keeps it (T8); QA reports it


def test_key_set_diff_both_ways(spark):
    a = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,), (3,), (None,)], "k int")
    got = sorted((r["side"], r["k"]) for r in qa.key_set_diff(a, b, ["k"]).collect())
    assert got == [("missing", 1), ("unexpected", 3)]


def test_schema_contract(spark):
    df = spark.createDataFrame([(1, 2)], "a int, z int")
    assert qa.schema_contract(df, {"a", "b"}) == (["b"], ["z"])


def test_quarantine_of_malformed_lines(spark, tmp_path):
    path = write_jsonl(tmp_path / "q.jsonl", SAMPLE_BATCH[:1], extra_lines=["{broken"])
    df = files.read_jsonl(spark, path, MARKET_SCHEMA, quarantine_column="_corrupt").cache()
    assert df.where(F.col("_corrupt").isNotNull()).count() == 1


def test_first_batch(spark, tmp_path):
    root = tmp_path / "landing"
    root.mkdir()
    write_jsonl(root / "old.jsonl", SAMPLE_BATCH)
    assert files.first_batch(spark, str(root), ["new.jsonl", "old.jsonl"]).endswith("/old.jsonl")
    write_jsonl(root / "new.jsonl", SAMPLE_BATCH)
    assert files.first_batch(spark, str(root), ["new.jsonl", "old.jsonl"]).endswith("/new.jsonl")
    with pytest.raises(ValueError):
        files.first_batch(spark, str(root), ["../x.jsonl"])
    with pytest.raises(FileNotFoundError):
        files.first_batch(spark, str(root), ["missing.jsonl"])


def test_tables_overwrite_split_and_drop(spark, tmp_path):
    bronze = files.read_market_batch(spark, write_jsonl(tmp_path / "b.jsonl", SAMPLE_BATCH))
    silver = market.silver(bronze)
    names = writers.market_table_names("dev", "tester@example.com")
    writers.overwrite_table(silver, names["silver"])
    writers.overwrite_table(market.gold_summary(spark.table(names["silver"])), names["summary"])
    writers.split_by_value(
        market.top_transactions(spark.table(names["silver"])), "asset_type",
        {"stock": names["top_stocks"], "crypto": names["top_crypto"]},
    )
    assert spark.table(names["top_stocks"]).count() == 2 and spark.table(names["top_crypto"]).count() == 2
    writers.drop_tables(spark, list(names.values()))
    assert not any(spark.catalog.tableExists(n) for n in names.values())


def test_current_principal_scalar(spark):
    assert writers.current_principal(spark)


def test_scale_conf_sizes_partitions():
    from tidemark.session import scale_conf

    conf = scale_conf(100 * 1024**4, cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600
    assert scale_conf(1024, cores=8)["spark.sql.shuffle.partitions"] == "16"


def test_equal_key_sets_exchange_no_keys(spark):
    from tidemark.operators.quality import differing_buckets, key_set_diff

    a = spark.range(5000).selectExpr("id AS k", "CAST(id % 7 AS STRING) AS s")
    same = a.orderBy(F.xxhash64("k")).repartition(3)
    assert differing_buckets(a, same, ["k", "s"]).isEmpty()
    diff = key_set_diff(a, same, ["k", "s"])
    assert diff.count() == 0
    # other keys, a key twice, a null key
    other = a.where("k <> 17").unionByName(spark.createDataFrame([(9000, "x"), (3, "3"), (None, "n")], "k long, s string"))
    assert 1 <= differing_buckets(a, other, ["k", "s"]).count() <= 4
    got = {(r["side"], r["k"], r["s"]) for r in key_set_diff(a, other, ["k", "s"]).collect()}
    assert got == {("missing", 17, "3"), ("unexpected", 9000, "x"), ("unexpected", None, "n")}
    twice = a.unionByName(a.where("k < 3"))
    assert key_set_diff(a, twice, ["k", "s"]).count() == 0  # sets, however often a key is there


def test_first_and_last_need_no_sort_aggregate(spark):
    import datetime as dt

    from tidemark.plans import analytics

    at = dt.datetime(2026, 7, 1)
    rows = [("A", "stock", 1.0, 1.0, at, 2**63 - 1), ("A", "stock", 2.0, 1.0, at, -(2**63)), ("A", "stock", 3.0, 1.0, at, 5),
            ("B", "stock", 4.0, 1.0, dt.datetime(1900, 1, 1), 1), ("B", "stock", 5.0, 1.0, at, 0), ("B", "stock", 6.0, 1.0, at, 0)]
    ticks = spark.createDataFrame(rows, "symbol string, asset_type string, price double, volume double, event_time timestamp, event_id long")
    for plan in (analytics.candles(ticks), analytics.symbol_performance(ticks), analytics.trend_ma(ticks)):
        assert "SortAggregate" not in plan._jdf.queryExecution().executedPlan().toString()
    ends = {r["symbol"]: (r["first_price"], r["last_price"]) for r in analytics.symbol_performance(ticks).collect()}
    assert ends["A"] == (2.0, 1.0) and ends["B"][0] == 4.0 and ends["B"][1] in (5.0, 6.0)
