"""Streaming: incremental runs on one checkpoint are exactly-once and equal the batch answer."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import LATEST_BATCH, SAMPLE_BATCH, write_jsonl
from tidemark.plans import market
from tidemark.sinks.buckets import BucketTable
from tidemark.streaming import market_stream as ms


def _start_bronze(spark, landing, sink, ckpt):
    def start():
        raw = ms.read_feed_stream(spark, f"{landing}/*")
        return (
            ms.bronze_stream(raw).writeStream.format("parquet").option("path", sink)
            .option("checkpointLocation", ckpt).outputMode("append")
        )
    return start


def test_incremental_runs_are_exactly_once(spark, tmp_path):
    landing, sink, ckpt = tmp_path / "landing", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    (landing / "batch-1").mkdir(parents=True)
    write_jsonl(landing / "batch-1" / "a.json", SAMPLE_BATCH)
    start = _start_bronze(spark, str(landing), sink, ckpt)
    ms.run_available(start)
    assert spark.read.parquet(sink).count() == 4
    ms.run_available(start)  # nothing new landed: nothing is written again
    assert spark.read.parquet(sink).count() == 4
    (landing / "batch-2").mkdir()
    write_jsonl(landing / "batch-2" / "b.json", LATEST_BATCH)
    ms.run_available(start)
    out = spark.read.parquet(sink)
    assert out.count() == 12
    assert {r[0] for r in out.select("source_file").distinct().collect()} == {"batch-1", "batch-2"}


def test_streaming_latest_equals_batch_summary(spark, tmp_path):
    landing, ckpt = tmp_path / "landing", str(tmp_path / "ckpt")
    latest = ms.latest_table(str(tmp_path / "latest"), buckets=4)
    rows_1 = [dict(r, event_id=i) for i, r in enumerate(SAMPLE_BATCH)]
    rows_2 = [dict(r, event_id=100 + i) for i, r in enumerate(LATEST_BATCH)]
    (landing / "batch-1").mkdir(parents=True)
    write_jsonl(landing / "batch-1" / "a.json", rows_1)

    def start():
        bronze = ms.bronze_stream(ms.read_feed_stream(spark, f"{landing}/*"))
        rows = market.standardize(bronze).where(market.silver_predicate())
        return (
            rows.writeStream
            .foreachBatch(latest.upsert)
            .option("checkpointLocation", ckpt)
        )

    ms.run_available(start)
    (landing / "batch-2").mkdir()
    write_jsonl(landing / "batch-2" / "b.json", rows_2)
    ms.run_available(start)
    streamed = ms.summary_from_latest(latest.read(spark))
    both = spark.read.json([str(landing / "batch-1"), str(landing / "batch-2")], schema=ms.FEED_SCHEMA)
    batch = market.gold_summary(market.silver(both.withColumn("source_file", F.lit("x"))))
    key = lambda r: r["symbol"]
    assert sorted(streamed.collect(), key=key) == sorted(batch.collect(), key=key)
    assert streamed.count() == 8  # the union of both batches' symbols


def test_candles_ignore_data_later_than_the_watermark(spark, tmp_path):
    landing, sink, ckpt = tmp_path / "landing", str(tmp_path / "candles"), str(tmp_path / "ckpt")
    schema = "symbol string, asset_type string, price double, volume double, event_time timestamp, event_id long"
    t0 = dt.datetime(2026, 7, 1, 10, 0)

    def land(batch, rows):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(landing / f"batch-{batch}"))

    def start():
        stream = spark.readStream.schema(schema).parquet(f"{landing}/*")
        return (
            ms.candle_stream(stream, "1 hour", "1 hour").writeStream.format("parquet")
            .option("path", sink).option("checkpointLocation", ckpt).outputMode("append")
        )

    land(1, [("X", "stock", 10.0, 1.0, t0 + dt.timedelta(minutes=5), 1),
             ("X", "stock", 12.0, 1.0, t0 + dt.timedelta(minutes=50), 2),
             ("X", "stock", 11.0, 1.0, t0 + dt.timedelta(hours=3), 3)])
    ms.run_available(start)
    # a tick for the 10:00 window arrives after the watermark (13:00 - 1h) has closed it
    land(2, [("X", "stock", 99.0, 5.0, t0 + dt.timedelta(minutes=30), 4),
             ("X", "stock", 13.0, 1.0, t0 + dt.timedelta(hours=5), 5)])
    ms.run_available(start)
    out = {r["window_start"].hour: r for r in spark.read.parquet(sink).collect()}
    ten = out[10]
    assert (ten["open"], ten["high"], ten["low"], ten["close"], ten["trades"]) == (10.0, 12.0, 10.0, 12.0, 2)
    assert 13 in out  # closed by the second run's watermark (15:00 - 1h)


def test_results_do_not_depend_on_how_files_are_split(spark, tmp_path):
    from tests.conftest import SF_SMALL
    from tidemark.sources import bindings

    raw = bindings.raw_feed(spark, SF_SMALL)
    landing = str(tmp_path / "landing")
    raw.orderBy(F.xxhash64("event_id")).repartition(6, F.pmod("event_id", F.lit(6))).write.json(f"{landing}/batch-1")
    rows = ms.silver_stream(ms.bronze_stream(ms.read_feed_stream(spark, f"{landing}/*", files_per_trigger=1)))
    ticks = rows.select("symbol", "asset_type", "price", "volume", "event_time", "event_id")

    def sink(df, table, write):
        ms.run_available(
            lambda: df.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / f"{table}-ckpt"))
        )

    key = lambda r: str(r)
    batch = market.silver(raw.withColumn("source_file", F.lit("batch-1")))
    silver = ms.silver_table(str(tmp_path / "silver"), buckets=4)
    sink(rows, "silver", silver.upsert)
    assert len(list((tmp_path / "silver" / "manifest").glob("epoch=*"))) > 2
    assert sorted(silver.read(spark).select(*batch.columns).collect(), key=key) == sorted(batch.collect(), key=key)
    latest = ms.latest_table(str(tmp_path / "latest"), buckets=4)
    sink(rows, "latest", latest.upsert)
    summary = ms.summary_from_latest(latest.read(spark))
    assert sorted(summary.collect(), key=key) == sorted(market.gold_summary(batch).collect(), key=key)
    whole = market.standardize(raw).where(market.silver_predicate()).select(*ticks.columns)
    write = ms.append_epochs(str(tmp_path / "candles"))
    sink(ticks, "candles", lambda d, epoch: write(ms.partial_candles(d, "1 day"), epoch))
    candles = ms.merged_candles(ms.read_epochs(spark, str(tmp_path / "candles")))
    assert sorted(candles.collect(), key=key) == sorted(ms.merged_candles(ms.partial_candles(whole, "1 day")).collect(), key=key)


def _bucket_files(root):
    return {p.relative_to(root / "data").parts[:2] for p in (root / "data").glob("epoch=*/bucket=*/*.parquet")}


def test_a_batch_rewrites_the_buckets_it_touches_only(spark, tmp_path):
    table = BucketTable(str(tmp_path / "t"), ("k",), lambda rows: rows.groupBy("k").agg(F.max("v").alias("v")), buckets=8)
    rows = lambda *pairs: spark.createDataFrame(list(pairs), "k int, v int")
    got = lambda: {r["k"]: r["v"] for r in table.read(spark).collect()}
    table.upsert(rows(*((k, 1) for k in range(50))), 0)
    first = _bucket_files(tmp_path / "t")
    assert len(first) == 8 and got() == dict.fromkeys(range(50), 1)
    files = {p: p.stat().st_mtime_ns for p in (tmp_path / "t" / "data" / "epoch=0").glob("*/*.parquet")}
    table.upsert(rows((7, 9), (7, 3), (100, 5)), 1)
    assert len(_bucket_files(tmp_path / "t") - first) == 2 and {e for e, _ in _bucket_files(tmp_path / "t") - first} == {"epoch=1"}
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())  # nothing of the first batch was touched
    expected = {**dict.fromkeys(range(50), 1), 7: 9, 100: 5}
    assert got() == expected and table.read(spark).count() == 51  # one row a key, without a dedup on reading
    table.upsert(rows((7, 9), (7, 3), (100, 5)), 1)  # the trigger is run again
    assert got() == expected
    table.upsert(rows(), 2)
    assert got() == expected


def test_a_batch_that_fails_leaves_the_table_as_it_was(spark, tmp_path):
    broken = F.udf(lambda v: 1 // v, "int")
    plain = BucketTable(str(tmp_path / "t"), ("k",), lambda rows: rows.dropDuplicates(["k"]), buckets=4)
    plain.upsert(spark.createDataFrame([(k, 1) for k in range(9)], "k int, v int"), 0)
    failing = BucketTable(plain.path, ("k",), lambda rows: rows.withColumn("v", broken("v")), buckets=4)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        failing.upsert(spark.createDataFrame([(1, 0)], "k int, v int"), 1)
    assert {r["k"]: r["v"] for r in plain.read(spark).collect()} == dict.fromkeys(range(9), 1)
    plain.upsert(spark.createDataFrame([(20, 2)], "k int, v int"), 1)
    assert plain.read(spark).count() == 10


def test_late_rows_are_put_aside(spark, tmp_path):
    t0 = dt.datetime(2026, 7, 1, 10, 0)
    schema = "symbol string, asset_type string, price double, volume double, event_time timestamp, event_id long"
    row = lambda i, minutes: ("X", "stock", float(i), 1.0, t0 + dt.timedelta(minutes=minutes), i)
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "landing" / "*"))
    candles = ms.candle_table(str(tmp_path / "candles"), buckets=2)

    def run(batch, *rows):
        spark.createDataFrame(list(rows), schema).write.parquet(str(tmp_path / "landing" / f"batch-{batch}"))
        ms.run_available(
            lambda: ms.candle_updates(stream, "1 hour", "1 hour").writeStream.outputMode("update")
            .foreachBatch(lambda df, epoch: candles.upsert(df.withColumn("epoch", F.lit(epoch)), epoch))
            .option("checkpointLocation", str(tmp_path / "c1"))
        )
        aside = ms.keep_late(str(tmp_path / "aside"), "1 hour", "1 hour")
        ms.run_available(lambda: stream.writeStream.foreachBatch(aside).option("checkpointLocation", str(tmp_path / "c2")))
        late = {r["event_id"] for r in spark.read.parquet(str(tmp_path / "aside" / "late")).collect()}
        made = {r["window_start"].hour: (r["open"], r["close"], r["trades"]) for r in ms.merged_candles(candles.read(spark)).collect()}
        return made, late

    assert run(1, row(1, 5), row(2, 50), row(3, 130)) == ({10: (1, 2, 2), 12: (3, 3, 1)}, set())
    # the watermark is 11:10: the window of 10:00 is closed, that of 11:00 is not
    assert run(2, row(4, 30), row(5, 70), row(6, 300)) == ({10: (1, 2, 2), 11: (5, 5, 1), 12: (3, 3, 1), 15: (6, 6, 1)}, {4})
    made, late = run(3, row(7, 100), row(8, 170), row(9, 240))
    assert late == {4, 7, 8} and made[14] == (9, 9, 1) and sum(n for *_, n in made.values()) + len(late) == 9
