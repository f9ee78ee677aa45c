"""Structured Streaming versions of the market layers (ST-1..5).

Operating model: files land in a folder; a scheduled job runs the stream with
``trigger(availableNow=True)``, which processes exactly the files that
arrived since the last run (tracked in the checkpoint) and stops.  Every
checkpoint and sink lives under the shared staging root, so a lost executor
or a restarted driver resumes from the last committed batch.

* ST-1 bronze: JSONL → bronze with per-file lineage, append to a file sink
  (exactly-once through the sink's metadata log).
* ST-2 silver: a :class:`tidemark.sinks.buckets.BucketTable` of whole rows, one
  per key.  A trigger merges its rows with the stored rows of the buckets they
  fall in and gives only those buckets a new version; readers need no dedup.
* ST-3 candles: each trigger appends partial candles of its rows, the reader
  merges them, so every window is there whatever files a trigger got.  The
  watermarked form (:func:`candle_updates`) keeps open windows as state, emits
  the changed ones in update mode and gives a window up once the watermark has
  passed it; :func:`keep_late` puts the rows that come after that aside.
* ST-4 latest summary: a bucket table of the newest row per symbol; the gold
  summary is published as a new version of a catalog table.
* ST-5 replay: the batch job run per landed folder, each into a version of
  its own, so the newest version reflects the last landed batch only.  Bronze
  is partitioned by that folder, so a replay reads it alone.

Every table is written at a place of its own for each trigger, replaced as a
whole if the trigger is run again, and becomes readable with one last commit.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.plans import analytics, market
from tidemark.schemas import MARKET_SCHEMA
from tidemark.sinks.buckets import BucketTable
from tidemark.sources.landing import parse_landed, stored_schema

FEED_SCHEMA = StructType(MARKET_SCHEMA.fields + [StructField("event_id", LongType())])


def run_available(writer_factory: Callable[[], "object"], timeout_s: float | None = None) -> None:
    """Start a stream with ``availableNow`` and wait until it has drained its input."""
    query = writer_factory().trigger(availableNow=True).start()
    query.awaitTermination(timeout_s)
    if query.isActive:
        query.stop()
        raise TimeoutError("stream did not drain its input in time")
    if query.exception() is not None:
        raise query.exception()


def read_feed_stream(
    spark: SparkSession, landing: str, schema: StructType = FEED_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """ST-1 source: JSONL files of a landing folder, under an explicit schema.

    ``files_per_trigger`` only paces the stream; no result here depends on it.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.json(landing)


def read_landing_stream(spark: SparkSession, landing: str, schemas: str) -> DataFrame:
    """ST-1 source under the schema on file: bronze rows with lineage, unknown and retyped fields rescued."""
    _, schema = stored_schema(spark, schemas)
    if schema is None:
        raise FileNotFoundError(f"no schema under {schemas}")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2).alias("source_file")
    return parse_landed(spark.readStream.text(landing), schema, folder)


def append_epochs(table: str, *partition_by: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` writer: one folder per trigger, replaced whole if the trigger is retried."""

    def write(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{table}/epoch={epoch}")

    return write


def read_epochs(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.parquet(table).drop("epoch")


def bronze_stream(raw: DataFrame) -> DataFrame:
    """Bronze rows with per-file lineage: the batch folder of each file."""
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return raw.withColumn("source_file", folder)


def silver_stream(bronze: DataFrame) -> DataFrame:
    """ST-2: the stateless half of silver, standardise + filter."""
    return market.standardize(bronze).where(market.silver_predicate())


def silver_table(path: str, buckets: int = 32) -> BucketTable:
    """ST-2: whole silver rows, one per key, with the batch layer's survivor."""
    return BucketTable(path, market.DEDUP_KEYS, market.dedup_keys, buckets)


def latest_table(path: str, buckets: int = 32) -> BucketTable:
    """ST-4: the newest silver row of every symbol."""
    return BucketTable(path, ("symbol",), latest_state, buckets)


def partial_candles(ticks: DataFrame, width: str) -> DataFrame:
    """ST-3: what a set of ticks adds to each candle: ends with their place in the order, and sums."""
    first, last = F.struct("event_time", "event_id", "price"), F.struct("event_time", "event_id", "price")
    return ticks.groupBy("symbol", "asset_type", F.window("event_time", width).alias("w")).agg(
        F.min(first).alias("first"),
        F.max(last).alias("last"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.sum("volume").alias("volume"),
        F.count("*").alias("trades"),
    )


def merged_candles(partials: DataFrame) -> DataFrame:
    """ST-3: candles from the partial ones of all triggers."""
    merged = partials.groupBy("symbol", "asset_type", "w").agg(
        F.min("first").alias("first"),
        F.max("last").alias("last"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.round(F.sum("volume"), 4).alias("volume"),
        F.sum("trades").alias("trades"),
    )
    return merged.select(
        "symbol",
        "asset_type",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        F.col("first.price").alias("open"),
        "high",
        "low",
        F.col("last.price").alias("close"),
        "volume",
        "trades",
    )


def candle_updates(ticks: DataFrame, width: str, delay: str) -> DataFrame:
    """ST-3: partial candles of the windows that the watermark has not passed, for update mode.

    State holds the open windows only.  A tick whose window ended before the
    watermark (the greatest event time of earlier triggers less ``delay``)
    changes nothing any more.
    """
    return partial_candles(ticks.withWatermark("event_time", delay), width)


def newest_update(rows: DataFrame) -> DataFrame:
    """Of several updates of one window, the one of the last trigger."""
    kept = [c for c in rows.columns if c != "epoch"]
    newest = rows.groupBy("symbol", "asset_type", "w").agg(F.max_by(F.struct(*rows.columns), "epoch").alias("r"))
    return newest.select(*[F.col(f"r.{c}").alias(c) for c in kept], F.col("r.epoch").alias("epoch"))


def candle_table(path: str, buckets: int = 32) -> BucketTable:
    """ST-3: the last update of every window."""
    return BucketTable(path, ("symbol", "asset_type", "w"), newest_update, buckets)


def keep_late(table: str, width: str, delay: str) -> Callable[[DataFrame, int], None]:
    """ST-3: a ``foreachBatch`` writer that appends the rows beyond the watermark to ``table/late``.

    Each trigger notes its greatest event time; the watermark of a trigger
    comes from the notes of the triggers before it, as the engine's does, so
    both agree where both streams take the same files in a trigger.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        note = batch.agg(F.max("event_time").alias("reached"))
        if epoch:
            before = spark.read.parquet(f"{table}/reached").where(F.col("epoch") < epoch)
            mark = F.date_trunc("millisecond", F.max("reached")) - F.expr(f"INTERVAL {delay}")
            reached = before.agg(mark.alias("mark")).first()["mark"]
        else:
            reached = None
            spark.createDataFrame([], batch.schema).write.mode("overwrite").parquet(f"{table}/late/epoch=-1")
        if reached is not None:
            late = batch.where(F.window("event_time", width)["end"] <= F.lit(reached))
            late.write.mode("overwrite").parquet(f"{table}/late/epoch={epoch}")
        note.coalesce(1).write.mode("overwrite").parquet(f"{table}/reached/epoch={epoch}")

    return write


def candle_stream(ticks: DataFrame, width: str, watermark: str) -> DataFrame:
    """ST-3: tumbling OHLCV candles closed by the watermark."""
    return analytics.candles(ticks.withWatermark("event_time", watermark), width)


def latest_state(silver_rows: DataFrame) -> DataFrame:
    """ST-4: one row per symbol, chosen by the batch layer's total order.

    The batch layer keeps the lowest event_id per (batch_id, symbol,
    event_time) and then the newest (event_time, batch_id); that row is the
    max of ``(event_time, batch_id, -event_id)``.  The choice may be made in
    parts: the newest of the triggers' newest rows is the newest of all.
    """
    order = F.struct("event_time", "batch_id", (-F.col("event_id")).alias("neg_id"))
    agg = silver_rows.groupBy("symbol").agg(F.max_by(F.struct(*silver_rows.columns), order).alias("r"))
    return agg.select("r.*")


def summary_from_latest(latest: DataFrame) -> DataFrame:
    """Gold summary columns from latest rows (same projection as the batch layer)."""
    return market.gold_summary(latest)
