"""Streaming queries (ST-1..5).

Each query lands the driver-derived feed in two time-ordered batches (the
first and second half of the data's own day range) and runs the stream once
per landed batch with ``availableNow`` on one checkpoint, as a scheduled
incremental job would.
The result is what the stream's sink holds afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import market
from tidemark.registry import query
from tidemark.registry.sql import (
    BRONZE,
    LATEST,
    RAW_FEED,
    SILVER,
    STD,
    SUMMARY,
    TICKS,
    VALID,
    with_ctes,
)
from tidemark.session import staging_path
from tidemark.sinks import writers
from tidemark.sources import bindings
from tidemark.sources.landing import save_schema
from tidemark.streaming import market_stream as ms

def _midpoint(spark: SparkSession, df: DataFrame, day: "F.Column") -> "F.Column":
    """Rows whose day falls in the first half of the data's own day range (time-ordered split)."""
    lo, hi = df.agg(F.min(day), F.max(day)).first()
    return F.datediff(day, F.lit(lo)) <= (hi - lo).days // 2 if lo else F.lit(True)


def _feed_day() -> "F.Column":
    return F.to_date(F.substring("ingestion_time", 1, 10))


def _land(df: DataFrame, day: "F.Column", landing: str, run, kind: str = "json") -> None:
    """Land the two halves of ``df`` and run the stream after each."""
    first = _midpoint(df.sparkSession, df, day)
    for batch, rows in ((1, first), (2, ~first)):
        df.where(rows).write.mode("overwrite").format(kind).save(f"{landing}/batch-{batch}")
        run()


def _land_slices(df: DataFrame, day: "F.Column", landing: str, slices: int, run) -> None:
    """Land ``df`` in equal slices of its own day range, the rows of a slice as one batch, and run after each."""
    lo, hi = df.agg(F.min(day), F.max(day)).first()
    if lo is None:
        return
    span = (hi - lo).days + 1
    which = F.floor(F.datediff(day, F.lit(lo)) * slices / span)
    for k in range(slices):
        df.where(which == k).write.mode("overwrite").parquet(f"{landing}/batch-{k + 1}")
        run()


def _drain(stream: DataFrame, write, checkpoint: str):
    return lambda: ms.run_available(
        lambda: stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    )


def _first_half_sql(day: str, source: str) -> str:
    """DuckDB restatement of :func:`_first_half` (days are the same UTC calendar days)."""
    return (
        f"datediff('day', (SELECT min({day}) FROM {source}), {day}) <= "
        f"(datediff('day', (SELECT min({day}) FROM {source}), (SELECT max({day}) FROM {source})) // 2)"
    )


FEED_DAY = "CAST(substr(ingestion_time, 1, 10) AS DATE)"


@query(
    "stream_bronze_append",
    with_ctes(
        RAW_FEED,
        select=f"SELECT *, CASE WHEN {_first_half_sql(FEED_DAY, 'raw_feed')} THEN 'batch-1' "
        "ELSE 'batch-2' END AS source_file FROM raw_feed",
    ),
)
def stream_bronze_append(spark, sf_dir):
    """ST-1: incremental JSONL landing → bronze file sink, per-file lineage, two runs."""
    root = staging_path(spark, "stream_bronze")
    landing, sink = f"{root}/landing", f"{root}/bronze"

    def start():
        raw = ms.read_feed_stream(spark, f"{landing}/*")
        return (
            ms.bronze_stream(raw)
            .writeStream.format("parquet")
            .option("path", sink)
            .option("checkpointLocation", f"{root}/_checkpoint")
            .outputMode("append")
        )

    _land(bindings.raw_feed(spark, sf_dir), _feed_day(), landing, lambda: ms.run_available(start))
    return spark.read.parquet(sink)


CUT = 24  # characters left of a line that was cut off


def _changed_lines(rows: DataFrame, changed: "F.Column") -> DataFrame:
    """The feed as JSON lines; in the ``changed`` rows some have another field, an id as text, or are cut off."""
    fields = [c for c in rows.columns if c != "event_id"]
    venue = F.when(changed & (F.col("event_id") % 5 == 0), F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string")))
    line = lambda event_id: F.to_json(F.struct(*fields, event_id.alias("event_id"), venue.alias("venue")))
    text = F.when(changed & (F.col("event_id") % 17 == 0), line(F.concat(F.lit("id-"), F.col("event_id").cast("string"))))
    text = F.coalesce(text, line(F.col("event_id")))
    cut = changed & (F.col("event_id") % 331 == 0)
    return rows.select(F.when(cut, F.left(text, F.lit(CUT))).otherwise(text).alias("value"), "ingestion_time")


_SECOND = f"NOT ({_first_half_sql(FEED_DAY, 'raw_feed')})"
_BROKEN = "second AND event_id % 331 = 0"


@query(
    "stream_rescued_fields",
    with_ctes(
        RAW_FEED,
        f"""marked AS (SELECT *, {_SECOND} AS second FROM raw_feed),
flagged AS (SELECT *, {_BROKEN} AS broken, second AND event_id % 17 = 0 AS retyped, second AND event_id % 5 = 0 AS added FROM marked)""",
        select="SELECT "
        + ", ".join(
            f"CASE WHEN NOT broken THEN {c} END AS {c}"
            for c in ("source", "asset_type", "symbol", "price", "volume", "event_time", "ingestion_time", "batch_id")
        )
        + f""", CASE WHEN NOT broken AND NOT retyped THEN event_id END AS event_id,
  CASE WHEN broken THEN left('{{"source":"' || source || '","asset_type":"' || asset_type || '"', {CUT})
    WHEN retyped AND added THEN '{{"event_id":"id-' || event_id || '","venue":"v' || (event_id % 3) || '"}}'
    WHEN retyped THEN '{{"event_id":"id-' || event_id || '"}}'
    WHEN added THEN '{{"venue":"v' || (event_id % 3) || '"}}' END AS _rescued,
  CASE WHEN second THEN 'batch-2' ELSE 'batch-1' END AS source_file FROM flagged""",
    ),
)
def stream_rescued_fields(spark, sf_dir):
    """SRC-11: lines landed under the schema on file; the second batch has fields that it does not know."""
    root = staging_path(spark, "stream_rescue")
    save_schema(spark, ms.FEED_SCHEMA, f"{root}/schemas")
    rows = bindings.raw_feed(spark, sf_dir)
    first = _midpoint(spark, rows, _feed_day())
    for batch, lines in ((1, _changed_lines(rows.where(first), F.lit(False))), (2, _changed_lines(rows.where(~first), F.lit(True)))):
        lines.select("value").write.text(f"{root}/landing/batch-{batch}")
        stream = ms.read_landing_stream(spark, f"{root}/landing/*", f"{root}/schemas")
        _drain(stream, ms.append_epochs(f"{root}/bronze"), f"{root}/_checkpoint")()
    return ms.read_epochs(spark, f"{root}/bronze")


BATCH_OF_ROW = f"CASE WHEN {_first_half_sql(FEED_DAY, 'raw_feed')} THEN 'batch-1' ELSE 'batch-2' END"
LANDED = f"""bronze AS (
  SELECT source, asset_type, symbol, price, volume, event_time, ingestion_time, batch_id,
         {BATCH_OF_ROW} AS source_file, event_id
  FROM raw_feed)"""


@query("stream_silver_dedup", with_ctes(RAW_FEED, LANDED, STD, VALID, SILVER, select="SELECT * FROM silver"))
def stream_silver_dedup(spark, sf_dir):
    """ST-2: streaming silver kept up in buckets of the key; a trigger rewrites the buckets it touches only."""
    root = staging_path(spark, "stream_silver")
    rows = ms.silver_stream(ms.bronze_stream(ms.read_feed_stream(spark, f"{root}/landing/*")))
    table = ms.silver_table(f"{root}/silver")
    run = _drain(rows, table.upsert, f"{root}/_checkpoint")
    _land(bindings.raw_feed(spark, sf_dir), _feed_day(), f"{root}/landing", run)
    return table.read(spark)


@query(
    "stream_candles",
    with_ctes(
        TICKS,
        select="""SELECT symbol, asset_type, date_trunc('hour', event_time) AS window_start,
         date_trunc('hour', event_time) + INTERVAL 1 hour AS window_end,
         arg_min(price, (event_time, event_id)) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, (event_time, event_id)) AS close, round(sum(volume), 4) AS volume,
         CAST(count(*) AS BIGINT) AS trades
  FROM ticks GROUP BY symbol, asset_type, date_trunc('hour', event_time)""",
    ),
)
def stream_candles(spark, sf_dir):
    """ST-3: hourly candles; each trigger adds partial ones, every window is delivered."""
    root = staging_path(spark, "stream_candles")
    ticks = bindings.ticks(spark, sf_dir)
    stream = spark.readStream.schema(ticks.schema).parquet(f"{root}/landing/*")
    write = ms.append_epochs(f"{root}/partials")
    run = _drain(stream, lambda df, epoch: write(ms.partial_candles(df, "1 hour"), epoch), f"{root}/_checkpoint")
    _land(ticks, F.to_date("event_time"), f"{root}/landing", run, kind="parquet")
    return ms.merged_candles(ms.read_epochs(spark, f"{root}/partials"))


#: Landing batches, and how far behind the greatest event time a window stays open.
LANDINGS, LATE_AFTER = 3, "3 days"
_LANDED = f"""landed AS (
  SELECT *, event_time + CASE WHEN event_id % 13 = 0 THEN INTERVAL 12 DAY WHEN event_id % 7 = 0 THEN INTERVAL 1 HOUR
    ELSE INTERVAL 0 HOUR END AS landing_time, date_trunc('hour', event_time) AS w FROM ticks),
span AS (SELECT min(CAST(landing_time AS DATE)) AS d0, max(CAST(landing_time AS DATE)) AS d1 FROM landed),
dealt AS (
  SELECT landed.*, (datediff('day', d0, CAST(landing_time AS DATE)) * {LANDINGS}) // (datediff('day', d0, d1) + 1) AS batch
  FROM landed, span),
marks AS (
  SELECT b.batch, date_trunc('millisecond', max(e.event_time)) - INTERVAL {LATE_AFTER} AS mark
  FROM (SELECT DISTINCT batch FROM dealt) b JOIN dealt e ON e.batch < b.batch GROUP BY b.batch),
judged AS (
  SELECT dealt.*, mark IS NOT NULL AND w + INTERVAL 1 hour <= mark AS late FROM dealt LEFT JOIN marks USING (batch))"""


@query(
    "stream_candles_watermark",
    with_ctes(
        TICKS,
        _LANDED,
        select="""SELECT symbol, asset_type, w AS window_start,
         arg_min(price, (event_time, event_id)) FILTER (NOT late) AS open, max(price) FILTER (NOT late) AS high,
         min(price) FILTER (NOT late) AS low, arg_max(price, (event_time, event_id)) FILTER (NOT late) AS close,
         round(sum(volume) FILTER (NOT late), 4) AS volume, CAST(count(*) FILTER (NOT late) AS BIGINT) AS trades,
         CAST(count(*) FILTER (late) AS BIGINT) AS late_rows
  FROM judged GROUP BY symbol, asset_type, w""",
    ),
)
def stream_candles_watermark(spark, sf_dir):
    """ST-3: hourly candles as event-time state in update mode, under a watermark; rows beyond it are put aside.

    Ticks land in three batches by landing time.  One stream keeps the open
    windows as state and upserts the changed candles; the other writes the
    rows whose window the watermark had passed.  A window has its candle
    (NULL if all its rows were late) and the number of its late rows.
    """
    root = staging_path(spark, "stream_watermark")
    rows = bindings.landed_ticks(spark, sf_dir)
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/landing/*")
    candles = ms.candle_table(f"{root}/candles")
    updates = ms.candle_updates(stream, "1 hour", LATE_AFTER)

    def keep_up() -> None:
        ms.run_available(
            lambda: updates.writeStream.outputMode("update")
            .foreachBatch(lambda df, epoch: candles.upsert(df.withColumn("epoch", F.lit(epoch)), epoch))
            .option("checkpointLocation", f"{root}/_candles")
        )
        _drain(stream, ms.keep_late(f"{root}/aside", "1 hour", LATE_AFTER), f"{root}/_aside")()

    _land_slices(rows, F.to_date("landing_time"), f"{root}/landing", LANDINGS, keep_up)
    late = spark.read.parquet(f"{root}/aside/late")
    late = late.groupBy("symbol", "asset_type", F.window("event_time", "1 hour")["start"].alias("window_start"))
    late = late.agg(F.count("*").alias("late_rows"))
    made = ms.merged_candles(candles.read(spark)).drop("window_end")
    both = made.join(late, ["symbol", "asset_type", "window_start"], "full")
    none = F.lit(0).cast("long")
    return both.withColumns({"late_rows": F.coalesce("late_rows", none), "trades": F.coalesce("trades", none)})


@query("stream_latest_summary", with_ctes(RAW_FEED, BRONZE, STD, VALID, SILVER, LATEST, SUMMARY, select="SELECT * FROM summary"))
def stream_latest_summary(spark, sf_dir):
    """ST-4: newest row per symbol kept up in buckets; each run publishes the summary as a new version of its table."""
    root = staging_path(spark, "stream_latest")
    rows = ms.silver_stream(ms.bronze_stream(ms.read_feed_stream(spark, f"{root}/landing/*")))
    latest, name = ms.latest_table(f"{root}/latest"), writers.staging_table(spark, "gold_market_summary")
    drain = _drain(rows, latest.upsert, f"{root}/_checkpoint")

    def run() -> None:
        drain()
        writers.publish_version(ms.summary_from_latest(latest.read(spark)), name, f"{root}/summary")

    _land(bindings.raw_feed(spark, sf_dir), _feed_day(), f"{root}/landing", run)
    return spark.table(name)


SECOND_HALF_FEED = RAW_FEED.replace("raw_feed AS (", "raw_feed_all AS (", 1) + (
    f",\nraw_feed AS (SELECT * FROM raw_feed_all WHERE NOT ({_first_half_sql(FEED_DAY, 'raw_feed_all')}))"
)


@query(
    "stream_two_batch_replay",
    with_ctes(SECOND_HALF_FEED, BRONZE, STD, VALID, SILVER, LATEST, SUMMARY, select="SELECT * FROM summary"),
)
def stream_two_batch_replay(spark, sf_dir):
    """ST-5: the batch job run once per landed batch, each into a version of its own.

    As in the reference, a run replaces the gold table: after two batches the
    newest version reflects the second batch only.  Bronze is partitioned by
    the landed folder, so the job reads its own batch alone, however many
    triggers brought its files.
    """
    root = staging_path(spark, "stream_replay")
    bronze = ms.bronze_stream(ms.read_feed_stream(spark, f"{root}/landing/*"))
    drain = _drain(bronze, ms.append_epochs(f"{root}/bronze", "source_file"), f"{root}/_checkpoint")
    versions: list[str] = []

    def run() -> None:
        drain()
        batch = f"batch-{len(versions) + 1}"
        rows = ms.read_epochs(spark, f"{root}/bronze").where(F.col("source_file") == batch)
        market.gold_summary(market.silver(rows)).write.mode("overwrite").parquet(f"{root}/gold/{batch}")
        versions.append(f"{root}/gold/{batch}")

    _land(bindings.raw_feed(spark, sf_dir), _feed_day(), f"{root}/landing", run)
    return spark.read.parquet(versions[-1])
