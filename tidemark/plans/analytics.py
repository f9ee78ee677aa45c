"""Market analytics the reference specifies but does not implement (AGG-10, WIN-3..9).

The formulas are ours (the reference names these outputs only); they are
stated in each docstring and in the README.  Input is a tick table with
``symbol, asset_type, price, volume, event_time, event_id``.

Scale notes
-----------
* Candles, high/low, performance and volatility are grouped aggregates:
  partial aggregation on every map task, so a hot symbol is reduced before
  the shuffle.
* Price change, volatility returns and anomalies need the previous row(s)
  of a symbol; they use :func:`tidemark.operators.series.rows_window`,
  which partitions by (symbol, day) plus an exact halo of the preceding
  rows instead of putting a whole symbol in one task.
* Top movers need only the two newest ticks per symbol: a ``row_number <= 2``
  filter that Catalyst limits per map task before the shuffle.
* The 7-day moving average runs over one row per symbol-day (bounded by the
  calendar, not by the tick count).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import rows_window

ORDER = ("event_time", "event_id")
ANOMALY_LOOKBACK = 20
ANOMALY_MIN_POINTS = 5
ANOMALY_Z = 3.0
MOVERS_K = 5
TREND_DAYS = 7


def _by_time() -> "F.Column":
    """The order (event_time, event_id), NULLs first, as one number of fixed width.

    A struct is no fixed-width aggregation buffer, so ``min_by`` over one plans
    as a sort aggregate; over a decimal it stays a hash aggregate.  38 digits
    hold the microseconds of any timestamp above the 20 digits of an id.
    """
    number = lambda n: F.lit(str(n)).cast("decimal(21,0)")
    micros = F.coalesce(F.unix_micros("event_time"), F.lit(-(10**17) * 9)).cast("decimal(18,0)")
    place = F.coalesce(F.col("event_id").cast("decimal(20,0)") + number(2**63 + 1), number(0))
    return micros * number(10**20) + place


def candles(ticks: DataFrame, width: str = "1 day") -> DataFrame:
    """AGG-10: OHLCV per symbol, asset type and tumbling window.

    open/close = price of the first/last tick (event_time, event_id order),
    high/low = max/min price, volume = sum rounded to 4 places, trades = count.
    """
    w = F.window("event_time", width)
    agg = ticks.groupBy(w.alias("w"), "symbol", "asset_type").agg(
        F.min_by("price", _by_time()).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", _by_time()).alias("close"),
        F.round(F.sum("volume"), 4).alias("volume"),
        F.count(F.lit(1)).alias("trades"),
    )
    return agg.select(
        "symbol",
        "asset_type",
        F.col("w.start").alias("window_start"),
        F.col("w.end").alias("window_end"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "trades",
    )


def with_previous_price(ticks: DataFrame) -> DataFrame:
    """``previous_price`` = the symbol's preceding tick price (exact, skew-split by day)."""
    return rows_window(
        ticks,
        "symbol",
        ORDER,
        1,
        {"previous_price": lambda spec: F.lag("price", 1).over(spec)},
    )


def price_change(ticks: DataFrame) -> DataFrame:
    """WIN-3: previous price, change and change % per tick (first tick of a symbol → NULLs)."""
    prev = with_previous_price(ticks)
    change = F.col("price") - F.col("previous_price")
    return prev.select(
        "symbol",
        "asset_type",
        "event_time",
        "event_id",
        "price",
        "previous_price",
        F.round(change, 4).alias("price_change"),
        F.round(F.try_divide(change, F.col("previous_price")) * 100, 4).alias("price_change_percent"),
    )


def high_low(ticks: DataFrame) -> DataFrame:
    """WIN-4: true high and low over each symbol's whole history."""
    return ticks.groupBy("symbol", "asset_type").agg(
        F.max("price").alias("high"), F.min("price").alias("low"), F.count(F.lit(1)).alias("ticks")
    )


def top_movers(ticks: DataFrame, k: int = MOVERS_K) -> DataFrame:
    """WIN-5: per asset type, the k symbols with the largest |change %| on their latest tick.

    Latest tick = newest (event_time, event_id); symbols with one tick are
    skipped; ties by symbol.  A symbol belongs to the type of its newest tick.
    """
    newest = Window.partitionBy("symbol").orderBy(F.col("event_time").desc(), F.col("event_id").desc())
    two = ticks.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= 2)
    pair = two.groupBy("symbol").agg(
        F.max(F.when(F.col("_rn") == 1, F.col("asset_type"))).alias("asset_type"),
        F.max(F.when(F.col("_rn") == 1, F.col("price"))).alias("latest_price"),
        F.max(F.when(F.col("_rn") == 2, F.col("price"))).alias("previous_price"),
        F.max(F.when(F.col("_rn") == 1, F.col("event_time"))).alias("event_time"),
    )
    moved = pair.where(F.col("previous_price").isNotNull()).withColumn(
        "price_change_percent",
        F.round(F.try_divide(F.col("latest_price") - F.col("previous_price"), F.col("previous_price")) * 100, 4),
    )
    rank_w = Window.partitionBy("asset_type").orderBy(F.abs("price_change_percent").desc(), F.col("symbol"))
    return moved.withColumn("rank", F.row_number().over(rank_w)).where(F.col("rank") <= k)


def summary_full(ticks: DataFrame) -> DataFrame:
    """Gold summary with its change fields: newest and second newest tick, true high and low per symbol."""
    newest = Window.partitionBy("symbol").orderBy(F.col("event_time").desc(), F.col("event_id").desc())
    two = ticks.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= 2)
    at = lambda rank, column: F.max(F.when(F.col("_rn") == rank, F.col(column)))
    pair = two.groupBy("symbol").agg(
        at(1, "asset_type").alias("asset_type"),
        at(1, "price").alias("latest_price"),
        at(2, "price").alias("previous_price"),
        at(1, "volume").alias("volume"),
        at(1, "event_time").alias("last_updated"),
    )
    span = ticks.groupBy("symbol").agg(F.max("price").alias("high"), F.min("price").alias("low"))
    change = F.col("latest_price") - F.col("previous_price")
    return pair.join(span, "symbol").select(
        "symbol",
        "asset_type",
        "latest_price",
        "previous_price",
        F.round(change, 4).alias("price_change"),
        F.round(F.try_divide(change, F.col("previous_price")) * 100, 4).alias("price_change_percent"),
        "volume",
        "high",
        "low",
        "last_updated",
    )


def volatility(ticks: DataFrame) -> DataFrame:
    """WIN-6: per symbol, count and sample stddev (4 places) of tick returns ``price/prev - 1``."""
    r = F.try_divide(F.col("price"), F.col("previous_price")) - 1
    return (
        with_previous_price(ticks)
        .select("symbol", "asset_type", r.alias("r"))
        .groupBy("symbol", "asset_type")
        .agg(F.count("r").alias("returns"), F.round(F.stddev_samp("r"), 4).alias("volatility"))
    )


def rolling_volatility(ticks: DataFrame, points: int = 10) -> DataFrame:
    """WIN-6 (rolling): stddev of the last ``points`` returns at every tick.

    Two stacked windows over one partitioning: the return needs the previous
    price (1 row back) and the deviation the previous ``points - 1`` returns,
    so one halo of ``points`` rows serves both.
    """
    out = rows_window(
        ticks,
        "symbol",
        ORDER,
        points,
        [
            {"r": lambda spec: F.try_divide(F.col("price"), F.lag("price", 1).over(spec)) - 1},
            {"rolling_volatility": lambda spec: F.round(F.stddev_samp("r").over(spec.rowsBetween(-(points - 1), 0)), 4)},
        ],
    )
    return out.select("symbol", "asset_type", "event_time", "event_id", "price", "r", "rolling_volatility")


def symbol_performance(ticks: DataFrame) -> DataFrame:
    """WIN-7: first and last price per symbol and the return between them, in %."""
    agg = ticks.groupBy("symbol", "asset_type").agg(
        F.min_by("price", _by_time()).alias("first_price"),
        F.max_by("price", _by_time()).alias("last_price"),
    )
    return agg.withColumn(
        "return_percent", F.round((F.try_divide(F.col("last_price"), F.col("first_price")) - 1) * 100, 4)
    )


def anomalies(ticks: DataFrame, lookback: int = ANOMALY_LOOKBACK, z: float = ANOMALY_Z) -> DataFrame:
    """WIN-8: ticks whose price is more than ``z`` sample deviations from the mean of the
    previous ``lookback`` ticks of the symbol (at least 5 of them, deviation > 0)."""
    frame = lambda spec: spec.rowsBetween(-lookback, -1)
    stats = rows_window(
        ticks,
        "symbol",
        ORDER,
        lookback,
        {
            "_m": lambda spec: F.avg("price").over(frame(spec)),
            "_s": lambda spec: F.stddev_samp("price").over(frame(spec)),
            "_n": lambda spec: F.count("price").over(frame(spec)),
        },
    )
    score = (F.col("price") - F.col("_m")) / F.col("_s")
    return stats.where((F.col("_n") >= ANOMALY_MIN_POINTS) & (F.col("_s") > 0) & (F.abs(score) > z)).select(
        "symbol",
        "asset_type",
        "event_time",
        "event_id",
        "price",
        F.round(score, 4).alias("z_score"),
    )


def trend_ma(ticks: DataFrame, days: int = TREND_DAYS) -> DataFrame:
    """WIN-9: daily close per symbol and its ``days``-day moving average (4 places)."""
    daily = ticks.groupBy("symbol", "asset_type", F.to_date("event_time").alias("day")).agg(
        F.max_by("price", _by_time()).alias("close")
    )
    w = Window.partitionBy("symbol").orderBy("day").rowsBetween(-(days - 1), 0)
    return daily.withColumn("moving_average", F.round(F.avg("close").over(w), 4))
