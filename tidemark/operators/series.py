"""Per-key ordered series without one task per key.

``lag`` and ``rowsBetween(-n, -1)`` frames over a symbol's whole history need
``Window.partitionBy(symbol)``: every row of a symbol goes to one task, so a
symbol holding a third of all ticks becomes one third of the job in a single
task.  :func:`rows_window` computes the *same* frames over finer partitions
``(key, bucket)`` and restores exactness at bucket boundaries with a small
**halo**: the ``n`` rows that precede each bucket in key order, copied from
earlier buckets and dropped after the window.

A bucket is a UTC day of a key.  Where a key's day is hot, its rows are cut at
exact quantiles of the window's own order (:func:`quantile_buckets`): they are
range-partitioned on it and numbered, and every ``target_rows`` of them are a
bucket.  Rows of one instant are therefore cut by the columns that break its
tie, however many share it, and no bucket of a hot day is larger than
``target_rows``.  Only hot rows are sorted and written; the rows of all other
days keep the day they have and are not touched before the window.

How the halo is found (all distributed, all bounded by n per bucket):

1. per ``(key, bucket)`` row counts, accumulated per key: one row per
   key-bucket, so this table is small.  It is counted once, and a hot day's
   part follows from its size.  Each bucket lists its next ``n`` buckets (a
   bounded ``collect_list`` frame) with the number of rows lying between them;
2. halo candidates: the last ``n`` rows of every bucket (a ``row_number``
   filter, limited per map task before the shuffle);
3. one join of candidates to their target buckets, keeping a candidate where
   fewer than ``n`` rows lie between it and the target's start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.lineage import materialize
from tidemark.operators.ranking import with_rank

HALO = "_halo"
BUCKET = "_bucket"
DAY_US = 86_400_000_000
NO_TIME = -1_000_000  # day of rows without a time, which a window orders first
PARTS = 1 << 40  # a bucket's number is its day times PARTS plus its part of the day
DEFAULT_TARGET_ROWS = 2_000_000


def day_buckets(df: DataFrame, time_col: str) -> DataFrame:
    """``df`` with ``_bucket``, part 0 of the UTC day of ``time_col``."""
    us = F.unix_micros(F.col(time_col).cast("timestamp"))
    day = F.coalesce(F.floor(us / DAY_US), F.lit(NO_TIME))
    return df.withColumn(BUCKET, (day * F.lit(PARTS)).cast("long"))


def bucket_sizes(days: DataFrame, key: str) -> DataFrame:
    """Rows of every (key, day), written once: a row per key and day, whatever the days hold."""
    return materialize(days.groupBy(key, BUCKET).agg(F.count(F.lit(1)).alias("_c")), "series-sizes")


def quantile_buckets(days: DataFrame, sizes: DataFrame, key: str, order: Sequence[str], target_rows: int) -> tuple[DataFrame, DataFrame]:
    """Rows and sizes with every hot (key, day) cut at exact quantiles of ``order``.

    ``sizes`` lists the hot days (at most ``total / target_rows`` of them);
    only their rows are range-partitioned, numbered and written.
    """
    hot = sizes.where(F.col("_c") > target_rows).select(F.col(key).alias("_hot_key"), F.col(BUCKET).alias("_hot_day"), "_c")
    if hot.isEmpty():
        return days, sizes
    is_hot = days[key].eqNullSafe(hot["_hot_key"]) & (days[BUCKET] == hot["_hot_day"])
    cold = days.join(hot, is_hot, "left_anti")
    ranked = with_rank(days.join(hot, is_hot, "left_semi"), F.col(key), F.col(BUCKET), *order, name="_seat")
    first = ranked.groupBy(key, BUCKET).agg(F.min("_seat").alias("_first"))
    first = first.select(F.col(key).alias("_hot_key"), F.col(BUCKET).alias("_hot_day"), "_first")
    placed = ranked.join(first, ranked[key].eqNullSafe(first["_hot_key"]) & (ranked[BUCKET] == first["_hot_day"]))
    part = F.floor((F.col("_seat") - F.col("_first")) / target_rows)
    cut = placed.withColumn(BUCKET, (F.col(BUCKET) + part).cast("long")).select(*days.columns)
    # a hot day's parts hold target_rows each, the last one what is left
    n_parts = F.ceil(F.col("_c") / target_rows)
    parts = hot.select("_hot_key", "_hot_day", "_c", F.explode(F.sequence(F.lit(0).cast("long"), n_parts - 1)).alias("_p"))
    size = F.least(F.lit(target_rows).cast("long"), F.col("_c") - F.col("_p") * target_rows)
    parts = parts.select(F.col("_hot_key").alias(key), (F.col("_hot_day") + F.col("_p")).alias(BUCKET), size.alias("_c"))
    return cold.unionByName(cut), sizes.where(F.col("_c") <= target_rows).unionByName(parts)


def with_halo(rows_in: DataFrame, sizes: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """``rows_in`` (with ``_bucket`` and its ``sizes``) plus, for every (key, bucket), copies of the ``n`` rows before it.

    Real rows carry ``_halo = false``; copies carry ``_halo = true`` and the
    bucket they were copied *into*.
    """
    rows = rows_in.withColumn(HALO, F.lit(False))
    # (1) one row per key-bucket: its row count and the running count through it
    by_key = Window.partitionBy(key).orderBy(BUCKET)
    running = F.sum("_c").over(by_key.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    buckets = sizes.withColumn("_cum", running)
    # each bucket lists its next n buckets with the rows lying before their start;
    # `gap` = rows strictly between this bucket's end and the target's start
    following = F.collect_list(F.struct(F.col(BUCKET).alias("b"), (F.col("_cum") - F.col("_c")).alias("before"))).over(
        by_key.rowsBetween(1, n)
    )
    targets = (
        buckets.select(key, F.col(BUCKET).alias("_src"), "_cum", following.alias("_next"))
        .select(key, "_src", F.inline(F.transform("_next", lambda t: F.struct(
            t["b"].alias("_dst"), (t["before"] - F.col("_cum")).alias("_gap")))))
        .where(F.col("_gap") < n)
    )
    # (2) halo candidates: the last n rows of every bucket (limited per map task before the shuffle)
    last_first = Window.partitionBy(key, BUCKET).orderBy(*[F.col(c).desc() for c in order])
    cand = rows.withColumn("_r", F.row_number().over(last_first)).where(F.col("_r") <= n)
    # (3) a candidate reaches a target bucket when fewer than n rows separate them
    halo = (
        cand.join(targets, cand[key].eqNullSafe(targets[key]) & (cand[BUCKET] == targets["_src"]))
        .where(F.col("_r") + F.col("_gap") <= n)
        .select(*[cand[c] for c in rows.columns if c not in (BUCKET, HALO)], F.col("_dst").alias(BUCKET), F.lit(True).alias(HALO))
        .select(*rows.columns)
    )
    return rows.unionByName(halo)


def rows_window(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    n: int,
    columns: dict[str, "callable"] | Sequence[dict[str, "callable"]],
    target_rows: int = DEFAULT_TARGET_ROWS,
) -> DataFrame:
    """Add window columns whose frame reaches at most ``n`` rows back, exactly, per key.

    ``columns`` maps an output name to ``f(window_spec) -> Column`` where the
    spec is partitioned by ``(key, bucket)`` and ordered by ``order``.  A list
    of such maps is applied in stages over the same partitioning (no extra
    shuffle), each stage seeing the previous stages' columns; ``n`` must then
    cover the *total* look-back of the stages (e.g. a lag of 1 feeding a
    10-row frame needs ``n = 10``).  ``order[0]`` must be the time column whose
    days the buckets are.
    """
    stages = [columns] if isinstance(columns, dict) else list(columns)
    days = day_buckets(df, order[0])
    bucketed, sizes = quantile_buckets(days, bucket_sizes(days, key), key, order, target_rows)
    wide = with_halo(bucketed, sizes, key, order, n)
    spec = Window.partitionBy(key, BUCKET).orderBy(*order)
    for stage in stages:
        wide = wide.select("*", *[f(spec).alias(name) for name, f in stage.items()])
    return wide.where(~F.col(HALO)).drop(HALO, BUCKET)
