"""Exact global ranks without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.lineage import materialize

#: ``monotonically_increasing_id`` holds the partition above these bits and the row's place below them.
PLACE_BITS = 33


def with_rank(rows: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """``rows`` with their 0-based place in ``order``, written to the shared folder.

    Rows are range-partitioned, sorted within partitions and numbered there;
    a partition's base is the prefix sum of the counts before it, so only that
    small table (a row per partition) is summed up in order.  ``order`` should
    be total, or rows that tie take any order among themselves.
    """
    place = F.monotonically_increasing_id()
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", place)
    sorted_ = materialize(sorted_, "ranked")
    part = F.shiftright("_place", PLACE_BITS).alias("_part")
    counts = sorted_.groupBy(part).agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    numbered = sorted_.withColumn("_part", F.shiftright("_place", PLACE_BITS)).join(bases, "_part")
    rank = F.col("_base") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    return numbered.withColumn(name, rank).drop("_part", "_place", "_base")
