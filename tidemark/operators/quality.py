"""Data-quality operators.

The reference runs one ``count()`` job per rule (19 for the market tables, 10
for orders).  Here a table's rules are evaluated in a *single* aggregate pass
(``count_if`` per rule, partial aggregation on every map task, one tiny
shuffle), and the results come back as rows ``(table, check, violations,
passed)``.  Only the fail-fast step collects them, and the number of rows it
collects is the number of rules, never the size of the data.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class DataQualityError(ValueError):
    """Raised by strict validation when a check fails."""


def require(condition: bool, message: str) -> None:
    """QA-13: fail fast with ``message``."""
    if not condition:
        raise DataQualityError(message)


def any_null(columns: Iterable[str]) -> Column:
    """FLT-8: OR of ``isNull`` over the given columns."""
    return reduce(or_, [F.col(c).isNull() for c in columns])


def rule_counts(
    df: DataFrame, rules: Mapping[str, Column], table: str, sizes: Mapping[str, Column] | None = None
) -> DataFrame:
    """Count the rows violating each rule, all rules in one pass.

    A rule is a predicate that is *true for a violating row*; NULL counts as
    not violating, as a ``where(...).count()`` would.  ``sizes`` are checks of
    the table's row count (see :func:`at_least`), taken in the same pass.
    """
    counted = {n: F.count_if(F.coalesce(rule, F.lit(False))) for n, rule in rules.items()} | dict(sizes or {})
    agg = df.agg(*[v.alias(f"_v{i}") for i, v in enumerate(counted.values())])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check"), F.col(f"_v{i}").cast("bigint").alias("violations")) for i, n in enumerate(counted)]
    )
    return agg.select(F.inline(pairs)).select(
        F.lit(table).alias("table"), "check", "violations", (F.col("violations") == 0).alias("passed")
    )


class Observed:
    """Checks of a table taken while it is written, so that they cost no scan of their own.

    The same figures as :func:`rule_counts`, from metrics that the writing
    tasks carry; ``results`` waits for the write.  Put it on the very rows
    that are written: metrics of a stage whose tasks may be run again for a
    later shuffle could count rows twice.
    """

    def __init__(self, rules: Mapping[str, Column], table: str, sizes: Mapping[str, Column] | None = None):
        self.table = table
        self.counted = {n: F.count_if(F.coalesce(rule, F.lit(False))) for n, rule in rules.items()} | dict(sizes or {})
        self.observation = Observation()

    def watch(self, df: DataFrame) -> DataFrame:
        return df.observe(self.observation, *[v.alias(f"_v{i}") for i, v in enumerate(self.counted.values())])

    def results(self, spark: SparkSession) -> DataFrame:
        found = self.observation.get
        rows = [(self.table, n, int(found[f"_v{i}"]), not found[f"_v{i}"]) for i, n in enumerate(self.counted)]
        return spark.createDataFrame(rows, "table string, check string, violations long, passed boolean")


def at_least(n: int) -> Column:
    """QA-2: rows that are missing from a table of at least ``n``."""
    return F.greatest(F.lit(n) - F.count(F.lit(1)), F.lit(0))


def at_most(n: int) -> Column:
    """QA-8: rows beyond ``n``."""
    return F.greatest(F.count(F.lit(1)) - F.lit(n), F.lit(0))


def exactly(n: int) -> Column:
    """QA-9: difference from ``n`` rows."""
    return F.abs(F.count(F.lit(1)) - F.lit(n))


def min_rows(df: DataFrame, n: int, table: str, check: str = "non_empty") -> DataFrame:
    """QA-2/QA-9: the table holds at least ``n`` rows (violations = shortfall)."""
    return rule_counts(df, {}, table, {check: at_least(n)})


def max_rows(df: DataFrame, n: int, table: str, check: str = "max_rows") -> DataFrame:
    """QA-8: at most ``n`` rows (violations = excess)."""
    return rule_counts(df, {}, table, {check: at_most(n)})


def exact_rows(df: DataFrame, n: int, table: str, check: str = "row_count") -> DataFrame:
    """QA-9: exactly ``n`` rows (violations = absolute difference)."""
    return rule_counts(df, {}, table, {check: exactly(n)})


def duplicate_key_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-3: key tuples occurring more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


def unique_key(df: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """QA-6: number of duplicated key tuples (0 = unique)."""
    dup = duplicate_key_groups(df, keys).agg(F.count(F.lit(1)).alias("v"))
    return dup.select(
        F.lit(table).alias("table"),
        F.lit("unique_" + "_".join(keys)).alias("check"),
        F.col("v").cast("bigint").alias("violations"),
        (F.col("v") == 0).alias("passed"),
    )


#: Buckets of the key fingerprints; the table of those that differ has at most as many rows.
FINGERPRINT_BUCKETS = 1024
_SECOND = 0x5EED  # seed of the second hash


def _fingerprints(df: DataFrame, keys: Sequence[str], side: str) -> DataFrame:
    """Per key bucket: the number of keys and two sums of independent hashes, whatever the rows' order."""
    wide = lambda h: F.sum(h.cast("decimal(20,0)"))
    columns = [F.col(k) for k in keys]
    hashed = df.select(F.xxhash64(*columns).alias("h"), F.xxhash64(F.lit(_SECOND), *columns).alias("g"))
    buckets = hashed.groupBy(F.pmod("h", F.lit(FINGERPRINT_BUCKETS)).alias("bucket"))
    return buckets.agg(F.struct(F.count(F.lit(1)).alias("n"), wide(F.col("h")).alias("h"), wide(F.col("g")).alias("g")).alias(side))


def differing_buckets(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Buckets whose keys are not the same on both sides, or not as often there."""
    both = _fingerprints(expected, keys, "e").join(_fingerprints(actual, keys, "a"), "bucket", "full")
    return both.where(~F.col("e").eqNullSafe(F.col("a"))).select("bucket")


def key_set_diff(expected: DataFrame, actual: DataFrame, keys: Sequence[str]) -> DataFrame:
    """JON-2: keys present on one side only, both directions.

    Rows: ``(side, *keys)`` where side is ``missing`` (expected, not actual)
    or ``unexpected`` (actual, not expected); null keys are equal.

    Order-free fingerprints of key buckets are compared first, so equal sides
    exchange a row per bucket and task and no keys.  Only the keys of buckets
    that differ are then flagged and grouped together, exactly.  Two sides
    are taken as equal without a look at their keys where the count and both
    64-bit sums of every bucket agree.
    """
    differ = F.broadcast(differing_buckets(expected, actual, keys))
    bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(FINGERPRINT_BUCKETS)).alias("bucket")
    expected, actual = (df.select(*keys, bucket).join(differ, "bucket", "left_semi") for df in (expected, actual))
    flagged = expected.select(*keys, F.lit(True).alias("_e")).unionByName(actual.select(*keys, F.lit(False).alias("_e")))
    sides = flagged.groupBy(*keys).agg(F.bool_or("_e").alias("_in_e"), F.bool_and("_e").alias("_only_e"))
    side = F.when(F.col("_only_e"), "missing").when(~F.col("_in_e"), "unexpected")
    return sides.select(side.alias("side"), *keys).where(F.col("side").isNotNull())


def key_set_equal(expected: DataFrame, actual: DataFrame, keys: Sequence[str], table: str) -> DataFrame:
    """QA-12: the two key sets are equal (violations = keys on one side only)."""
    diff = key_set_diff(expected, actual, keys).agg(F.count(F.lit(1)).alias("v"))
    return diff.select(
        F.lit(table).alias("table"),
        F.lit("key_set_equal").alias("check"),
        F.col("v").cast("bigint").alias("violations"),
        (F.col("v") == 0).alias("passed"),
    )


def schema_contract(df: DataFrame, contract: Iterable[str]) -> tuple[list[str], list[str]]:
    """QA-1: (missing, unexpected) columns against a contract; order is ignored."""
    have, want = set(df.columns), set(contract)
    return sorted(want - have), sorted(have - want)


def enforce(results: DataFrame) -> DataFrame:
    """Strict mode: raise on any failing check; return the (small) results otherwise."""
    failing = results.where(~F.col("passed")).collect()
    if failing:
        detail = ", ".join(f"{r['table']}.{r['check']}={r['violations']}" for r in failing)
        raise DataQualityError(f"data-quality checks failed: {detail}")
    return results
