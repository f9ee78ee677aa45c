"""Feed build (PIP-3): vendor payloads → feed records → normalised batch → JSONL.

The reference does this on one machine with per-record Python.  Here every
step is a DataFrame transformation, so a batch of any size is parsed,
normalised and written by the executors:

* SRC-7 / SRC-8 parse the payload text with ``from_json`` under an explicit
  schema; broken payloads become reject rows instead of exceptions.
* QA-14 assigns a ``reject_reason`` with a ``when`` ladder (the first failing
  rule wins, in the reference's order); *strict* mode raises if any row is
  rejected (the batch is all-or-nothing), *lenient* mode keeps the accepted.
* PRJ-9 stamps one batch id and one ingestion time on every row, as driver
  literals (``F.uuid()`` would give one id per row).
"""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ALLOWED_ASSET_TYPES, ALLOWED_SOURCES
from tidemark.functions import decimal_text, decimal_too_far, normalize_text
from tidemark.operators.quality import DataQualityError
from tidemark.schemas import MARKET_FIELDS

FEED_FIELDS = ("source", "asset_type", "symbol", "price", "volume", "event_time")

# Reject reasons, in the order the rules are tried.
REASONS = (
    "unsupported_source",
    "unsupported_asset_type",
    "missing_symbol",
    "missing_event_time",
    "invalid_price",
    "invalid_volume",
    "price_exponent_too_large",
    "volume_exponent_too_large",
)


def _field(df: DataFrame, name: str) -> Column:
    """A missing field reads as ``""`` (``record.get(k, "")``)."""
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalized_columns(df: DataFrame) -> dict[str, Column]:
    """FN-13 + FN-12 over the six feed fields."""
    return {
        "source": normalize_text(_field(df, "source"), "lower"),
        "asset_type": normalize_text(_field(df, "asset_type"), "lower"),
        "symbol": normalize_text(_field(df, "symbol"), "upper"),
        "price": decimal_text(_field(df, "price")),
        "volume": decimal_text(_field(df, "volume")),
        "event_time": normalize_text(_field(df, "event_time"), "keep"),
    }


def reject_reason(df: DataFrame, cols: dict[str, Column]) -> Column:
    """QA-14: first failing rule, or NULL when the record is accepted.

    A number whose exponent is too large to write out is no invalid one; it has a reason of its own.
    """
    number = lambda name, invalid, far: F.when(decimal_too_far(_field(df, name)), far).otherwise(invalid)
    return (
        F.when(~cols["source"].isin(*ALLOWED_SOURCES), REASONS[0])
        .when(~cols["asset_type"].isin(*ALLOWED_ASSET_TYPES), REASONS[1])
        .when(cols["symbol"] == "", REASONS[2])
        .when(cols["event_time"] == "", REASONS[3])
        .when(cols["price"].isNull(), number("price", REASONS[4], REASONS[6]))
        .when(cols["volume"].isNull(), number("volume", REASONS[5], REASONS[7]))
    )


def with_reject_reason(df: DataFrame) -> DataFrame:
    """Rows of ``df`` with ``reject_reason`` (``accepted`` when every rule passes)."""
    cols = normalized_columns(df)
    return df.withColumn("reject_reason", F.coalesce(reject_reason(df, cols), F.lit("accepted")))


def normalize(
    records: DataFrame,
    batch_id: str | None = None,
    ingestion_time: str | None = None,
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Normalise feed records → ``(accepted, rejected)``.

    ``accepted`` has the eight market fields (all text); ``rejected`` keeps the
    original fields plus ``reject_reason``.  With ``strict`` the batch is
    checked with one aggregate and a rejected row raises, as the reference's
    per-record ``ValueError`` does.
    """
    batch = batch_id or str(uuid.uuid4())
    stamp = ingestion_time or datetime.now(timezone.utc).isoformat()
    cols = normalized_columns(records)
    reason = reject_reason(records, cols)
    tagged = records.select(
        *[F.col(c) for c in records.columns],
        *[v.alias(f"_n_{k}") for k, v in cols.items()],
        reason.alias("reject_reason"),
    )
    accepted = tagged.where(F.col("reject_reason").isNull()).select(
        *[F.col(f"_n_{k}").alias(k) for k in FEED_FIELDS],
        F.lit(stamp).alias("ingestion_time"),
        F.lit(batch).alias("batch_id"),
    ).select(*MARKET_FIELDS)
    rejected = tagged.where(F.col("reject_reason").isNotNull()).select(*records.columns, "reject_reason")
    if strict:
        first = rejected.select("reject_reason").limit(1).collect()
        if first:
            raise DataQualityError(f"feed batch rejected: {first[0]['reject_reason']}")
    return accepted, rejected


def error_counts(*parsed: DataFrame) -> DataFrame:
    """Payloads without a record, by feed and reason."""
    failed = [p.where(F.col("error").isNotNull()).select("source", "error") for p in parsed]
    whole = failed[0]
    for more in failed[1:]:
        whole = whole.unionByName(more)
    return whole.groupBy("source", "error").agg(F.count(F.lit(1)).alias("payloads"))


def union_feeds(stocks: DataFrame | None, crypto: DataFrame | None) -> DataFrame:
    """SET-1 / FLT-13: union-all of the enabled feed branches (decided when the plan is built)."""
    branches = [b.select(*FEED_FIELDS) for b in (stocks, crypto) if b is not None]
    if not branches:
        raise ValueError("at least one feed must be enabled")
    out = branches[0]
    for b in branches[1:]:
        out = out.unionByName(b)
    return out

