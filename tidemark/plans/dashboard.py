"""Dashboard export (PIP-4): four capped, ordered extracts → one nested JSON document.

The reference sends four SQL statements to a remote warehouse and assembles
the document in Python.  Here each extract is a DataFrame (``orderBy`` +
``limit`` plans as TakeOrderedAndProject: a per-task top-n, then a merge of
at most n rows per task), the rows become ordered arrays of structs, and
``to_json`` renders the document, so only the final document, a single
bounded string, ever reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.constants import DASH_BRONZE_LIMIT, DASH_SUMMARY_LIMIT, DASH_TOP_LIMIT

# --- FIXED VALUES: columns of the four extracts -----------------------------------------
BRONZE_COLS = (
    "source",
    "asset_type",
    "symbol",
    "price",
    "volume",
    "event_time",
    "ingestion_time",
    "batch_id",
    "source_file",
)
SUMMARY_COLS = ("symbol", "asset_type", "latest_price", "volume", "high", "low", "last_updated")
TOP_COLS = ("rank", "symbol", "price", "volume", "transaction_value", "event_time")


def bronze_order() -> list[Column]:
    """Export order of the bronze extract; the remaining columns break ties deterministically."""
    return [F.col("ingestion_time").desc(), F.col("event_time").desc()] + [
        F.col(c).asc() for c in BRONZE_COLS if c not in ("ingestion_time", "event_time")
    ]


def bronze_latest(bronze: DataFrame, n: int = DASH_BRONZE_LIMIT) -> DataFrame:
    """SRT-1: newest raw rows by *text* order of ingestion_time, then event_time (T10)."""
    return bronze.select(*BRONZE_COLS).orderBy(*bronze_order()).limit(n)


def bronze_latest_typed(bronze: DataFrame, n: int = DASH_BRONZE_LIMIT) -> DataFrame:
    """SRT-1, typed variant: the same extract ordered by the parsed instants.

    Text order treats ``...Z`` and ``...+00:00`` forms as unrelated strings;
    parsing first compares them as instants (rows that do not parse sort last).
    """
    order = [
        F.try_to_timestamp("ingestion_time").desc_nulls_last(),
        F.try_to_timestamp("event_time").desc_nulls_last(),
    ] + [F.col(c).asc() for c in BRONZE_COLS]
    return bronze.select(*BRONZE_COLS).orderBy(*order).limit(n)


def summary_extract(summary: DataFrame, n: int = DASH_SUMMARY_LIMIT) -> DataFrame:
    """SRT-2: gold summary ordered by asset type, symbol."""
    return summary.select(*SUMMARY_COLS).orderBy("asset_type", "symbol").limit(n)


def top_extract(top: DataFrame, n: int = DASH_TOP_LIMIT) -> DataFrame:
    """SRT-3: a top-k table ordered by rank."""
    return top.select(*TOP_COLS).orderBy("rank").limit(n)


def as_text_rows(df: DataFrame) -> DataFrame:
    """T11: every exported value is text; timestamps in ISO-8601 with milliseconds and ``Z``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.typeName() in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        cols.append(c.cast("string").alias(f.name))
    return df.select(*cols)


def ordered_rows(df: DataFrame, order: list[Column]) -> DataFrame:
    """AGG-9: rows → one array of structs (keys sorted), in the given order.

    The input is a capped extract (at most 10 rows), so the single group and
    the position window over it are bounded by the cap, not by the data.
    """
    pos = F.row_number().over(Window.orderBy(*order))
    text = as_text_rows(df.withColumn("_p", pos))
    keys = sorted(c for c in text.columns if c != "_p")
    keyed = text.select(F.col("_p").cast("int").alias("_p"), F.struct(*[F.col(k) for k in keys]).alias("_r"))
    arr = F.transform(F.sort_array(F.collect_list(F.struct("_p", "_r"))), lambda x: x["_r"])
    return keyed.agg(arr.alias("rows"))


def tiles(summary_rows: DataFrame, bronze_rows: DataFrame) -> DataFrame:
    """AGG-8: header tiles over the exported extracts (assets, stocks, crypto, latest rows)."""
    s = summary_rows.agg(
        F.count(F.lit(1)).alias("asset_count"),
        F.count_if(F.col("asset_type") == "stock").alias("stock_count"),
        F.count_if(F.col("asset_type") == "crypto").alias("crypto_count"),
    )
    b = bronze_rows.agg(F.count(F.lit(1)).alias("batch_count"))
    return s.select("*", b.scalar().alias("batch_count"))


def document(
    spark: SparkSession,
    bronze: DataFrame,
    summary: DataFrame,
    top_stock: DataFrame,
    top_crypto: DataFrame,
    bundle_target: str,
    principal: str,
    tables: dict[str, str],
    generated_at: str,
) -> DataFrame:
    """SNK-4: the nested dashboard document as one JSON text (keys sorted at every level)."""
    b = ordered_rows(bronze_latest(bronze), bronze_order())
    s = ordered_rows(summary_extract(summary), [F.col("asset_type"), F.col("symbol")])
    ts = ordered_rows(top_extract(top_stock), [F.col("rank")])
    tc = ordered_rows(top_extract(top_crypto), [F.col("rank")])
    tables_struct = F.struct(*[F.lit(tables[k]).alias(k) for k in sorted(tables)])
    doc = F.struct(
        F.struct(b.scalar().alias("latest_records")).alias("bronze"),
        F.lit(bundle_target).alias("bundle_target"),
        F.lit(generated_at).alias("generated_at"),
        F.struct(
            s.scalar().alias("latest_summary"),
            tc.scalar().alias("top_crypto_transactions"),
            ts.scalar().alias("top_stock_transactions"),
        ).alias("gold"),
        F.lit(principal).alias("principal"),
        tables_struct.alias("tables"),
    )
    # one row in one partition: the document is written as a single small file
    return spark.range(1, numPartitions=1).select(F.to_json(doc, {"ignoreNullFields": "false"}).alias("document"))
