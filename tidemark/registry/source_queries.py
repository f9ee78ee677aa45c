"""Source round-trip queries (SRC-1, SRC-2, SRC-4, SRC-5, PRJ-2).

Each writes data Spark derived from the driver's tables to a fresh folder
under the shared staging root, then reads it back through the source under
test, so the whole table passes through the connector.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tidemark.plans import dashboard, market
from tidemark.registry import query
from tidemark.registry.dashboard_queries import BRONZE_SQL
from tidemark.registry.market_queries import SILVER_COLS, silver
from tidemark.registry.orders_queries import ORDER_CTES
from tidemark.registry.sql import BRONZE, MARKET_CHAIN, RAW_FEED, SOURCE_FILE, with_ctes
from tidemark.schemas import MARKET_FIELDS
from tidemark.session import staging_path
from tidemark.sinks import writers
from tidemark.sources import bindings, files


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:12]}"


@query(
    "src_jsonl_schema",
    with_ctes(RAW_FEED, select=f"SELECT {', '.join(MARKET_FIELDS)}, '{SOURCE_FILE}' AS source_file FROM raw_feed"),
)
def src_jsonl_schema(spark, sf_dir):
    """SRC-1 + PRJ-2: raw feed written as JSON lines, read back under the explicit 8-string schema."""
    path = staging_path(spark, "raw_feed_jsonl")
    writers.write_jsonl(bindings.raw_feed(spark, sf_dir).select(*MARKET_FIELDS), path)
    return files.read_market_batch(spark, path, source_file=SOURCE_FILE)


@query("src_csv_orders", with_ctes(*ORDER_CTES, select="SELECT order_id, customer, status, amount FROM orders_in"))
def src_csv_orders(spark, sf_dir):
    """SRC-2: orders extract written as header CSV, read back typed with FAILFAST."""
    path = staging_path(spark, "orders_csv")
    writers.write_csv(bindings.orders_in(spark, sf_dir), path)
    return files.read_orders_csv(spark, path)


@query("src_managed_table", with_ctes(*MARKET_CHAIN, select=f"SELECT {SILVER_COLS} FROM silver"))
def src_managed_table(spark, sf_dir):
    """SRC-4 / SNK-1: silver saved as a managed table, then read with ``spark.table``."""
    name = writers.staging_table(spark, "silver_market_ticks")
    writers.overwrite_table(silver(spark, sf_dir).select(*MARKET_FIELDS, "source_file"), name)
    return files.read_table(spark, name)


@query("src_sql_identifier", with_ctes(RAW_FEED, BRONZE, select=BRONZE_SQL))
def src_sql_identifier(spark, sf_dir):
    """SRC-5: SQL text over a computed table name bound with ``IDENTIFIER(:t)``."""
    name = _table_name("bronze_market_events")
    bronze = market.with_source_file(bindings.raw_feed(spark, sf_dir), SOURCE_FILE)
    bronze.createOrReplaceTempView(name)
    cols = ", ".join(dashboard.BRONZE_COLS)
    return spark.sql(
        f"SELECT {cols} FROM IDENTIFIER(:t) ORDER BY ingestion_time DESC NULLS LAST, event_time DESC NULLS LAST, "
        "source NULLS FIRST, asset_type NULLS FIRST, symbol NULLS FIRST, price NULLS FIRST, volume NULLS FIRST, "
        "batch_id NULLS FIRST, source_file NULLS FIRST LIMIT 10",
        args={"t": name},
    )


@query(
    "prj_source_file",
    with_ctes(
        RAW_FEED,
        select="SELECT 'batch_id=' || batch_id AS source_dir, CAST(count(*) AS BIGINT) AS rows "
        "FROM raw_feed GROUP BY batch_id",
    ),
)
def prj_source_file(spark, sf_dir):
    """PRJ-2 (multi-file): per-row lineage from the file-source metadata column.

    The feed is written as one folder per batch; every row read back names
    its own file, and rows are counted per folder.
    """
    path = staging_path(spark, "raw_feed_by_batch")
    raw = bindings.raw_feed(spark, sf_dir).select(*MARKET_FIELDS)
    raw.write.mode("overwrite").partitionBy("batch_id").json(path)
    back = files.read_jsonl(spark, path).select("batch_id", F.col("_metadata.file_path").alias("file_path"))
    folder = F.element_at(F.split("file_path", "/"), -2)
    return back.groupBy(folder.alias("source_dir")).agg(F.count(F.lit(1)).alias("rows"))


@query(
    "src_quarantined_lines",
    with_ctes(
        RAW_FEED,
        select="SELECT batch_id, CAST(count(*) AS BIGINT) AS rows, CAST(count(*) FILTER (WHERE quarantined) AS BIGINT) "
        "AS quarantined FROM (SELECT CASE WHEN event_id % 50 <> 0 THEN batch_id END AS batch_id, "
        "event_id % 50 = 0 AS quarantined FROM raw_feed) GROUP BY batch_id",
    ),
)
def src_quarantined_lines(spark, sf_dir):
    """SRC-1: JSON lines of which some are cut short; those lines are set aside whole, the others parsed."""
    path = staging_path(spark, "cut_lines")
    raw = bindings.raw_feed(spark, sf_dir)
    line = F.to_json(F.struct(*MARKET_FIELDS))
    cut = F.when(F.col("event_id") % 50 == 0, F.left(line, F.lit(20))).otherwise(line)
    raw.select(cut.alias("value")).write.text(path)
    read = files.read_jsonl(spark, path, quarantine_column="_line")
    return read.groupBy("batch_id").agg(F.count("*").alias("rows"), F.count("_line").alias("quarantined"))
