"""The reference's jobs as functions over a SparkSession.

* :func:`market_job`        batch file → bronze, silver, gold summary, two top-k tables
* :func:`market_validation` the market checks, strict (raise) or reporting
* :func:`orders_job`        orders CSV → bronze, silver
* :func:`orders_validation` the orders checks (optionally the 4/2 fixture counts)
* :func:`cleanup`           drop every table of a tenant
* :func:`dashboard_export`  the nested dashboard document, written as one JSON text file
* :func:`feed_build`        payload texts → normalised JSONL batch

Tables are named per tenant exactly as the reference names them
(``<layer>_<target>_<principal[:32]>_<sha1[:8]>``).  Each layer is written,
then re-read from its table by the next layer, so every layer boundary is
a lineage cut on shared storage and a failed step can be rerun alone.
"""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import quality as qa
from tidemark.operators.lineage import materialize
from tidemark.plans import dashboard, feed, market, market_checks, orders
from tidemark.sinks import writers
from tidemark.sources import feeds, files


#: Batch files tried in order where none is named.
DEFAULT_BATCHES = ("latest_market_batch.jsonl", "sample_market_batch.jsonl")


def _principal(spark: SparkSession, principal: str | None) -> str:
    return principal if principal is not None else writers.current_principal(spark)


def market_job(
    spark: SparkSession,
    sample_root: str,
    bundle_target: str,
    market_batch_file: str = "",
    principal: str | None = None,
) -> dict[str, str]:
    """PIP-2: run the market medallion for one batch file; returns the table names.

    The checks of bronze, silver and the summary are taken while these are
    written and kept in a table of their own for :func:`market_validation`.
    """
    who = _principal(spark, principal)
    names = writers.market_table_names(bundle_target, who)
    path = files.first_batch(spark, sample_root, [market_batch_file] if market_batch_file else DEFAULT_BATCHES)
    checks = market_checks.observers()
    writers.overwrite_table(checks["bronze"].watch(files.read_market_batch(spark, path)), names["bronze"])
    writers.overwrite_table(checks["silver"].watch(market.silver(spark.table(names["bronze"]))), names["silver"])
    silver = spark.table(names["silver"])
    writers.overwrite_table(checks["summary"].watch(market.gold_summary(silver)), names["summary"])
    taken = [c.results(spark) for c in checks.values()]
    writers.overwrite_table(reduce(DataFrame.unionByName, taken), writers.checks_table_name(names))
    writers.split_by_value(
        market.top_transactions(silver),
        "asset_type",
        {"stock": names["top_stocks"], "crypto": names["top_crypto"]},
    )
    return names


def market_validation(
    spark: SparkSession, bundle_target: str, principal: str | None = None, strict: bool = True, rescan: bool = False
) -> DataFrame:
    """PIP-5 (market): all checks over the written tables; raises on failure when strict.

    Checks that the job took while writing are read from its table; ``rescan``
    counts them again from the tables, as is done where there are none.
    """
    names = writers.market_table_names(bundle_target, _principal(spark, principal))
    t = {k: spark.table(v) for k, v in names.items()}
    from tidemark.schemas import (
        BRONZE_MARKET_COLUMNS,
        GOLD_SUMMARY_COLUMNS,
        SILVER_MARKET_COLUMNS,
        TOP_TRANSACTION_COLUMNS,
    )

    contracts = {
        "bronze": BRONZE_MARKET_COLUMNS,
        "silver": SILVER_MARKET_COLUMNS,
        "summary": GOLD_SUMMARY_COLUMNS,
        "top_stocks": TOP_TRANSACTION_COLUMNS,
        "top_crypto": TOP_TRANSACTION_COLUMNS,
    }
    for key, contract in contracts.items():
        missing, unexpected = qa.schema_contract(t[key], contract)
        qa.require(not missing and not unexpected, f"Unexpected {key} columns: {t[key].columns}")
    taken = writers.checks_table_name(names)
    if rescan or not spark.catalog.tableExists(taken):
        res = market_checks.validation(t["bronze"], t["silver"], t["summary"], t["top_stocks"], t["top_crypto"])
    else:
        res = market_checks.validation_of_written(spark.table(taken), t["silver"], t["top_stocks"], t["top_crypto"])
    return qa.enforce(res) if strict else res


def orders_job(
    spark: SparkSession,
    csv_path: str,
    bundle_target: str,
    principal: str | None = None,
    run_timestamp: str | None = None,
    buckets: int | None = None,
) -> dict[str, str]:
    """PIP-1: orders CSV → bronze → silver tables.

    With ``buckets``, both layers are bucketed alike on ``order_id`` (the
    orders key), so the validation's join and anti joins need no shuffle.
    """
    names = writers.order_table_names(bundle_target, _principal(spark, principal))
    stamp = run_timestamp or datetime.now(timezone.utc).isoformat()
    name = csv_path.rstrip("/").rsplit("/", 1)[-1]
    layout = (buckets, ["order_id"]) if buckets else None
    bronze = orders.bronze(files.read_orders_csv(spark, csv_path), name, stamp)
    writers.overwrite_table(bronze, names["bronze"], bucket_by=layout)
    writers.overwrite_table(orders.silver(spark.table(names["bronze"])), names["silver"], bucket_by=layout)
    return names


def orders_validation(
    spark: SparkSession,
    bundle_target: str,
    principal: str | None = None,
    expected_counts: tuple[int, int] | None = None,
    strict: bool = True,
) -> DataFrame:
    """PIP-5 (orders): schema contracts, then every check in two passes and two joins."""
    from tidemark.schemas import BRONZE_ORDER_COLUMNS, SILVER_ORDER_COLUMNS

    names = writers.order_table_names(bundle_target, _principal(spark, principal))
    b, s = spark.table(names["bronze"]), spark.table(names["silver"])
    for df, contract, label in ((b, BRONZE_ORDER_COLUMNS, "Bronze"), (s, SILVER_ORDER_COLUMNS, "Silver")):
        missing, unexpected = qa.schema_contract(df, contract)
        qa.require(not missing and not unexpected, f"Unexpected {label} columns: {sorted(df.columns)}")
    res = orders.validation(b, s, expected_counts)
    return qa.enforce(res) if strict else res


def cleanup(spark: SparkSession, bundle_target: str, principal: str | None = None) -> list[str]:
    """SNK-5: drop every market and orders table of the tenant."""
    who = _principal(spark, principal)
    market_names = writers.market_table_names(bundle_target, who)
    names = [*writers.order_table_names(bundle_target, who).values(), *market_names.values()]
    writers.drop_tables(spark, [writers.checks_table_name(market_names)])
    return writers.drop_tables(spark, names)


def dashboard_export(
    spark: SparkSession,
    bundle_target: str,
    output_dir: str,
    principal: str | None = None,
    generated_at: str | None = None,
) -> str:
    """PIP-4: build the document from the gold tables and write it as one text file."""
    who = _principal(spark, principal)
    names = writers.market_table_names(bundle_target, who)
    doc = dashboard.document(
        spark,
        spark.table(names["bronze"]),
        spark.table(names["summary"]),
        spark.table(names["top_stocks"]),
        spark.table(names["top_crypto"]),
        bundle_target=bundle_target,
        principal=who,
        tables={k: v for k, v in names.items() if k != "silver"},
        generated_at=generated_at or datetime.now(timezone.utc).isoformat(),
    )
    doc.write.mode("overwrite").text(output_dir)  # one row → one small file
    return output_dir


def feed_build(
    bars: DataFrame | None,
    tickers: DataFrame | None,
    products: DataFrame,
    output_dir: str,
    batch_id: str | None = None,
    strict: bool = True,
    reject_dir: str | None = None,
) -> str:
    """PIP-3: vendor payload texts → normalised JSONL batch.

    Strict: any payload without a record and any rejected record stops the
    build.  Lenient: the accepted records are written, and with
    ``reject_dir`` the others too, with their reason.
    """
    stocks = feeds.parse_daily_bars(bars) if bars is not None else None
    crypto = feeds.map_products(feeds.parse_tickers(tickers), products) if tickers is not None else None
    # every payload is parsed once; errors, rejects and the batch are read from the parsed records
    stocks, crypto = (materialize(p, "parsed-feed") if p is not None else None for p in (stocks, crypto))
    parsed = [p for p in (stocks, crypto) if p is not None]
    if strict and parsed:
        failed = feed.error_counts(*parsed).first()
        if failed is not None:
            raise qa.DataQualityError(f"{failed['payloads']} {failed['source']} payloads failed: {failed['error']}")
    good = [p.where(F.col("error").isNull()) if p is not None else None for p in (stocks, crypto)]
    accepted, rejected = feed.normalize(feed.union_feeds(*good), batch_id=batch_id, strict=strict)
    if reject_dir:
        for p in parsed:
            lost = p.where(F.col("error").isNotNull()).select(*feed.FEED_FIELDS, F.col("error").alias("reject_reason"))
            rejected = rejected.unionByName(lost)
        writers.write_jsonl(rejected, reject_dir)
    return writers.write_jsonl(accepted, output_dir)
