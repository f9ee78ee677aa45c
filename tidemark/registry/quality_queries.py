"""Data-quality queries (QA-1..12, QA-14)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality as qa
from tidemark.operators.lineage import materialize
from tidemark.plans import feed, market, market_checks, orders
from tidemark.registry import query
from tidemark.registry.market_queries import bronze
from tidemark.registry.orders_queries import ORDER_CTES, bronze_orders
from tidemark.registry.sql import LATEST, MARKET_CHAIN, RAW_FEED, SUMMARY, TOPK, positive_decimal, with_ctes
from tidemark.sources import bindings
from tidemark.schemas import (
    BRONZE_MARKET_COLUMNS,
    BRONZE_ORDER_COLUMNS,
    GOLD_SUMMARY_COLUMNS,
    SILVER_MARKET_COLUMNS,
    SILVER_ORDER_COLUMNS,
    TOP_TRANSACTION_COLUMNS,
)


def _layers(spark, sf_dir, branches: int = 2):
    """Bronze (lazy) and silver, which is written once if two or more branches read it."""
    b = bronze(spark, sf_dir)
    s = market.silver(b)
    return b, materialize(s) if branches > 1 else s


def _check_sql(table: str, check: str, violations_sql: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '{check}' AS \"check\", CAST(v AS BIGINT) AS violations, "
        f"v = 0 AS passed FROM (SELECT ({violations_sql}) AS v)"
    )


def _union(*sql: str) -> str:
    return "\nUNION ALL\n".join(sql)


def _contract_row(table: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", '' AS missing, '' AS unexpected, true AS passed, "
        f"CAST(count(*) AS BIGINT) AS rows FROM {source}"
    )


SCHEMA_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    TOPK,
    *ORDER_CTES,
    select=_union(
        _contract_row("bronze_market_events", "bronze"),
        _contract_row("silver_market_ticks", "silver"),
        _contract_row("gold_market_summary", "summary"),
        _contract_row("gold_top_stock_transactions", "(SELECT * FROM topk WHERE asset_type = 'stock')"),
        _contract_row("gold_top_crypto_transactions", "(SELECT * FROM topk WHERE asset_type = 'crypto')"),
        _contract_row("proof_bronze_orders", "bronze_orders"),
        _contract_row("proof_silver_orders", "silver_orders"),
    ),
)


@query("qa_schema_contract", SCHEMA_SQL)
def qa_schema_contract(spark, sf_dir):
    """QA-1: every layer's column set against its contract, with the layer's row count.

    The column comparison is driver metadata; the row count is a Spark
    aggregate per layer, so the query scans what it checks.
    """
    b, s = _layers(spark, sf_dir)
    s_out = s.drop("event_id")
    bo = bronze_orders(spark, sf_dir)
    layers = [
        ("bronze_market_events", b.drop("event_id"), BRONZE_MARKET_COLUMNS),
        ("silver_market_ticks", s_out, SILVER_MARKET_COLUMNS),
        ("gold_market_summary", market.gold_summary(s), GOLD_SUMMARY_COLUMNS),
        ("gold_top_stock_transactions", market.top_for_type(s, "stock"), TOP_TRANSACTION_COLUMNS),
        ("gold_top_crypto_transactions", market.top_for_type(s, "crypto"), TOP_TRANSACTION_COLUMNS),
        ("proof_bronze_orders", bo, BRONZE_ORDER_COLUMNS),
        ("proof_silver_orders", orders.silver(bo), SILVER_ORDER_COLUMNS),
    ]
    parts = []
    for name, df, contract in layers:
        missing, unexpected = qa.schema_contract(df, contract)
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                F.lit(",".join(missing)).alias("missing"),
                F.lit(",".join(unexpected)).alias("unexpected"),
                F.lit(not missing and not unexpected).alias("passed"),
                "rows",
            )
        )
    return reduce(DataFrame.unionByName, parts)


NULL_SQL = with_ctes(
    *MARKET_CHAIN,
    select=_union(
        _check_sql(
            "silver_market_ticks",
            "null_required",
            "SELECT count_if(source IS NULL OR asset_type IS NULL OR symbol IS NULL OR price IS NULL OR volume IS NULL "
            "OR event_time IS NULL OR ingestion_time IS NULL OR batch_id IS NULL) FROM silver",
        ),
        _check_sql(
            "standardised_bronze",
            "null_required",
            "SELECT count_if(source IS NULL OR asset_type IS NULL OR symbol IS NULL OR price IS NULL OR volume IS NULL "
            "OR event_time IS NULL OR ingestion_time IS NULL OR batch_id IS NULL) FROM std",
        ),
    ),
)


@query("qa_null_required", NULL_SQL)
def qa_null_required(spark, sf_dir):
    """QA-3 / FLT-8: OR-ed NULL tests on the required fields (silver, and before cleaning)."""
    b, s = _layers(spark, sf_dir, branches=1)
    req = market_checks.SILVER_REQUIRED
    return qa.rule_counts(s, {"null_required": qa.any_null(req)}, "silver_market_ticks").unionByName(
        qa.rule_counts(market.standardize(b), {"null_required": qa.any_null(req)}, "standardised_bronze")
    )


ALLOWED_SQL = with_ctes(
    *MARKET_CHAIN,
    select=_union(
        _check_sql("silver_market_ticks", "invalid_source", "SELECT count_if(source NOT IN ('nasdaq','coinbase')) FROM silver"),
        _check_sql("silver_market_ticks", "invalid_asset_type", "SELECT count_if(asset_type NOT IN ('stock','crypto')) FROM silver"),
        _check_sql("standardised_bronze", "invalid_source", "SELECT count_if(source NOT IN ('nasdaq','coinbase')) FROM std"),
        _check_sql("standardised_bronze", "invalid_asset_type", "SELECT count_if(asset_type NOT IN ('stock','crypto')) FROM std"),
    ),
)


@query("qa_allowed_values", ALLOWED_SQL)
def qa_allowed_values(spark, sf_dir):
    """QA-4: values outside the allowed vocabularies (NULL not counted)."""
    b, s = _layers(spark, sf_dir, branches=1)
    rules = {k: v for k, v in market_checks.silver_rules().items() if k in ("invalid_source", "invalid_asset_type")}
    return qa.rule_counts(s, rules, "silver_market_ticks").unionByName(
        qa.rule_counts(market.standardize(b), rules, "standardised_bronze")
    )


POSITIVE_SQL = with_ctes(
    *MARKET_CHAIN,
    *ORDER_CTES,
    select=_union(
        _check_sql("silver_market_ticks", "invalid_numeric", "SELECT count_if(price <= 0 OR volume <= 0) FROM silver"),
        _check_sql("standardised_bronze", "invalid_numeric", "SELECT count_if(price <= 0 OR volume <= 0) FROM std"),
        _check_sql("proof_bronze_orders", "non_positive_amount", "SELECT count_if(amount <= 0) FROM bronze_orders"),
        _check_sql("proof_silver_orders", "non_positive_amount", "SELECT count_if(amount <= 0) FROM silver_orders"),
    ),
)


@query("qa_positive", POSITIVE_SQL)
def qa_positive(spark, sf_dir):
    """QA-5: price/volume positive (market), amount positive (orders, both layers)."""
    b, s = _layers(spark, sf_dir, branches=1)
    num = {"invalid_numeric": market_checks.silver_rules()["invalid_numeric"]}
    amt = {"non_positive_amount": F.expr("amount <= 0")}
    bo = bronze_orders(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [
            qa.rule_counts(s, num, "silver_market_ticks"),
            qa.rule_counts(market.standardize(b), num, "standardised_bronze"),
            qa.rule_counts(bo, amt, "proof_bronze_orders"),
            qa.rule_counts(orders.silver(bo), amt, "proof_silver_orders"),
        ],
    )


UNIQUE_SQL = with_ctes(
    *MARKET_CHAIN,
    *ORDER_CTES,
    select=_union(
        _check_sql(
            "silver_market_ticks",
            "unique_batch_id_symbol_event_time",
            "SELECT count(*) FROM (SELECT 1 FROM silver GROUP BY batch_id, symbol, event_time HAVING count(*) > 1)",
        ),
        _check_sql(
            "standardised_bronze",
            "unique_batch_id_symbol_event_time",
            "SELECT count(*) FROM (SELECT 1 FROM std GROUP BY batch_id, symbol, event_time HAVING count(*) > 1)",
        ),
        _check_sql(
            "proof_bronze_orders",
            "unique_order_id",
            "SELECT count(*) FROM (SELECT 1 FROM bronze_orders GROUP BY order_id HAVING count(*) > 1)",
        ),
    ),
)


@query("qa_unique_key", UNIQUE_SQL)
def qa_unique_key(spark, sf_dir):
    """QA-6: duplicated key tuples (market dedup keys; order_id)."""
    b, s = _layers(spark, sf_dir, branches=1)
    keys = ["batch_id", "symbol", "event_time"]
    return reduce(
        DataFrame.unionByName,
        [
            qa.unique_key(s, keys, "silver_market_ticks"),
            qa.unique_key(market.standardize(b), keys, "standardised_bronze"),
            qa.unique_key(bronze_orders(spark, sf_dir), ["order_id"], "proof_bronze_orders"),
        ],
    )


GOLD_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    select=_check_sql(
        "gold_market_summary",
        "invalid_rows",
        "SELECT count_if(symbol IS NULL OR asset_type IS NULL OR latest_price IS NULL OR volume IS NULL "
        "OR last_updated IS NULL OR latest_price <= 0 OR volume <= 0) FROM summary",
    ),
)


@query("qa_gold_summary", GOLD_SQL)
def qa_gold_summary(spark, sf_dir):
    """QA-7: gold summary rows with a NULL required field or a non-positive price/volume."""
    _, s = _layers(spark, sf_dir, branches=1)
    return qa.rule_counts(market.gold_summary(s), market_checks.gold_rules(), "gold_market_summary")


def _topk_sql(asset_type: str, table: str) -> list[str]:
    src = f"(SELECT * FROM topk WHERE asset_type = '{asset_type}')"
    return [
        f"SELECT '{table}' AS \"table\", 'max_rows' AS \"check\", CAST(greatest(count(*) - 5, 0) AS BIGINT) AS violations, "
        f"count(*) <= 5 AS passed FROM {src}",
        _check_sql(table, "wrong_asset_type", f"SELECT count_if(asset_type != '{asset_type}') FROM {src}"),
        _check_sql(table, "invalid_rank", f"SELECT count_if(rank < 1 OR rank > 5) FROM {src}"),
        _check_sql(
            table,
            "invalid_transaction_value",
            f"SELECT count_if(transaction_value IS NULL OR transaction_value <= 0 "
            f"OR abs(transaction_value - price * volume) > 0.0001) FROM {src}",
        ),
    ]


TOPK_SQL = with_ctes(
    *MARKET_CHAIN,
    TOPK,
    select=_union(
        *_topk_sql("stock", "gold_top_stock_transactions"),
        *_topk_sql("crypto", "gold_top_crypto_transactions"),
    ),
)


@query("qa_topk", TOPK_SQL)
def qa_topk(spark, sf_dir):
    """QA-8: top-k tables: ≤ 5 rows, right type, rank 1..5, value = price × volume."""
    _, s = _layers(spark, sf_dir)
    return market_checks.topk_checks(
        market.top_for_type(s, "stock"), "stock", "gold_top_stock_transactions"
    ).unionByName(market_checks.topk_checks(market.top_for_type(s, "crypto"), "crypto", "gold_top_crypto_transactions"))


CROSS_SQL = with_ctes(
    *ORDER_CTES,
    select=_check_sql(
        "proof_silver_orders",
        "non_complete_status",
        "SELECT count(*) FROM bronze_orders b JOIN silver_orders s USING (order_id) WHERE status != 'complete'",
    ),
)


@query("qa_cross_layer_status", CROSS_SQL)
def qa_cross_layer_status(spark, sf_dir):
    """QA-10: silver holds no non-complete order (bronze ⋈ silver on order_id)."""
    bo = bronze_orders(spark, sf_dir)
    v = orders.non_complete_pairs(bo, orders.silver(bo))
    return v.select(
        F.lit("proof_silver_orders").alias("table"),
        F.lit("non_complete_status").alias("check"),
        F.col("v").alias("violations"),
        (F.col("v") == 0).alias("passed"),
    )


BUCKET_SQL = with_ctes(
    *ORDER_CTES,
    select=_check_sql(
        "proof_silver_orders",
        "bucket_rule",
        "SELECT count_if((amount >= 50 AND amount_bucket != 'high') OR (amount < 50 AND amount_bucket != 'standard')) "
        "FROM silver_orders",
    ),
)


@query("qa_bucket_rule", BUCKET_SQL)
def qa_bucket_rule(spark, sf_dir):
    """QA-11: the derived bucket agrees with its rule."""
    s = orders.silver(bronze_orders(spark, sf_dir))
    return qa.rule_counts(s, {"bucket_rule": orders.wrong_bucket()}, "proof_silver_orders")


KEYSET_SQL = with_ctes(
    *ORDER_CTES,
    select=_check_sql(
        "proof_silver_orders",
        "key_set_equal",
        "SELECT count(*) FROM ((SELECT order_id FROM bronze_orders WHERE status = 'complete' "
        "EXCEPT SELECT order_id FROM silver_orders) UNION ALL (SELECT order_id FROM silver_orders "
        "EXCEPT SELECT order_id FROM bronze_orders WHERE status = 'complete'))",
    ),
)


@query("qa_key_set_equal", KEYSET_SQL)
def qa_key_set_equal(spark, sf_dir):
    """QA-12: silver order ids = complete bronze order ids (two anti joins, no driver-side sets)."""
    bo = bronze_orders(spark, sf_dir)
    return qa.key_set_equal(bo.where("status = 'complete'"), orders.silver(bo), ["order_id"], "proof_silver_orders")


ORDERS_VALIDATION_SQL = with_ctes(
    *ORDER_CTES,
    select=_union(
        _check_sql("bronze_orders", "null_required",
                   "SELECT count_if(order_id IS NULL OR customer IS NULL OR status IS NULL OR amount IS NULL) FROM bronze_orders"),
        _check_sql("bronze_orders", "non_positive_amount", "SELECT count_if(amount <= 0) FROM bronze_orders"),
        _check_sql("silver_orders", "non_positive_amount", "SELECT count_if(amount <= 0) FROM silver_orders"),
        _check_sql("silver_orders", "bucket_rule",
                   "SELECT count_if((amount >= 50 AND amount_bucket != 'high') OR (amount < 50 AND amount_bucket != 'standard')) "
                   "FROM silver_orders"),
        _check_sql("bronze_orders", "unique_order_id",
                   "SELECT count(*) FROM (SELECT 1 FROM bronze_orders GROUP BY order_id HAVING count(*) > 1)"),
        _check_sql("silver_orders", "non_complete_status",
                   "SELECT count(*) FROM bronze_orders b JOIN silver_orders s USING (order_id) WHERE status != 'complete'"),
        _check_sql("silver_orders", "key_set_equal",
                   "SELECT count(*) FROM ((SELECT order_id FROM bronze_orders WHERE status = 'complete' "
                   "EXCEPT SELECT order_id FROM silver_orders) UNION ALL (SELECT order_id FROM silver_orders "
                   "EXCEPT SELECT order_id FROM bronze_orders WHERE status = 'complete'))"),
    ),
)


@query("orders_validation", ORDERS_VALIDATION_SQL)
def orders_validation(spark, sf_dir):
    """PIP-5 (orders): the whole orders suite as rows."""
    bo = bronze_orders(spark, sf_dir)
    return orders.validation(bo, orders.silver(bo))


def _non_empty_sql(table: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS \"table\", 'non_empty' AS \"check\", CAST(greatest(1 - count(*), 0) AS BIGINT) AS violations, "
        f"count(*) >= 1 AS passed FROM {source}"
    )


MARKET_VALIDATION_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    TOPK,
    select=_union(
        _non_empty_sql("bronze_market_events", "bronze"),
        _non_empty_sql("silver_market_ticks", "silver"),
        _non_empty_sql("gold_market_summary", "summary"),
        _check_sql("silver_market_ticks", "null_required",
                   "SELECT count_if(source IS NULL OR asset_type IS NULL OR symbol IS NULL OR price IS NULL OR volume IS NULL "
                   "OR event_time IS NULL OR ingestion_time IS NULL OR batch_id IS NULL) FROM silver"),
        _check_sql("silver_market_ticks", "invalid_source", "SELECT count_if(source NOT IN ('nasdaq','coinbase')) FROM silver"),
        _check_sql("silver_market_ticks", "invalid_asset_type", "SELECT count_if(asset_type NOT IN ('stock','crypto')) FROM silver"),
        _check_sql("silver_market_ticks", "invalid_numeric", "SELECT count_if(price <= 0 OR volume <= 0) FROM silver"),
        _check_sql("silver_market_ticks", "unique_batch_id_symbol_event_time",
                   "SELECT count(*) FROM (SELECT 1 FROM silver GROUP BY batch_id, symbol, event_time HAVING count(*) > 1)"),
        _check_sql("gold_market_summary", "invalid_rows",
                   "SELECT count_if(symbol IS NULL OR asset_type IS NULL OR latest_price IS NULL OR volume IS NULL "
                   "OR last_updated IS NULL OR latest_price <= 0 OR volume <= 0) FROM summary"),
        *_topk_sql("stock", "gold_top_stock_transactions"),
        *_topk_sql("crypto", "gold_top_crypto_transactions"),
    ),
)


@query("market_validation", MARKET_VALIDATION_SQL)
def market_validation(spark, sf_dir):
    """PIP-5 (market): the whole market suite as rows."""
    b, s = _layers(spark, sf_dir)
    return market_checks.validation(
        b, s, market.gold_summary(s), market.top_for_type(s, "stock"), market.top_for_type(s, "crypto")
    )


REJECT_SQL = with_ctes(
    RAW_FEED,
    select="""SELECT reject_reason, CAST(count(*) AS BIGINT) AS rows FROM (
  SELECT CASE
    WHEN lower(trim(coalesce(source, ''), ' \t\n\r\x0b\x0c')) NOT IN ('nasdaq','coinbase') THEN 'unsupported_source'
    WHEN lower(trim(coalesce(asset_type, ''), ' \t\n\r\x0b\x0c')) NOT IN ('stock','crypto') THEN 'unsupported_asset_type'
    WHEN trim(coalesce(symbol, ''), ' \t\n\r\x0b\x0c') = '' THEN 'missing_symbol'
    WHEN trim(coalesce(event_time, ''), ' \t\n\r\x0b\x0c') = '' THEN 'missing_event_time'
    WHEN NOT ({price_ok}) THEN 'invalid_price'
    WHEN NOT ({volume_ok}) THEN 'invalid_volume'
    ELSE 'accepted' END AS reject_reason
  FROM raw_feed) GROUP BY reject_reason""".format(
        price_ok=positive_decimal("trim(price)"), volume_ok=positive_decimal("trim(volume)")
    ),
)


@query("qa_reject_reasons", REJECT_SQL)
def qa_reject_reasons(spark, sf_dir):
    """QA-14: strict normalisation of the raw feed; first failing rule wins, counted per reason."""
    return feed.with_reject_reason(bindings.raw_feed(spark, sf_dir)).groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "qa_exact_rows",
    _union(
        _check_sql("region", "row_count", "SELECT abs(count(*) - 5) FROM region"),
        _check_sql("nation", "row_count", "SELECT abs(count(*) - 25) FROM nation"),
    ),
)
def qa_exact_rows(spark, sf_dir):
    """QA-9: tables of a known size hold exactly that many rows."""
    known = {"region": 5, "nation": 25}
    return reduce(
        DataFrame.unionByName, [qa.exact_rows(bindings.load(spark, sf_dir, t), n, t) for t, n in known.items()]
    )
