"""Scalar-function queries (FN-1..20 that are not already covered by a layer query)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.plans import market
from tidemark.registry import query
from tidemark.registry.market_queries import silver
from tidemark.registry.sql import MARKET_CHAIN, RAW_FEED, plain_decimal, with_ctes
from tidemark.sources import bindings

WS = "' \t\n\r\x0b\x0c'"


#: Feed prices, some of them written with a short, a long or a far too long exponent.
EXPONENTS = """CASE WHEN event_id % 499 = 0 THEN '7.50E+100000' WHEN event_id % 501 = 0 THEN '+.2e-0100000'
  WHEN event_id % 503 = 0 THEN '2e99999999999' WHEN event_id % 11 = 0 THEN price || 'e' || CAST(event_id % 40 - 20 AS STRING)
  ELSE price END"""


def _raw(spark, sf_dir):
    return bindings.raw_feed(spark, sf_dir)


@query(
    "fn_standardize_text",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, lower(trim(source)) AS source, lower(trim(asset_type)) AS asset_type, "
        "upper(trim(symbol)) AS symbol FROM raw_feed",
    ),
)
def fn_standardize_text(spark, sf_dir):
    """FN-1 / FN-2: ``lower(trim())`` and ``upper(trim())``."""
    return _raw(spark, sf_dir).select(
        "event_id",
        fn.lower_trim("source").alias("source"),
        fn.lower_trim("asset_type").alias("asset_type"),
        fn.upper_trim("symbol").alias("symbol"),
    )


@query(
    "fn_try_double",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, TRY_CAST(price AS DOUBLE) AS price, TRY_CAST(volume AS DOUBLE) AS volume FROM raw_feed",
    ),
)
def fn_try_double(spark, sf_dir):
    """FN-3: text → DOUBLE with bad text → NULL (no ANSI failure)."""
    return _raw(spark, sf_dir).select(
        "event_id", fn.try_double("price").alias("price"), fn.try_double("volume").alias("volume")
    )


@query(
    "fn_try_timestamp",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, TRY_CAST(event_time AS TIMESTAMP) AS event_time, "
        "TRY_CAST(ingestion_time AS TIMESTAMP) AS ingestion_time FROM raw_feed",
    ),
)
def fn_try_timestamp(spark, sf_dir):
    """FN-4: ISO-8601 text → TIMESTAMP with bad text → NULL."""
    return _raw(spark, sf_dir).select(
        "event_id",
        fn.try_timestamp("event_time").alias("event_time"),
        fn.try_timestamp("ingestion_time").alias("ingestion_time"),
    )


STOCK_BARS = """sb AS (
  SELECT event_id, ts, value, CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS vol
  FROM events WHERE event_type IN ('click','view','signup'))"""


@query(
    "fn_clean_number",
    with_ctes(
        STOCK_BARS,
        select="SELECT event_id, printf('%.2f', value) AS close, CAST(vol AS VARCHAR) AS volume FROM sb",
    ),
)
def fn_clean_number(spark, sf_dir):
    """FN-10: ``$1,234.50`` → ``1234.50``; ``12,000`` → ``12000``."""
    bars = bindings.stock_bar_rows(spark, sf_dir)
    return bars.select(
        "event_id", fn.clean_number_text("close").alias("close"), fn.clean_number_text("volume").alias("volume")
    )


@query(
    "fn_bar_date_iso",
    with_ctes(
        STOCK_BARS,
        select="SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL "
        "ELSE strftime(ts, '%Y-%m-%d') || 'T00:00:00+00:00' END AS event_time FROM sb",
    ),
)
def fn_bar_date_iso(spark, sf_dir):
    """FN-11: ``MM/dd/yyyy`` → midnight-UTC ISO text; blank or bad → NULL."""
    bars = bindings.stock_bar_rows(spark, sf_dir)
    return bars.select("event_id", fn.bar_date_iso("date").alias("event_time"))


@query(
    "fn_decimal_text",
    with_ctes(
        RAW_FEED,
        f"exponents AS (SELECT event_id, {EXPONENTS.replace('STRING', 'VARCHAR')} AS price, trim(volume, {WS}) AS volume FROM raw_feed)",
        select=f"SELECT event_id, {plain_decimal('price')} AS price, {plain_decimal('volume')} AS volume, "
        "price = '2e99999999999' AS too_far FROM exponents",
    ),
)
def fn_decimal_text(spark, sf_dir):
    """FN-12: positive decimals as plain text (scale kept, exponents written out), everything else NULL."""
    rows = _raw(spark, sf_dir).select("event_id", F.expr(EXPONENTS).alias("price"), "volume")
    return rows.select(
        "event_id",
        fn.decimal_text("price").alias("price"),
        fn.decimal_text("volume").alias("volume"),
        fn.decimal_too_far("price").alias("too_far"),
    )


@query(
    "fn_normalize_text",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, "
        f"lower(trim(coalesce(source, ''), {WS})) AS source, "
        f"lower(trim(coalesce(asset_type, ''), {WS})) AS asset_type, "
        f"upper(trim(coalesce(symbol, ''), {WS})) AS symbol, "
        f"trim(coalesce(event_time, ''), {WS}) AS event_time FROM raw_feed",
    ),
)
def fn_normalize_text(spark, sf_dir):
    """FN-13: missing → ``""``, all whitespace stripped, case folded."""
    return _raw(spark, sf_dir).select(
        "event_id",
        fn.normalize_text("source", "lower").alias("source"),
        fn.normalize_text("asset_type", "lower").alias("asset_type"),
        fn.normalize_text("symbol", "upper").alias("symbol"),
        fn.normalize_text("event_time", "keep").alias("event_time"),
    )


@query(
    "fn_as_number",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, CASE WHEN isfinite(TRY_CAST(price AS DOUBLE)) THEN TRY_CAST(price AS DOUBLE) "
        "ELSE 0.0 END AS price FROM raw_feed",
    ),
)
def fn_as_number(spark, sf_dir):
    """FN-16: display coercion, unparsable or non-finite → 0."""
    return _raw(spark, sf_dir).select("event_id", fn.as_number("price").alias("price"))


# Round on the shortest decimal text of the double, half away from zero, as the browser does.
def _dec(x: str) -> str:
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,10))"


def _currency_sql(x: str) -> str:
    return (
        f"CASE WHEN {x} >= 1000 THEN '$' || format('{{:,.0f}}', round({x}, 0)) "
        f"WHEN {x} < 0 THEN '-$' || format('{{:,.2f}}', -round({x}, 2)) "
        f"ELSE '$' || format('{{:,.2f}}', round({x}, 2)) END"
    )


def _two_dp_sql(x: str) -> str:
    return f"regexp_replace(printf('%.2f', round({_dec(x)}, 2)), '\\.?0+$', '')"


def _compact_sql(x: str) -> str:
    parts = []
    for unit, suffix in ((1e12, "T"), (1e9, "B"), (1e6, "M"), (1e3, "K")):
        u = repr(unit)
        parts.append(f"WHEN abs({x}) >= {unit * 0.999995!r} THEN {_two_dp_sql(f'({x} / {u})')} || '{suffix}'")
    return "CASE " + " ".join(parts) + f" ELSE {_two_dp_sql(x)} END"


VALUED = """valued AS (SELECT symbol, event_time, event_id, price, price * volume AS transaction_value FROM silver)"""


@query(
    "fn_currency_text",
    with_ctes(
        *MARKET_CHAIN,
        VALUED,
        select=f"SELECT event_id, {_currency_sql('price')} AS price_text, "
        f"{_currency_sql('transaction_value')} AS value_text FROM valued",
    ),
)
def fn_currency_text(spark, sf_dir):
    """FN-17: ``$`` text; whole dollars from 1,000 up, cents below."""
    s = market.with_transaction_value(silver(spark, sf_dir))
    return s.select(
        "event_id",
        fn.currency_text("price").alias("price_text"),
        fn.currency_text("transaction_value").alias("value_text"),
    )


@query(
    "fn_compact_number",
    with_ctes(
        *MARKET_CHAIN,
        VALUED,
        select=f"SELECT event_id, {_compact_sql('transaction_value')} AS value_text, "
        f"{_compact_sql('price')} AS price_text FROM valued",
    ),
)
def fn_compact_number(spark, sf_dir):
    """FN-18: compact K/M/B/T notation with at most two decimals."""
    s = market.with_transaction_value(silver(spark, sf_dir))
    return s.select(
        "event_id",
        fn.compact_number("transaction_value").alias("value_text"),
        fn.compact_number("price").alias("price_text"),
    )


@query(
    "fn_display_date",
    with_ctes(
        RAW_FEED,
        select="SELECT event_id, CASE WHEN event_time IS NULL OR event_time = '' THEN 'Unknown' "
        "WHEN TRY_CAST(event_time AS TIMESTAMP) IS NOT NULL "
        "THEN strftime(TRY_CAST(event_time AS TIMESTAMP), '%b %-d, %I:%M %p') ELSE event_time END AS shown, "
        "strftime(TRY_CAST(ingestion_time AS TIMESTAMP), '%b %-d, %I:%M %p') AS ingested FROM raw_feed",
    ),
)
def fn_display_date(spark, sf_dir):
    """FN-19: ``MMM d, hh:mm a`` in UTC; empty → ``Unknown``; unparsable → original text."""
    return _raw(spark, sf_dir).select(
        "event_id", fn.display_date("event_time").alias("shown"), fn.display_date("ingestion_time").alias("ingested")
    )


@query(
    "fn_type_label",
    with_ctes(
        RAW_FEED,
        select="SELECT label, CAST(count(*) AS BIGINT) AS rows FROM "
        "(SELECT upper(coalesce(asset_type, '')) AS label FROM raw_feed) GROUP BY label",
    ),
)
def fn_type_label(spark, sf_dir):
    """FN-20: upper-case type label (NULL → empty), counted per label."""
    return (
        _raw(spark, sf_dir)
        .select(fn.type_label("asset_type").alias("label"))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query(
    "snk_tenant_suffix",
    "SELECT c_custkey AS tenant_id, bundle_target, principal, "
    "regexp_replace(lower(bundle_target), '[^a-z0-9_]', '_', 'g') || '_' || "
    "substring(regexp_replace(lower(principal), '[^a-z0-9_]', '_', 'g'), 1, 32) || '_' || "
    "substring(sha1(principal), 1, 8) AS table_suffix FROM ("
    "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Dev' ELSE 'prod-EU' END AS bundle_target, "
    "c_name || '.' || lower(c_mktsegment) || '@Example.com' AS principal FROM customer)",
)
def snk_tenant_suffix(spark, sf_dir):
    """SNK-6 / FN-8 / FN-9: per-tenant table-name suffix."""
    t = bindings.tenants(spark, sf_dir)
    return t.select("tenant_id", "bundle_target", "principal", fn.tenant_suffix("bundle_target", "principal").alias("table_suffix"))
