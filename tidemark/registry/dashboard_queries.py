"""Dashboard queries (SRT-1..3, AGG-8, AGG-9, SNK-4, PIP-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.constants import MARKET_TABLE_PREFIXES
from tidemark.operators.lineage import materialize
from tidemark.plans import dashboard, market
from tidemark.registry import query
from tidemark.registry.market_queries import bronze
from tidemark.registry.sql import BRONZE, LATEST, MARKET_CHAIN, RAW_FEED, SUMMARY, TOPK, with_ctes
from tidemark.sinks.writers import market_table_names

BRONZE_SQL = """SELECT source, asset_type, symbol, price, volume, event_time, ingestion_time, batch_id, source_file
FROM bronze ORDER BY ingestion_time DESC NULLS LAST, event_time DESC NULLS LAST, source NULLS FIRST,
         asset_type NULLS FIRST, symbol NULLS FIRST, price NULLS FIRST, volume NULLS FIRST, batch_id NULLS FIRST,
         source_file NULLS FIRST LIMIT 10"""

SUMMARY10_SQL = """SELECT symbol, asset_type, latest_price, volume, high, low, last_updated
FROM summary ORDER BY asset_type NULLS FIRST, symbol NULLS FIRST LIMIT 10"""


def _top_sql(asset_type: str) -> str:
    return (
        "SELECT rank, symbol, price, volume, transaction_value, event_time FROM topk "
        f"WHERE asset_type = '{asset_type}' ORDER BY rank NULLS FIRST LIMIT 5"
    )


def _gold(spark, sf_dir):
    b = bronze(spark, sf_dir)
    s = market.silver(b)
    return b, s


def _top_tables(silver_df):
    """The two top tables of one top-k, which is computed and written once (five rows of either type)."""
    top = materialize(market.top_transactions(silver_df), "top")
    return {t: top.where(F.col("asset_type") == t) for t in ("stock", "crypto")}


def _number_text(column: str) -> str:
    """SQL for the text of a double: plain from a thousandth up to ten million, else with an exponent."""
    whole, fraction = f"split_part(CAST({column} AS VARCHAR), '.', 1)", f"split_part(CAST({column} AS VARCHAR), '.', 2)"
    digits = f"coalesce(nullif(rtrim(substr({whole}, 2) || coalesce(nullif({fraction}, '0'), ''), '0'), ''), '0')"
    return (
        f"CASE WHEN {column} >= 1e7 THEN substr({whole}, 1, 1) || '.' || {digits} || 'E' || CAST(length({whole}) - 1 AS VARCHAR) "
        f"ELSE CAST({column} AS VARCHAR) END"
    )


def _time_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S.%g') || 'Z'"


_TEXT = {
    "rank": "CAST(rank AS VARCHAR)",
    **{c: _number_text(c) for c in ("price", "volume", "transaction_value", "latest_price", "high", "low")},
    **{c: _time_text(c) for c in ("event_time", "last_updated")},
}


def _rows_sql(source: str, columns: tuple[str, ...], order: str, text: dict[str, str] = _TEXT) -> str:
    """SQL for the rows of a CTE as one list of structs, keys sorted, every value text."""
    fields = ", ".join(f"{c} := {text.get(c, c)}" for c in sorted(columns))
    return f"(SELECT coalesce(list(struct_pack({fields}) ORDER BY {order}), []) FROM {source})"


@query("dash_bronze_latest10", with_ctes(RAW_FEED, BRONZE, select=BRONZE_SQL))
def dash_bronze_latest10(spark, sf_dir):
    """SRT-1: newest 10 bronze rows by text order (two DESC keys; TakeOrderedAndProject)."""
    return dashboard.bronze_latest(bronze(spark, sf_dir))


BRONZE_TYPED_SQL = """SELECT source, asset_type, symbol, price, volume, event_time, ingestion_time, batch_id, source_file
FROM bronze ORDER BY TRY_CAST(ingestion_time AS TIMESTAMP) DESC NULLS LAST, TRY_CAST(event_time AS TIMESTAMP) DESC NULLS LAST,
         source NULLS FIRST, asset_type NULLS FIRST, symbol NULLS FIRST, price NULLS FIRST, volume NULLS FIRST,
         event_time NULLS FIRST, ingestion_time NULLS FIRST, batch_id NULLS FIRST, source_file NULLS FIRST LIMIT 10"""


@query("dash_bronze_latest10_typed", with_ctes(RAW_FEED, BRONZE, select=BRONZE_TYPED_SQL))
def dash_bronze_latest10_typed(spark, sf_dir):
    """SRT-1 (typed variant): newest 10 bronze rows by parsed instants instead of text."""
    return dashboard.bronze_latest_typed(bronze(spark, sf_dir))


@query("dash_summary10", with_ctes(*MARKET_CHAIN, LATEST, SUMMARY, select=SUMMARY10_SQL))
def dash_summary10(spark, sf_dir):
    """SRT-2: first 10 summary rows by asset type, symbol."""
    _, s = _gold(spark, sf_dir)
    return dashboard.summary_extract(market.gold_summary(s))


@query("dash_top_stock5", with_ctes(*MARKET_CHAIN, TOPK, select=_top_sql("stock")))
def dash_top_stock5(spark, sf_dir):
    """SRT-3: stock top-5 by rank."""
    _, s = _gold(spark, sf_dir)
    return dashboard.top_extract(market.top_for_type(s, "stock"))


@query("dash_top_crypto5", with_ctes(*MARKET_CHAIN, TOPK, select=_top_sql("crypto")))
def dash_top_crypto5(spark, sf_dir):
    """SRT-3: crypto top-5 by rank."""
    _, s = _gold(spark, sf_dir)
    return dashboard.top_extract(market.top_for_type(s, "crypto"))


TILES_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    f"s10 AS ({SUMMARY10_SQL})",
    f"b10 AS ({BRONZE_SQL})",
    select="SELECT CAST(count(*) AS BIGINT) AS asset_count, "
    "CAST(count_if(asset_type = 'stock') AS BIGINT) AS stock_count, "
    "CAST(count_if(asset_type = 'crypto') AS BIGINT) AS crypto_count, "
    "(SELECT CAST(count(*) AS BIGINT) FROM b10) AS batch_count FROM s10",
)


@query("agg_dashboard_tiles", TILES_SQL)
def agg_dashboard_tiles(spark, sf_dir):
    """AGG-8: header tiles counted over the exported extracts."""
    b, s = _gold(spark, sf_dir)
    return dashboard.tiles(dashboard.summary_extract(market.gold_summary(s)), dashboard.bronze_latest(b))


_TOPS = tuple(f"top_{t} AS ({_top_sql(t)})" for t in ("stock", "crypto"))


@query(
    "agg_collect_rows",
    with_ctes(
        *MARKET_CHAIN,
        TOPK,
        *_TOPS,
        select=" UNION ALL ".join(
            f"SELECT '{t}' AS asset_type, CAST(len(r) AS INT) AS n, CAST(to_json(r) AS VARCHAR) AS rows "
            f"FROM (SELECT {_rows_sql(f'top_{t}', dashboard.TOP_COLS, 'rank')} AS r)"
            for t in ("stock", "crypto")
        ),
    ),
)
def agg_collect_rows(spark, sf_dir):
    """AGG-9: each top-k extract as one ordered array of text-valued structs."""
    _, s = _gold(spark, sf_dir)
    parts = []
    for t, top in _top_tables(s).items():
        rows = dashboard.ordered_rows(dashboard.top_extract(top), [F.col("rank")])
        parts.append(rows.select(F.lit(t).alias("asset_type"), F.size("rows").alias("n"), F.to_json("rows").alias("rows")))
    return parts[0].unionByName(parts[1])


GENERATED_AT = "2031-02-03T04:06:07.000008+00:00"
TARGET, PRINCIPAL = "dev", "analyst@example.com"

_SUFFIX = f"substr(regexp_replace('{PRINCIPAL}', '[^a-z0-9_]', '_', 'g'), 1, 32) || '_' || substr(sha1('{PRINCIPAL}'), 1, 8)"
_BRONZE_ORDER = "ingestion_time DESC NULLS LAST, event_time DESC NULLS LAST, " + ", ".join(
    f"{c} NULLS FIRST" for c in dashboard.BRONZE_COLS if c not in ("ingestion_time", "event_time")
)
_TABLES = ", ".join(
    f"{key} := '{prefix}_{TARGET}_' || {_SUFFIX}"
    for key, prefix in sorted(zip(("bronze", "silver", "summary", "top_stocks", "top_crypto"), MARKET_TABLE_PREFIXES, strict=True))
    if key != "silver"
)
DOCUMENT_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    TOPK,
    *_TOPS,
    f"s10 AS ({SUMMARY10_SQL})",
    f"b10 AS ({BRONZE_SQL})",
    select=f"""SELECT CAST(to_json(struct_pack(
    bronze := struct_pack(latest_records := {_rows_sql("b10", dashboard.BRONZE_COLS, _BRONZE_ORDER, {})}),
    bundle_target := '{TARGET}', generated_at := '{GENERATED_AT}',
    gold := struct_pack(
      latest_summary := {_rows_sql("s10", dashboard.SUMMARY_COLS, "asset_type, symbol")},
      top_crypto_transactions := {_rows_sql("top_crypto", dashboard.TOP_COLS, "rank")},
      top_stock_transactions := {_rows_sql("top_stock", dashboard.TOP_COLS, "rank")}),
    principal := '{PRINCIPAL}', tables := struct_pack({_TABLES}))) AS VARCHAR) AS document""",
)


def dashboard_document(spark, sf_dir, bundle_target: str = TARGET, principal: str = PRINCIPAL):
    b, s = _gold(spark, sf_dir)
    s = materialize(s, "silver")
    top = _top_tables(s)
    tables = {k: v for k, v in market_table_names(bundle_target, principal).items() if k != "silver"}
    return dashboard.document(
        spark,
        b,
        market.gold_summary(s),
        top["stock"],
        top["crypto"],
        bundle_target=bundle_target,
        principal=principal,
        tables=tables,
        generated_at=GENERATED_AT,
    )


@query("snk_dashboard_json", DOCUMENT_SQL)
def snk_dashboard_json(spark, sf_dir):
    """SNK-4 / PIP-4: the whole nested dashboard document as one JSON text row."""
    return dashboard_document(spark, sf_dir)

