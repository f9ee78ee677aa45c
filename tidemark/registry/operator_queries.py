"""Single-operator queries over the market layers (FLT-*, AGG-2..7, SET-2, JON-2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.constants import ALLOWED_ASSET_TYPES, ALLOWED_SOURCES, VALUE_TOLERANCE
from tidemark.functions import positive_finite
from tidemark.operators import quality as qa
from tidemark.operators.lineage import materialize
from tidemark.plans import market
from tidemark.registry import query
from tidemark.registry.market_queries import bronze, silver
from tidemark.registry.sql import BRONZE, LATEST, MARKET_CHAIN, RAW_FEED, STD, SUMMARY, TOPK, with_ctes

STD_CHAIN = (RAW_FEED, BRONZE, STD)


def std(spark, sf_dir) -> DataFrame:
    return market.standardize(bronze(spark, sf_dir))


# ---- filters --------------------------------------------------------------------------


@query(
    "flt_allowed_values",
    with_ctes(
        *STD_CHAIN,
        select="SELECT event_id, source, asset_type FROM std "
        "WHERE source IN ('nasdaq','coinbase') AND asset_type IN ('stock','crypto')",
    ),
)
def flt_allowed_values(spark, sf_dir):
    """FLT-2: IN-lists on the standardised vocabularies."""
    return std(spark, sf_dir).where(
        F.col("source").isin(*ALLOWED_SOURCES) & F.col("asset_type").isin(*ALLOWED_ASSET_TYPES)
    ).select("event_id", "source", "asset_type")


@query(
    "flt_disallowed_values",
    with_ctes(
        *STD_CHAIN,
        select="SELECT event_id, source, asset_type FROM std "
        "WHERE source NOT IN ('nasdaq','coinbase') OR asset_type NOT IN ('stock','crypto')",
    ),
)
def flt_disallowed_values(spark, sf_dir):
    """FLT-3: NOT IN-lists (a NULL value is not counted)."""
    return std(spark, sf_dir).where(
        ~F.col("source").isin(*ALLOWED_SOURCES) | ~F.col("asset_type").isin(*ALLOWED_ASSET_TYPES)
    ).select("event_id", "source", "asset_type")


@query(
    "flt_nonempty_symbol",
    with_ctes(*STD_CHAIN, select="SELECT event_id, symbol FROM std WHERE symbol IS NOT NULL AND symbol <> ''"),
)
def flt_nonempty_symbol(spark, sf_dir):
    """FLT-4: not NULL and not empty after trimming."""
    s = F.col("symbol")
    return std(spark, sf_dir).where(s.isNotNull() & (s != "")).select("event_id", "symbol")


@query(
    "flt_positive_numeric",
    with_ctes(
        *STD_CHAIN,
        select="SELECT event_id, price, volume FROM std WHERE price IS NOT NULL AND price > 0 AND isfinite(price) "
        "AND volume IS NOT NULL AND volume > 0 AND isfinite(volume)",
    ),
)
def flt_positive_numeric(spark, sf_dir):
    """FLT-5: parsed numbers present, positive and finite."""
    return std(spark, sf_dir).where(positive_finite("price") & positive_finite("volume")).select(
        "event_id", "price", "volume"
    )


@query(
    "flt_valid_event_time",
    with_ctes(*STD_CHAIN, select="SELECT event_id, event_time FROM std WHERE event_time IS NOT NULL"),
)
def flt_valid_event_time(spark, sf_dir):
    """FLT-6: the parsed timestamp is not NULL."""
    return std(spark, sf_dir).where(F.col("event_time").isNotNull()).select("event_id", "event_time")


@query(
    "flt_tolerance",
    with_ctes(
        *MARKET_CHAIN,
        TOPK,
        select=f"""SELECT symbol, asset_type, rank,
       abs(transaction_value - price * volume) > {VALUE_TOLERANCE} AS out_of_tolerance,
       abs(round(transaction_value, 0) - transaction_value) > {VALUE_TOLERANCE} AS not_whole_dollars
FROM topk""",
    ),
)
def flt_tolerance(spark, sf_dir):
    """FLT-10 / FN-5: ``abs(a - b) > 1e-4`` tests on the top-k values."""
    top = market.top_transactions(silver(spark, sf_dir))
    tv = F.col("transaction_value")
    return top.select(
        "symbol",
        "asset_type",
        "rank",
        (F.abs(tv - F.col("price") * F.col("volume")) > VALUE_TOLERANCE).alias("out_of_tolerance"),
        (F.abs(F.round(tv, 0) - tv) > VALUE_TOLERANCE).alias("not_whole_dollars"),
    )


# ---- aggregates -----------------------------------------------------------------------


@query(
    "agg_group_count",
    with_ctes(
        *MARKET_CHAIN,
        select="SELECT asset_type, source, CAST(count(*) AS BIGINT) AS count FROM silver GROUP BY asset_type, source",
    ),
)
def agg_group_count(spark, sf_dir):
    """AGG-2: ``groupBy(k).count()``."""
    return silver(spark, sf_dir).groupBy("asset_type", "source").count()


@query(
    "agg_duplicate_keys",
    with_ctes(
        *STD_CHAIN,
        select="SELECT batch_id, symbol, event_time, CAST(count(*) AS BIGINT) AS count FROM std "
        "GROUP BY batch_id, symbol, event_time HAVING count(*) > 1",
    ),
)
def agg_duplicate_keys(spark, sf_dir):
    """AGG-3: key tuples seen more than once before dedup (HAVING count > 1)."""
    return qa.duplicate_key_groups(std(spark, sf_dir), ["batch_id", "symbol", "event_time"])


LAYER_COUNT_SQL = with_ctes(
    *MARKET_CHAIN,
    LATEST,
    SUMMARY,
    TOPK,
    select="""SELECT 'bronze' AS layer, CAST(count(*) AS BIGINT) AS row_count FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_summary', count(*) FROM summary
UNION ALL SELECT 'gold_top_stock', count(*) FROM topk WHERE asset_type = 'stock'
UNION ALL SELECT 'gold_top_crypto', count(*) FROM topk WHERE asset_type = 'crypto'""",
)


@query("agg_layer_counts", LAYER_COUNT_SQL)
def agg_layer_counts(spark, sf_dir):
    """AGG-4: global row count of every layer, one row per layer."""
    b = bronze(spark, sf_dir)
    s = materialize(market.silver(b))
    layers = {
        "bronze": b,
        "silver": s,
        "gold_summary": market.gold_summary(s),
        "gold_top_stock": market.top_for_type(s, "stock"),
        "gold_top_crypto": market.top_for_type(s, "crypto"),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("layer"), "row_count") for n, df in layers.items()]
    return reduce(DataFrame.unionByName, parts)


@query(
    "qa_metrics_one_pass",
    with_ctes(
        *STD_CHAIN,
        select="""SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(count_if(source IS NULL OR asset_type IS NULL OR symbol IS NULL OR price IS NULL OR volume IS NULL
       OR event_time IS NULL OR ingestion_time IS NULL OR batch_id IS NULL) AS BIGINT) AS null_required,
  CAST(count_if(source NOT IN ('nasdaq','coinbase')) AS BIGINT) AS invalid_source,
  CAST(count_if(asset_type NOT IN ('stock','crypto')) AS BIGINT) AS invalid_asset_type,
  CAST(count_if(price <= 0 OR volume <= 0) AS BIGINT) AS invalid_numeric,
  CAST(count_if(symbol IS NULL OR symbol = '') AS BIGINT) AS blank_symbol
FROM std""",
    ),
)
def qa_metrics_one_pass(spark, sf_dir):
    """AGG-5: all conditional counts of the standardised layer in one aggregate."""
    s = std(spark, sf_dir)
    rules = {
        "null_required": qa.any_null(["source", "asset_type", "symbol", "price", "volume", "event_time", "ingestion_time", "batch_id"]),
        "invalid_source": ~F.col("source").isin(*ALLOWED_SOURCES),
        "invalid_asset_type": ~F.col("asset_type").isin(*ALLOWED_ASSET_TYPES),
        "invalid_numeric": (F.col("price") <= 0) | (F.col("volume") <= 0),
        "blank_symbol": F.col("symbol").isNull() | (F.col("symbol") == ""),
    }
    return s.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()],
    )


@query(
    "agg_scalar",
    with_ctes(
        *MARKET_CHAIN,
        select="SELECT symbol, asset_type, price, event_time FROM silver "
        "WHERE event_time = (SELECT max(event_time) FROM silver)",
    ),
)
def agg_scalar(spark, sf_dir):
    """AGG-7: a scalar subquery (latest event time) used as a filter value.

    The subquery is a single value computed by its own small job and
    broadcast into the filter, so nothing but one scalar crosses the driver.
    """
    s = materialize(silver(spark, sf_dir).select("symbol", "asset_type", "price", "event_time"), "agg-scalar")
    latest = s.select(F.max("event_time")).scalar()
    return s.where(F.col("event_time") == latest).select("symbol", "asset_type", "price", "event_time")


# ---- sets and key-set joins -----------------------------------------------------------


@query(
    "set_key_except",
    with_ctes(
        *MARKET_CHAIN,
        select="""SELECT 'dropped' AS side, symbol FROM (
  SELECT symbol FROM std WHERE symbol IS NOT NULL AND symbol <> '' EXCEPT SELECT symbol FROM silver)
UNION ALL SELECT 'invented' AS side, symbol FROM (
  SELECT symbol FROM silver EXCEPT SELECT symbol FROM std)""",
    ),
)
def set_key_except(spark, sf_dir):
    """SET-2: distinct-key difference both ways (``subtract`` = EXCEPT DISTINCT).

    Symbols that cleaning dropped entirely, and (never expected) symbols that
    silver holds but the standardised bronze does not.
    """
    b = std(spark, sf_dir).where(F.col("symbol").isNotNull() & (F.col("symbol") != "")).select("symbol")
    s = std(spark, sf_dir).where(market.silver_predicate()).select("symbol")  # dedup cannot change the set
    dropped = b.subtract(s).select(F.lit("dropped").alias("side"), "symbol")
    invented = s.subtract(std(spark, sf_dir).select("symbol")).select(F.lit("invented").alias("side"), "symbol")
    return dropped.unionByName(invented)


@query(
    "join_key_set_diff",
    with_ctes(
        *MARKET_CHAIN,
        select="""SELECT 'missing' AS side, batch_id, symbol FROM (
  SELECT DISTINCT batch_id, symbol FROM std e
  WHERE source IN ('nasdaq','coinbase') AND asset_type IN ('stock','crypto')
    AND NOT EXISTS (SELECT 1 FROM silver a WHERE a.batch_id IS NOT DISTINCT FROM e.batch_id
                                           AND a.symbol IS NOT DISTINCT FROM e.symbol))
UNION ALL
SELECT 'unexpected' AS side, batch_id, symbol FROM (
  SELECT DISTINCT batch_id, symbol FROM silver a
  WHERE NOT EXISTS (SELECT 1 FROM std e WHERE e.source IN ('nasdaq','coinbase')
                      AND e.asset_type IN ('stock','crypto')
                      AND a.batch_id IS NOT DISTINCT FROM e.batch_id
                      AND a.symbol IS NOT DISTINCT FROM e.symbol))""",
    ),
)
def join_key_set_diff(spark, sf_dir):
    """JON-2: (batch_id, symbol) keys of allowed-vocabulary bronze vs silver, both ways, in one grouping."""
    e = std(spark, sf_dir).where(
        F.col("source").isin(*ALLOWED_SOURCES) & F.col("asset_type").isin(*ALLOWED_ASSET_TYPES)
    )
    # the dedup of silver cannot change a set of keys
    a = std(spark, sf_dir).where(market.silver_predicate())
    return qa.key_set_diff(e, a, ["batch_id", "symbol"])
