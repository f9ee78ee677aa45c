"""Registry of named queries and their DuckDB oracle SQL.

Each query is a callable ``(spark, sf_dir) -> DataFrame`` over the driver's
tables (through :mod:`tidemark.sources.bindings`).  Its oracle, when the
semantics are SQL-expressible, is an independent DuckDB statement over the
same parquet files; ``tools/oracle_check.py`` and the driver compare the two.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def for_compare(df: DataFrame) -> DataFrame:
    """Render session-zone timestamps as UTC wall-clock (``timestamp_ntz``), as DuckDB does."""
    cols = [
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType) else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def query(name: str, oracle: str | None = None) -> Callable[[QueryFn], QueryFn]:
    """Register ``fn`` under ``name`` (and its oracle SQL, if any)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query name {name}")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return for_compare(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def load_all() -> None:
    """Import every query module so the registry is complete."""
    from tidemark.registry import (  # noqa: F401
        analytics_queries,
        dashboard_queries,
        feed_queries,
        function_queries,
        market_queries,
        operator_queries,
        orders_queries,
        quality_queries,
        sink_queries,
        source_queries,
        stream_queries,
    )
