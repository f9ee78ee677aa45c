"""Sinks and table maintenance (SNK-1..6).

Tables are parquet catalog tables (the Delta provider is not available in
this runtime).  Writes replace a table's data *and* schema, as the
reference's ``overwriteSchema`` writes do, but never in place: the new rows
are complete before the name leads to them, so a write that fails leaves the
old version readable.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.constants import MARKET_TABLE_PREFIXES, ORDER_TABLE_PREFIXES
from tidemark.functions import tenant_suffix
from tidemark.session import shared_root, staging_path

#: Database of the tables that registered queries create.
STAGING_DATABASE = "tidemark_staging"


def overwrite_table(df: DataFrame, name: str, bucket_by: tuple[int, Sequence[str]] | None = None) -> str:
    """SNK-1: replace the managed table ``name``, data and schema.

    The rows are written to a managed table beside it, which then takes the
    name over; until then the old version stays as it is.
    ``bucket_by=(n, keys)`` writes ``n`` buckets hashed and sorted on
    ``keys``: two tables bucketed alike join on those keys with no shuffle.
    Use it only for key columns (unique or near-unique): a hot key would sit
    in one bucket and so in one task.  A table may not be overwritten while
    the same plan reads it; callers write each layer to a different table,
    as the reference does.
    """
    spark = df.sparkSession
    following = f"{name}__{uuid.uuid4().hex[:8]}"
    writer = df.write.mode("overwrite").format("parquet")
    if bucket_by is not None:
        n, keys = bucket_by
        writer = writer.bucketBy(n, *keys).sortBy(*keys)
    try:
        writer.saveAsTable(following)
    except Exception:
        drop_tables(spark, [following])
        raise
    drop_tables(spark, [name])
    spark.sql(f"ALTER TABLE {following} RENAME TO {name}")
    return name


def publish_version(df: DataFrame, name: str, root: str) -> str:
    """SNK-1 for tables that are read while they are renewed: a new version at a new place under ``root``.

    The external table ``name`` is moved there with one catalog change once
    all rows are written; readers that have begun go on with the version they
    planned.  Versions are kept; expire them with the folder's retention.
    """
    spark = df.sparkSession
    place = f"{root}/version-{uuid.uuid4().hex}"
    df.write.mode("error").parquet(place)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{place}'")
    else:  # another schema: the definition is replaced, the files of the old version stay
        drop_tables(spark, [name])
        spark.catalog.createTable(name, path=place, source="parquet", schema=df.schema)
    spark.catalog.refreshTable(name)
    return place


def split_by_value(df: DataFrame, column: str, targets: dict[str, str]) -> list[str]:
    """SNK-2: one managed table per value of ``column``, from a single run of ``df``.

    The rows are written once, partitioned by the value; each table is then
    made from its partition alone, so what ``df`` costs is paid once however
    many tables there are.  A value without rows gives an empty table.
    """
    spark = df.sparkSession
    key = "_split_key"
    whole = staging_path(spark, "split")
    df.where(F.col(column).isin(*targets)).withColumn(key, F.col(column)).write.partitionBy(key).parquet(whole)
    rows = spark.read.schema(df.withColumn(key, F.col(column)).schema).parquet(whole)
    return [overwrite_table(rows.where(F.col(key) == value).drop(key), table) for value, table in targets.items()]


def staging_table(spark: SparkSession, prefix: str) -> str:
    """A new name in a database whose managed tables lie under the shared folder."""
    place = f"{shared_root(spark)}/tidemark-staging/warehouse"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING_DATABASE} LOCATION '{place}'")
    return f"{STAGING_DATABASE}.{prefix}_{uuid.uuid4().hex[:12]}"


def write_jsonl(df: DataFrame, path: str, sort_keys: bool = True) -> str:
    """SNK-3: JSON lines, one object per line, keys in sorted order.

    Written in parallel as part files under ``path`` (a directory); the
    parent directories are created by the writer.
    """
    cols = sorted(df.columns) if sort_keys else df.columns
    df.select(*cols).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV in parallel part files (input for SRC-2 round trips)."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def drop_tables(spark: SparkSession, names: Iterable[str]) -> list[str]:
    """SNK-5: ``DROP TABLE IF EXISTS`` for each name; the rows of a managed table go with it."""
    dropped = []
    for name in names:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": name})
        dropped.append(name)
    return dropped


def table_states(spark: SparkSession, names: Sequence[str]) -> DataFrame:
    """SNK-5: ``(name, state)`` of each name by the catalog's own listing: ``present`` or ``dropped``."""
    database = names[0].rpartition(".")[0] if names else ""
    listed = spark.sql(f"SHOW TABLES IN {database}" if database else "SHOW TABLES")
    asked = spark.createDataFrame([(n, n.rpartition(".")[2].lower()) for n in names], "name string, tableName string")
    found = asked.join(listed.select("tableName", F.lit(True).alias("there")), "tableName", "left")
    return found.select("name", F.when(F.col("there"), "present").otherwise("dropped").alias("state"))


# ---- naming ------------------------------------------------------------------------------


def suffix_of(bundle_target: str, principal: str) -> str:
    """SNK-6 for one tenant: :func:`tidemark.functions.tenant_suffix` over one row."""
    one = SparkSession.active().range(1)
    return one.select(tenant_suffix(F.lit(bundle_target), F.lit(principal))).first()[0]


def current_principal(spark: SparkSession) -> str:
    """FN-7 / AGG-7: ``current_user()`` as a scalar (error when no row comes back)."""
    row = spark.sql("SELECT current_user() AS current_user").first()
    if row is None:
        raise RuntimeError("current_user() returned no rows")
    return str(row[0])


def market_table_names(bundle_target: str, principal: str) -> dict[str, str]:
    suffix = suffix_of(bundle_target, principal)
    keys = ("bronze", "silver", "summary", "top_stocks", "top_crypto")
    return {k: f"{p}_{suffix}" for k, p in zip(keys, MARKET_TABLE_PREFIXES)}


def checks_table_name(names: dict[str, str]) -> str:
    """Where the market job keeps the checks taken while it wrote the tables ``names``."""
    return f"checks_{names['silver']}"


def order_table_names(bundle_target: str, principal: str) -> dict[str, str]:
    suffix = suffix_of(bundle_target, principal)
    return {k: f"{p}_{suffix}" for k, p in zip(("bronze", "silver"), ORDER_TABLE_PREFIXES)}
