"""The landing schema, kept on file, and the rescue of what it does not know.

``schemas/version=N`` under a landing area holds the schema that lines are read
with, as one JSON text.  A field that the schema does not name, and a value
that does not have its field's type, are kept as text in a ``_rescued`` column
(a JSON object, keys sorted), and a line that is no JSON object is kept whole,
so nothing that landed is lost and no stream stops over it.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RESCUED = "_rescued"


def save_schema(spark: SparkSession, schema: StructType, folder: str) -> int:
    """Write ``schema`` as the next version; unchanged schemas get none.  Returns the version in force."""
    version, held = stored_schema(spark, folder)
    if held == schema:
        return version
    text = spark.createDataFrame([(schema.json(),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{folder}/version={version + 1}")
    return version + 1


def stored_schema(spark: SparkSession, folder: str) -> tuple[int, StructType | None]:
    """The newest version and its schema; ``(0, None)`` where there is none."""
    try:
        newest = spark.read.text(folder).orderBy(F.col("version").desc()).first()
    except AnalysisException:
        newest = None
    return (newest["version"], StructType.fromJson(json.loads(newest["value"]))) if newest else (0, None)


def rescued(line: Column, typed: Column, schema: StructType) -> Column:
    """What ``typed`` (``line`` read under ``schema``) does not hold, as JSON text; NULL if it holds everything."""
    whole = F.from_json(line, "map<string,string>")
    names = [f.name for f in schema.fields]
    unknown = F.map_filter(whole, lambda k, v: ~k.isin(*names))
    lost = [
        F.struct(F.lit(n).alias("key"), F.when(typed[n].isNull(), F.try_element_at(whole, F.lit(n))).alias("value")) for n in names
    ]
    retyped = F.filter(F.array(*lost), lambda e: e["value"].isNotNull())
    entries = F.array_sort(F.concat(F.map_entries(unknown), retyped))
    found = F.when(F.size(entries) > 0, F.to_json(F.map_from_entries(entries), {"ignoreNullFields": "false"}))
    broken = whole.isNull() | (F.map_contains_key(whole, F.lit("")) & (F.size(whole) == 0))
    return F.when(broken, line).otherwise(found)


def parse_landed(lines: DataFrame, schema: StructType, *keep: Column) -> DataFrame:
    """Landed text lines (column ``value``) under ``schema``, with ``_rescued`` and the columns to keep."""
    typed = F.from_json("value", schema)
    bound = lines.select("value", typed.alias("typed"), *keep)
    kept = [c for c in bound.columns if c not in ("value", "typed")]
    fields = [F.col(f"typed.{f.name}").alias(f.name) for f in schema.fields]
    return bound.select(*fields, rescued(F.col("value"), F.col("typed"), schema).alias(RESCUED), *kept)
