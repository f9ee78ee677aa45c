"""The landing schema on file and the rescue of unknown and retyped fields."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.sources.landing import RESCUED, parse_landed, save_schema, stored_schema
from tidemark.streaming import market_stream as ms

SCHEMA = StructType([StructField("symbol", StringType()), StructField("event_id", LongType())])


def test_schema_versions(spark, tmp_path):
    folder = str(tmp_path / "schemas")
    assert stored_schema(spark, folder) == (0, None)
    assert save_schema(spark, SCHEMA, folder) == 1 == save_schema(spark, SCHEMA, folder)
    wider = StructType([*SCHEMA.fields, StructField("venue", StringType())])
    assert save_schema(spark, wider, folder) == 2 and stored_schema(spark, folder) == (2, wider)


def test_nothing_that_landed_is_lost(spark):
    lines = {
        '{"symbol":"A","event_id":1}': ("A", 1, None),
        '{"symbol":"A","event_id":"x7","zone":"z","b":[1,{"c":2}]}': ("A", None, {"event_id": "x7", "zone": "z", "b": '[1,{"c":2}]'}),
        '{"event_id":2.5}': (None, None, {"event_id": "2.5"}),
        '{"symbol":null,"event_id":3}': (None, 3, None),
        "{}": (None, None, None),
        '{"symbol":"cut of': (None, None, '{"symbol":"cut of'),
        "not json": (None, None, "not json"),
    }
    got = parse_landed(spark.createDataFrame([(t,) for t in lines], "value string"), SCHEMA, F.col("value").alias("line"))
    for r in got.collect():
        symbol, event_id, kept = lines[r["line"]]
        assert (r["symbol"], r["event_id"]) == (symbol, event_id), r
        if isinstance(kept, dict):
            assert json.loads(r[RESCUED]) == kept and list(json.loads(r[RESCUED])) == sorted(kept)
        else:
            assert r[RESCUED] == kept, r


def test_stream_needs_a_schema_on_file(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        ms.read_landing_stream(spark, str(tmp_path / "landing"), str(tmp_path / "schemas"))
