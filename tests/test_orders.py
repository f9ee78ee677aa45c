"""Orders pipeline on a small fixture: 4 bronze rows, 2 silver rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.fixtures import ORDERS_CSV
from tidemark.operators import quality as qa
from tidemark.plans import orders
from tidemark.schemas import BRONZE_ORDER_COLUMNS, ORDERS_SCHEMA, SILVER_ORDER_COLUMNS
from tidemark.sources import files

RUN_TS = "2031-02-03T15:00:00+00:00"


def _csv(tmp_path, text=ORDERS_CSV):
    p = tmp_path / "sample_orders.csv"
    p.write_text(text)
    return str(p)


def test_csv_bronze_silver(spark, tmp_path):
    bronze = orders.bronze(files.read_orders_csv(spark, _csv(tmp_path)), "sample_orders.csv", RUN_TS)
    silver = orders.silver(bronze)
    assert set(bronze.columns) == BRONZE_ORDER_COLUMNS and set(silver.columns) == SILVER_ORDER_COLUMNS
    assert bronze.count() == 4
    got = sorted((r["order_id"], r["amount"], r["amount_bucket"]) for r in silver.collect())
    assert got == [(7001, 12.25, "standard"), (7003, 50.0, "high")]
    checks = orders.validation(bronze, silver, expected_counts=(4, 2))
    assert qa.enforce(checks).count() == 9


def test_inline_rows_source(spark):
    rows = [(7001, "Ada", "complete", 12.25), (7002, "Ben", "pending", 77.0)]
    df = spark.createDataFrame(rows, ORDERS_SCHEMA)  # SRC-3
    assert orders.silver(orders.bronze(df, "inline", RUN_TS)).count() == 1


def test_failfast_on_bad_int(spark, tmp_path):
    bad = _csv(tmp_path, "order_id,customer,status,amount\nx1,A,complete,1.0\n")
    with pytest.raises(Exception):
        files.read_orders_csv(spark, bad).collect()


def test_validation_catches_bad_silver(spark, tmp_path):
    bronze = orders.bronze(files.read_orders_csv(spark, _csv(tmp_path)), "f", RUN_TS)
    bad_silver = orders.silver(bronze).withColumn("amount_bucket", F.lit("high")).unionByName(
        bronze.where("order_id = 7002").select(
            "order_id", "customer", "amount", F.lit("standard").alias("amount_bucket"), "source_file", "ingested_at_utc"
        )
    )
    res = {r["check"]: r["violations"] for r in orders.validation(bronze, bad_silver).collect()}
    assert res["bucket_rule"] == 1
    assert res["non_complete_status"] == 1
    assert res["key_set_equal"] == 1
    with pytest.raises(qa.DataQualityError):
        qa.enforce(orders.validation(bronze, bad_silver))


def test_order_ids_beyond_32_bits(spark, tmp_path):
    path = _csv(tmp_path, "order_id,customer,status,amount\n3000000000,Ada,complete,60.0\n")
    silver = orders.silver(orders.bronze(files.read_orders_csv(spark, path), "f", RUN_TS))
    assert [(r["order_id"], r["amount_bucket"]) for r in silver.collect()] == [(3_000_000_000, "high")]
