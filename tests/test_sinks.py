"""Tables that are overwritten, split, published and dropped."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import writers


def _place(spark, name):
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
    return next(r["data_type"] for r in rows if r["col_name"] == "Location").removeprefix("file:")


def test_managed_tables_lie_under_the_shared_folder_and_go_with_the_drop(spark):
    from tidemark.session import shared_root

    name = writers.staging_table(spark, "t")
    writers.overwrite_table(spark.range(5), name)
    place = _place(spark, name)
    assert place.startswith(shared_root(spark)) and os.path.isdir(place)
    assert writers.table_states(spark, [name]).first()["state"] == "present"
    writers.overwrite_table(spark.range(3).selectExpr("id AS other", "'x' AS text"), name)
    assert spark.table(name).columns == ["other", "text"] and spark.table(name).count() == 3
    writers.drop_tables(spark, [name, name])
    assert not os.path.exists(place) and writers.table_states(spark, [name]).first()["state"] == "dropped"


def test_a_failed_overwrite_leaves_the_old_version(spark, tmp_path):
    broken = spark.range(4).select(F.udf(lambda i: 1 // (i - 2), "long")("id").alias("id"))
    name = writers.staging_table(spark, "kept")
    writers.overwrite_table(spark.range(5), name)
    with pytest.raises(Exception, match="ZeroDivisionError"):
        writers.overwrite_table(broken, name)
    assert spark.table(name).count() == 5
    listed = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {writers.STAGING_DATABASE}").collect()]
    assert [t for t in listed if t.startswith(name.rpartition(".")[2])] == [name.rpartition(".")[2]]
    published = writers.staging_table(spark, "published")
    writers.publish_version(spark.range(5), published, str(tmp_path / "v"))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        writers.publish_version(broken, published, str(tmp_path / "v"))
    assert spark.table(published).count() == 5


def test_a_published_version_is_a_new_place(spark, tmp_path):
    name, root = writers.staging_table(spark, "summary"), str(tmp_path / "v")
    first = writers.publish_version(spark.range(5), name, root)
    begun = spark.table(name)
    assert begun.count() == 5
    second = writers.publish_version(spark.range(7), name, root)
    assert first != second and _place(spark, name) == second
    assert spark.table(name).count() == 7 and spark.read.parquet(first).count() == 5
    writers.publish_version(spark.range(2).withColumn("more", F.lit("x")), name, root)
    assert spark.table(name).columns == ["id", "more"] and spark.table(name).count() == 2


def test_a_split_runs_its_input_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def seen(v):
        calls.add(1)
        return v

    rows = spark.range(10).select(F.when(F.col("id") < 7, "a").otherwise("b").alias("kind"), F.udf(seen, "long")("id").alias("id"))
    names = {k: writers.staging_table(spark, f"split_{k}") for k in ("a", "b", "none")}
    writers.split_by_value(rows, "kind", names)
    assert calls.value == 10
    assert [spark.table(names[k]).count() for k in names] == [7, 3, 0]
    assert spark.table(names["none"]).columns == ["kind", "id"]
