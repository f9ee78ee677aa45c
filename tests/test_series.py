"""The skew-split series window equals the plain per-key window (property test)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators.series import rows_window

ROW = st.tuples(
    st.sampled_from(["HOT", "HOT", "HOT", "A", "B"]),  # one key holds most rows
    st.one_of(st.integers(min_value=0, max_value=10 * 24 * 60), st.integers(min_value=600, max_value=610)),  # minute; a hot hour
    st.floats(min_value=1, max_value=100, allow_nan=False).map(lambda x: round(x, 2)),
)


@given(
    rows=st.lists(ROW, min_size=1, max_size=60),
    n=st.integers(min_value=1, max_value=6),
    target=st.sampled_from([1, 2, 3, 1_000_000]),  # small targets slice hot key-days into many buckets
)
@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_rows_window_matches_plain_window(spark, rows, n, target):
    base = dt.datetime(2026, 7, 1)
    data = [(k, base + dt.timedelta(minutes=m), i, p) for i, (k, m, p) in enumerate(rows)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long, price double")
    cols = {
        "prev": lambda spec: F.lag("price", 1).over(spec),
        "back_n": lambda spec: F.lag("price", n).over(spec),
        "roll_sum": lambda spec: F.sum("price").over(spec.rowsBetween(-n, -1)),
        "roll_cnt": lambda spec: F.count("price").over(spec.rowsBetween(-n, 0)),
    }
    got = rows_window(df, "symbol", ("event_time", "event_id"), n, cols, target_rows=target)
    spec = Window.partitionBy("symbol").orderBy("event_time", "event_id")
    want = df.select("*", *[f(spec).alias(k) for k, f in cols.items()])
    key = lambda r: r["event_id"]
    g = sorted(got.collect(), key=key)
    w = sorted(want.collect(), key=key)
    assert len(g) == len(w)
    for a, b in zip(g, w):
        assert a["prev"] == b["prev"] and a["back_n"] == b["back_n"] and a["roll_cnt"] == b["roll_cnt"]
        assert (a["roll_sum"] is None and b["roll_sum"] is None) or abs(a["roll_sum"] - b["roll_sum"]) < 1e-9


def buckets(df, target, order=("event_time", "event_id")):
    from tidemark.operators.series import bucket_sizes, day_buckets, quantile_buckets

    days = day_buckets(df, "event_time")
    return quantile_buckets(days, bucket_sizes(days, "symbol"), "symbol", order, target)


def check_buckets(df, target):
    """Counted sizes are the stated ones, none above the target, and buckets follow the window's order."""
    from tidemark.operators.series import BUCKET

    rows, sizes = buckets(df, target)
    held = {(r[0], r[1]): r[2] for r in rows.groupBy("symbol", BUCKET).count().collect()}
    assert held == {(r["symbol"], r[BUCKET]): r["_c"] for r in sizes.collect()}
    assert max(held.values()) <= target
    places = sorted((str(r["symbol"]), r["event_time"], r["event_id"], r[BUCKET]) for r in rows.collect())
    for a, b in zip(places, places[1:], strict=False):
        assert a[0] != b[0] or a[3] <= b[3]
    return held


def test_hot_key_day_is_cut_at_quantiles(spark):
    base = dt.datetime(2026, 7, 1)
    data = [("HOT", base + dt.timedelta(seconds=i), i) for i in range(1000)] + [("A", base, 5000)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long").repartition(3)
    held = check_buckets(df, 100)
    assert sorted(n for (s, _), n in held.items() if s == "HOT") == [100] * 10


def test_most_ticks_at_one_instant(spark):
    """9,000 of 10,000 ticks at noon, the others spread over the day."""
    base, noon = dt.datetime(2026, 7, 1), dt.datetime(2026, 7, 1, 12)
    data = [("HOT", noon if i % 10 else base + dt.timedelta(seconds=8 * i), i) for i in range(10_000)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long").repartition(5)
    assert sorted(check_buckets(df, 2000).values()) == [2000] * 5
    cols = {"prev": lambda spec: F.lag("event_id", 2).over(spec)}
    got = rows_window(df, "symbol", ("event_time", "event_id"), 2, cols, target_rows=2000)
    want = df.withColumn("prev", F.lag("event_id", 2).over(Window.partitionBy("symbol").orderBy("event_time", "event_id")))
    assert {r["event_id"]: r["prev"] for r in got.collect()} == {r["event_id"]: r["prev"] for r in want.collect()}


def test_rows_of_cold_days_are_not_written(spark, monkeypatch):
    from tidemark.operators import ranking, series

    written = []
    for module in (ranking, series):
        monkeypatch.setattr(module, "materialize", lambda df, name: written.append((name, df.count())) or df.cache())
    base = dt.datetime(2026, 7, 1)
    data = [("HOT", base + dt.timedelta(seconds=i), i) for i in range(300)] + [("A", base + dt.timedelta(days=i), 1000 + i) for i in range(500)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long")
    cols = {"prev": lambda spec: F.lag("event_id", 1).over(spec)}
    rows_window(df, "symbol", ("event_time", "event_id"), 1, cols, target_rows=100).count()
    assert dict(written) == {"series-sizes": 501, "ranked": 300}
    written.clear()
    rows_window(df, "symbol", ("event_time", "event_id"), 1, cols).count()
    assert dict(written) == {"series-sizes": 501}


def test_staged_windows_match_plain(spark):
    base = dt.datetime(2026, 7, 1)
    data = [("HOT", base + dt.timedelta(minutes=7 * i), i, float(i % 13) + 1) for i in range(400)]
    data += [("A", base + dt.timedelta(hours=i), 1000 + i, float(i) + 1) for i in range(30)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long, price double")
    stages = [
        {"d": lambda spec: F.col("price") - F.lag("price", 1).over(spec)},
        {"s": lambda spec: F.sum("d").over(spec.rowsBetween(-3, 0))},
    ]
    got = rows_window(df, "symbol", ("event_time", "event_id"), 4, stages, target_rows=25)
    spec = Window.partitionBy("symbol").orderBy("event_time", "event_id")
    want = df.withColumn("d", F.col("price") - F.lag("price", 1).over(spec)).withColumn(
        "s", F.sum("d").over(spec.rowsBetween(-3, 0))
    )
    g = {r["event_id"]: (r["d"], r["s"]) for r in got.collect()}
    w = {r["event_id"]: (r["d"], r["s"]) for r in want.collect()}
    assert g == w


def test_missing_keys_and_times_are_as_in_a_plain_window(spark):
    at = dt.datetime(2026, 7, 1)
    data = [(None, at, 1), (None, at + dt.timedelta(days=2), 2), ("A", None, 3), ("A", at, 4), ("A", None, 5)]
    df = spark.createDataFrame(data, "symbol string, event_time timestamp, event_id long")
    cols = {"prev": lambda spec: F.lag("event_id", 1).over(spec)}
    got = rows_window(df, "symbol", ("event_time", "event_id"), 2, cols, target_rows=1)
    want = df.withColumn("prev", F.lag("event_id", 1).over(Window.partitionBy("symbol").orderBy("event_time", "event_id")))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
