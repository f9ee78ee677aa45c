"""Column functions against small Python restatements of the per-record rules."""

from __future__ import annotations

from decimal import Decimal, InvalidOperation
from hashlib import sha1

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import functions as fn
from tidemark.sinks.writers import suffix_of


def _one(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def _py_decimal_text(v):
    try:
        d = Decimal(str(v).strip())
    except (InvalidOperation, TypeError):
        return None
    if not d.is_finite() or d <= 0:
        return None
    return format(d, "f")


def test_decimal_text_plain_forms(spark):
    vals = ["385.10", "34132320", " 2795.77064009 ", "+5.0", "0005.50", ".5", "5.", "0", "-1.5", "bad", "", None, "0.001",
            "100000000000000000000", "0.0000000000000000001", "1.50e3", "1.5e-3", "1E+2", "12.5e30", "0e5", "-1e3", "1e", "e5", ".", "5e-1"]
    got = _one(spark, fn.decimal_text, vals)
    assert got == [_py_decimal_text(v) if v is not None else None for v in vals]


@given(st.decimals(min_value=Decimal("0.000001"), max_value=Decimal("1e12"), places=6))
@settings(max_examples=30, deadline=None)
def test_decimal_text_property(spark, d):
    text = format(d, "f")
    assert _one(spark, fn.decimal_text, [text]) == [_py_decimal_text(text)]


def test_clean_number_and_bar_date(spark):
    assert _one(spark, fn.clean_number_text, ["$1,234.50", " 12,000 ", "7"]) == ["1234.50", "12000", "7"]
    assert _one(spark, fn.bar_date_iso, ["07/10/2026", "7/1/2026", "", "13/40/2026", None]) == [
        "2026-07-10T00:00:00+00:00", "2026-07-01T00:00:00+00:00", None, None, None]


def test_currency_and_compact(spark):
    vals = [1234.5, 999.994, 12.3, 0.0, -5.0, 1500000.0, 15456.499999999998]
    assert _one(spark, fn.currency_text, vals, "double") == [
        "$1,235", "$999.99", "$12.30", "$0.00", "-$5.00", "$1,500,000", "$15,456"]
    assert _one(spark, fn.compact_number, [1234.0, 999.0, 999999.0, 1500000.0, 2.5e9, 0.126, 3.2e12], "double") == [
        "1.23K", "999", "1M", "1.5M", "2.5B", "0.13", "3.2T"]
    assert _one(spark, fn.as_number, ["12", "x", None, "NaN", "Infinity", "1d", "2F", "-1.5e2", " 7. "]) == [
        12.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, -150.0, 7.0]


def test_display_date_and_type_label(spark):
    got = _one(spark, fn.display_date, ["2026-07-12T15:58:21.998Z", "", None, "garbage"])
    assert got == ["Jul 12, 03:58 PM", "Unknown", "Unknown", "garbage"]
    assert _one(spark, fn.type_label, ["stock", None]) == ["STOCK", ""]


@pytest.mark.parametrize(
    "target,principal",
    [("dev", "First.Last@Example.com"), ("Prod-EU", "a" * 40 + "@corp.example"), ("x", "ünïcode user")],
)
def test_tenant_suffix_matches_rule(spark, target, principal):
    df = spark.createDataFrame([(target, principal)], "t string, p string")
    got = df.select(fn.tenant_suffix("t", "p")).first()[0]
    letters = "abcdefghijklmnopqrstuvwxyz0123456789_"
    clean = lambda t: "".join(c if c in letters else "_" for c in t.lower())
    assert got == "_".join([clean(target), clean(principal)[:32], sha1(principal.encode()).hexdigest()[:8]])
    assert got == suffix_of(target, principal)


def test_try_parsers(spark):
    assert _one(spark, fn.try_double, ["1.5", "bad", None]) == [1.5, None, None]
    ts = _one(spark, lambda c: fn.try_timestamp(c).cast("timestamp_ntz").cast("string"),
              ["2026-07-12T15:58:21.998137659Z", "2026-07-10T00:00:00+00:00", "not a time"])
    assert ts == ["2026-07-12 15:58:21.998137", "2026-07-10 00:00:00", None]


def test_currency_text_is_whole(spark):
    text = _one(spark, fn.currency_text, [-1e60], "double")[0]
    assert text.startswith("-$1,000,000") and text.endswith(".00") and len(text) > 80


def test_long_exponents(spark):
    vals = ["1e99999", "1e100000", "7.50E+100000", "2e-0100000", "1e1000000", "1e1000001", "1e-1000001", "0e9999999", "1e99999999999999999999"]
    got = _one(spark, fn.decimal_text, vals)
    assert got[:2] == ["1" + "0" * 99_999, "1" + "0" * 100_000]
    assert got[2] == "75" + "0" * 99_999 and got[3] == "0." + "0" * 99_999 + "2" and len(got[4]) == 1_000_001
    assert got[5:] == [None] * 4
    far = _one(spark, fn.decimal_too_far, [*vals, "1e5", "bad", None, "-1e9999999", "12"])
    assert far == [False] * 5 + [True, True, False, True] + [False] * 5
