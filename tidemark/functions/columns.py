"""Column expressions used across the pipeline.

Every helper takes and returns a ``Column`` built from
``pyspark.sql.functions``. They run inside whole-stage codegen, with no
Python UDFs. Parsing never raises under ANSI mode: every conversion uses the
``try_*`` family, so bad input becomes NULL and is filtered or rejected by
the caller.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.constants import (
    COMPACT_STEPS,
    NAME_SANITISE_PATTERN,
    PRINCIPAL_HASH_LEN,
    PRINCIPAL_KEY_LEN,
)

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---- text -------------------------------------------------------------------------------


def lower_trim(col: ColumnOrName) -> Column:
    """FN-1: ``lower(trim(x))``; ``trim`` removes spaces only (as in the silver layer)."""
    return F.lower(F.trim(_c(col)))


def upper_trim(col: ColumnOrName) -> Column:
    """FN-2: ``upper(trim(x))``."""
    return F.upper(F.trim(_c(col)))


def strip_ws(col: ColumnOrName) -> Column:
    """Strip every kind of leading/trailing whitespace (Python ``str.strip``)."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def normalize_text(col: ColumnOrName, case: str = "lower") -> Column:
    """FN-13: missing → ``""``, whitespace stripped, case folded."""
    stripped = strip_ws(F.coalesce(_c(col).cast("string"), F.lit("")))
    if case == "lower":
        return F.lower(stripped)
    if case == "upper":
        return F.upper(stripped)
    return stripped


def type_label(col: ColumnOrName) -> Column:
    """FN-20: upper-case label, NULL → ``""``."""
    return F.upper(F.coalesce(_c(col).cast("string"), F.lit("")))


# ---- numbers ----------------------------------------------------------------------------


def try_double(col: ColumnOrName) -> Column:
    """FN-3: text → DOUBLE, unparsable → NULL (no ANSI error)."""
    return _c(col).try_cast("double")


def is_finite(col: ColumnOrName) -> Column:
    """True for real numbers; NaN and ±Infinity are false, NULL stays NULL."""
    return F.abs(_c(col)) < F.lit(float("inf"))


def positive_finite(col: ColumnOrName) -> Column:
    """FLT-5 plus the documented finite check (plain ``> 0`` would admit NaN/Infinity).

    ``0 < x < +inf`` is false for NULL (unknown), NaN (Spark orders NaN above
    +inf) and ±Infinity, so a filter on it keeps exactly the positive finite
    values, with two evaluations of ``x`` instead of three.
    """
    c = _c(col)
    return (c > 0) & (c < F.lit(float("inf")))


def clean_number_text(col: ColumnOrName) -> Column:
    """FN-10: drop ``$`` and ``,`` then strip whitespace (``$1,234.50`` → ``1234.50``)."""
    return strip_ws(F.translate(_c(col).cast("string"), "$,", ""))


#: Largest exponent whose digits are written out; a number beyond it has no plain text that a row could hold.
MAX_EXPONENT = 1_000_000
DECIMAL_FORM = r"^\+?([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"


def decimal_too_far(col: ColumnOrName) -> Column:
    """Whether the text is a positive decimal whose exponent is beyond ``MAX_EXPONENT`` (FN-12 gives NULL for it)."""
    text = strip_ws(_c(col).cast("string"))
    exponent = F.regexp_extract(text, DECIMAL_FORM, 3)
    digits = F.concat(F.regexp_extract(text, DECIMAL_FORM, 1), F.regexp_extract(text, DECIMAL_FORM, 2))
    beyond = F.coalesce(F.abs(exponent.try_cast("bigint")) > MAX_EXPONENT, F.lit(True))
    return F.coalesce((exponent != "") & digits.rlike("[1-9]") & beyond, F.lit(False))


def decimal_text(col: ColumnOrName) -> Column:
    """FN-12: a positive decimal as plain text, else NULL.

    Decided on the text alone, so neither size nor scale is limited: the value
    is positive if the digits hold one that is not 0 and there is no minus
    sign.  Scale is kept as written (``385.10`` stays ``385.10``); an exponent
    shifts the point (``1.50e3`` → ``1500``, ``1.5e-3`` → ``0.0015``); sign and
    redundant leading zeros go.  Beyond an exponent of ``MAX_EXPONENT`` either
    way the plain text would be larger than a field can be; such a number is
    NULL here and is told apart by :func:`decimal_too_far`.
    """
    form = DECIMAL_FORM

    def parts(text: Column) -> Column:
        whole, fraction = F.regexp_extract(text, form, 1), F.regexp_extract(text, form, 2)
        exponent = F.regexp_extract(text, form, 3)
        shift = F.when(exponent == "", F.lit(0)).otherwise(exponent.try_cast("bigint"))
        shift = F.when(F.abs(shift) <= MAX_EXPONENT, shift.cast("int"))
        return F.struct(F.concat(whole, fraction).alias("digits"), (F.length(whole) + shift).alias("point"))

    def shown(p: Column) -> Column:
        digits, point = p["digits"], p["point"]
        before = F.when(point <= 0, F.lit("")).otherwise(F.left(F.rpad(digits, F.greatest(point, F.length(digits)), F.lit("0")), point))
        after = F.when(point <= 0, F.concat(F.repeat(F.lit("0"), -point), digits)).otherwise(F.substr(digits, point + 1))
        number = F.regexp_replace(F.concat(F.lit("0"), before), r"^0+([0-9])", "$1")
        return F.when(point.isNotNull() & digits.rlike("[1-9]"), F.concat_ws(".", number, F.when(after != "", after)))

    # each step is bound once; written out in place, its parts would be repeated many times over
    text = strip_ws(_c(col).cast("string"))
    bound = F.transform(F.filter(F.array(text), lambda t: t.rlike(form)), lambda t: bound_once(parts(t), shown))
    return F.get(bound, F.lit(0))


def bound_once(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.transform(F.array(value), body)[0]


def as_number(col: ColumnOrName) -> Column:
    """FN-16: numeric coercion for display; unparsable or non-finite → 0.

    The text must be a plain or exponent number: the cast alone would also
    take type suffixes such as ``1d``.
    """
    text = _c(col).cast("string")
    number = text.rlike(r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$")
    value = F.when(number, text.try_cast("double"))
    return F.when(is_finite(value), value).otherwise(F.lit(0.0))


def currency_text(col: ColumnOrName) -> Column:
    """FN-17: ``$`` text, 0 decimals at or above 1,000, else exactly 2.

    ``round`` first: it rounds half away from zero like the browser's
    formatter, where ``format_number`` alone would round half to even.
    """
    n = as_number(col)
    big = F.format_number(F.round(n, 0), 0)
    small = F.format_number(F.round(n, 2), 2)
    body = F.when(n >= 1000, big).otherwise(small)
    return F.when(F.startswith(body, F.lit("-")), F.concat(F.lit("-$"), F.substr(body, F.lit(2)))).otherwise(
        F.concat(F.lit("$"), body)
    )


def _two_dp(value: Column) -> Column:
    """At most two decimals, trailing zeros dropped (``1.50`` → ``1.5``)."""
    return F.regexp_replace(F.format_string("%.2f", F.round(value, 2)), r"\.?0+$", "")


def compact_number(col: ColumnOrName) -> Column:
    """FN-18: en-US compact notation with at most two decimals (``1234567`` → ``1.23M``).

    A value is shown in the larger unit as soon as it would round to 1000 of
    the smaller one (``999999`` → ``1M``), as the browser does.
    """
    n = as_number(col)
    expr = None
    for unit, suffix in COMPACT_STEPS:
        branch = F.abs(n) >= F.lit(unit * 0.999995)
        shown = F.concat(_two_dp(n / F.lit(unit)), F.lit(suffix))
        expr = F.when(branch, shown) if expr is None else expr.when(branch, shown)
    return expr.otherwise(_two_dp(n))


# ---- time -------------------------------------------------------------------------------


def try_timestamp(col: ColumnOrName) -> Column:
    """FN-4: ISO-8601 text (offset or ``Z``, up to 9 fractional digits) → TIMESTAMP, bad → NULL."""
    return F.try_to_timestamp(_c(col))


def bar_date_iso(col: ColumnOrName) -> Column:
    """FN-11: ``MM/dd/yyyy`` → ``yyyy-MM-ddT00:00:00+00:00``; unparsable → NULL."""
    day = F.try_to_date(_c(col), "M/d/yyyy")
    return F.when(day.isNotNull(), F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00+00:00")))


def display_date(col: ColumnOrName) -> Column:
    """FN-19: ``Jul 12, 03:58 PM`` (UTC); empty → ``Unknown``; unparsable → the text itself."""
    text = _c(col).cast("string")
    parsed = F.try_to_timestamp(text)
    return (
        F.when(text.isNull() | (text == ""), F.lit("Unknown"))
        .when(parsed.isNotNull(), F.date_format(parsed, "MMM d, hh:mm a"))
        .otherwise(text)
    )


# ---- naming -----------------------------------------------------------------------------


def sanitise_name(col: ColumnOrName) -> Column:
    """FN-8: lower-case, every character outside ``[a-z0-9_]`` → ``_``."""
    return F.regexp_replace(F.lower(_c(col)), NAME_SANITISE_PATTERN, "_")


def tenant_suffix(target: ColumnOrName, principal: ColumnOrName) -> Column:
    """SNK-6: ``target_key _ sanitised(principal)[:32] _ sha1(principal)[:8]``.

    The hash is over the *original* principal; the key over the lower-cased one.
    """
    p = _c(principal)
    return F.concat_ws(
        "_",
        sanitise_name(target),
        F.substring(sanitise_name(p), 1, PRINCIPAL_KEY_LEN),
        F.substring(F.sha1(p.cast("binary")), 1, PRINCIPAL_HASH_LEN),
    )
