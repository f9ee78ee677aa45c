"""Secret scans: fixed patterns plus sliding-window entropy, all in built-in functions.

Match positions come from marking every match with a separator character and
cutting the text there: pieces then alternate between gap and match, and the
running length gives code-point offsets (summed up in log2 passes, so a text
with many matches costs little more than its length).  Only rows that hold a
match are cut.
The entropy scan slides a window over each candidate string; one step takes
the leaving character out of the class's count table and the entering one in,
and updates the sum of ``c * log2(c)`` by those two counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_rows

MARK, MARK_STAND_IN = "\x01", "\x02"

#: Fixed values of the contract: kinds in order, their patterns, least lengths.
KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

SPAN = "struct<start:int,rank:int,kind:string,stop:int>"


@dataclass(frozen=True)
class CharClass:
    """An alphabet, the candidates made of it, and the entropy (bits) that a window must reach."""

    name: str
    alphabet: str
    candidates: str
    shape: str
    window: int
    bits: float


CLASSES = (
    CharClass("hex_upper", "0123456789ABCDEF", r"\b[0-9A-F]{32,}\b", r"[A-F].*[0-9]|[0-9].*[A-F]", 32, 3.0),
    CharClass(
        "base64",
        "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-",
        r"[A-Za-z0-9+/_=-]{24,}",
        r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])",
        24,
        3.8,
    ),
)

#: Strings that look random but are no secrets.  Placeholders and runs, sought in the pieces of a candidate (what
#: stands between ``/ = _ -``, with the separator after it): only such a piece is left out, not the key beside it.
ALLOW = (
    r"(?i)example|sample|placeholder|changeme|^change[_-]$|dummy|your(?:$|[_-])|xxxx",
    r"(?i)abcdefgh|12345678|01234567",
)
#: Identifiers and integrity hashes, which are a whole candidate.
ALLOW_WHOLE = (
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    r"^sha(256|384|512)-",
)
PIECE_END = r"(?<=[/=_-])"
#: Stands for the characters of a piece that is left out; it is in no alphabet.
LEFT_OUT = "\x03"


def _span(start: Column, kind: str, stop: Column) -> Column:
    return F.struct(
        start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), stop.alias("stop")
    )


def _pieces(text: Column, pattern: str) -> Column:
    return F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)


def _running(lengths: Column) -> Column:
    """Inclusive running sums of an array, in log2(size) passes of neighbour sums."""
    passes = F.sequence(F.lit(0), F.ceil(F.log2(F.size(lengths) + 1)).cast("int"))
    return F.aggregate(
        passes,
        lengths,
        lambda sums, k: F.transform(
            sums, lambda x, i: x + F.coalesce(F.get(sums, i - F.pow(F.lit(2), k).cast("int")), F.lit(0))
        ),
    )


def _matches(text: Column, pattern: str) -> Column:
    """``array<struct<start,piece>>`` of all leftmost, non-overlapping matches."""
    empty = F.array().cast("array<struct<start:int,piece:string>>")
    # pieces alternate gap, match, gap, ...; a match starts where the running length of those before it ends
    cut = F.transform(
        F.array(_pieces(text, pattern)),
        lambda pieces: F.struct(pieces.alias("pieces"), _running(F.transform(pieces, F.length)).alias("ends")),
    )[0]
    found = F.transform(
        F.array(cut),
        lambda c: F.transform(
            F.sequence(F.lit(1), F.size(c["pieces"]) - 1, F.lit(2)),
            lambda i: F.struct(F.get(c["ends"], i - 1).alias("start"), F.get(c["pieces"], i).alias("piece")),
        ),
    )[0]
    return F.when(text.rlike(pattern), found).otherwise(empty)


def _spans(text: Column, pattern: str, kind: str, keep=lambda piece: F.lit(True)) -> Column:
    return F.transform(
        F.filter(_matches(text, pattern), lambda m: keep(m["piece"])),
        lambda m: _span(m["start"], kind, m["start"] + F.length(m["piece"])),
    )


def _weight(c: Column) -> Column:
    return F.when(c > 1, c * F.log2(c)).otherwise(F.lit(0.0))


def _put(counts: Column, slot: Column, count: Column, size: int) -> Column:
    """``counts`` with the 1-based ``slot`` replaced."""
    return F.concat(F.slice(counts, F.lit(1), slot - 1), F.array(count), F.slice(counts, slot + 1, F.lit(size)))


def hot_range(chars: Column, cls: CharClass) -> Column:
    """``struct<first,last>``: 0-based begin of the first and end of the last window with enough
    entropy, ``first`` -1 if none.  ``chars``: array of one-character strings; a window that holds
    one outside the alphabet does not count."""
    size = len(cls.alphabet)

    def changed(s, slot, by):
        c = F.get(s["counts"], slot - 1)
        inside = slot > 0
        return F.struct(
            F.when(inside, _put(s["counts"], F.greatest(slot, F.lit(1)), c + by, size)).otherwise(s["counts"]).alias("counts"),
            F.when(inside, s["sum"] - _weight(c) + _weight(c + by)).otherwise(s["sum"]).alias("sum"),
            F.when(inside, s["outside"]).otherwise(s["outside"] + by).alias("outside"),
        )

    def let(value, body):
        return F.transform(F.array(value), body)[0]

    def step(s, i):
        slot = lambda at: F.instr(F.lit(cls.alphabet), F.get(chars, at))
        gone = F.when(i >= cls.window, changed(s["seen"], slot(i - cls.window), -1)).otherwise(s["seen"])
        hot = lambda n: (i >= cls.window - 1) & (n["outside"] == 0) & (
            F.log2(F.lit(float(cls.window))) - n["sum"] / cls.window >= cls.bits
        )
        return let(
            let(gone, lambda g: changed(g, slot(i), 1)),
            lambda n: F.struct(
                n.alias("seen"),
                F.when(hot(n) & (s["first"] < 0), i - (cls.window - 1)).otherwise(s["first"]).alias("first"),
                F.when(hot(n), i + 1).otherwise(s["last"]).alias("last"),
            ),
        )

    seen = F.struct(
        F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0).alias("outside")
    )
    return F.aggregate(
        F.sequence(F.lit(0), F.size(chars) - 1),
        F.struct(seen.alias("seen"), F.lit(-1).alias("first"), F.lit(-1).alias("last")),
        step,
        lambda s: F.struct(s["first"].alias("first"), s["last"].alias("last")),
    )


def _any_of(patterns: tuple[str, ...]):
    """Whether a column matches one of the patterns."""
    return lambda c: F.lit(False) if not patterns else c.rlike("|".join(f"(?:{p})" for p in patterns))


def _without_allowed(candidate: Column, allow: tuple[str, ...]) -> Column:
    """``candidate`` with the pieces on the allow list replaced, character by character."""
    listed = _any_of(allow)
    # a pattern that spans no separator matches the candidate if it matches a piece; anchored ones need the pieces
    replaced = F.transform(
        F.split(candidate, PIECE_END),
        lambda piece: F.when(listed(piece), F.repeat(F.lit(LEFT_OUT), F.length(piece))).otherwise(piece),
    )
    return F.array_join(replaced, "")


def _entropy_spans(text: Column, cls: CharClass, allow: tuple[str, ...], allow_whole: tuple[str, ...]) -> Column:
    suppressed = _any_of(allow_whole)
    candidates = F.transform(
        F.filter(_matches(text, cls.candidates), lambda m: m["piece"].rlike(cls.shape) & ~suppressed(m["piece"])),
        lambda m: F.struct(m["start"].alias("start"), _without_allowed(m["piece"], allow).alias("piece")),
    )
    ranged = F.transform(
        F.filter(candidates, lambda m: m["piece"].rlike(cls.shape)),
        lambda m: F.struct(
            m["start"].alias("start"),
            F.transform(F.array(F.split(m["piece"], "")), lambda chars: hot_range(chars, cls))[0].alias("hot"),
        ),
    )
    return F.transform(
        F.filter(ranged, lambda m: m["hot"]["first"] >= 0),
        lambda m: _span(m["start"] + m["hot"]["first"], "entropy", m["start"] + m["hot"]["last"]),
    )


def find_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    classes: tuple[CharClass, ...] = CLASSES,
    allow: tuple[str, ...] = ALLOW,
    allow_whole: tuple[str, ...] = ALLOW_WHOLE,
) -> DataFrame:
    """``(doc_id, spans)`` per document: spans sorted by start, then kind; code points, end exclusive.

    Pattern spans are never suppressed.  No entropy window reaches into a
    piece of its candidate that is on the allow list, and an entropy span
    inside a pattern span is dropped.  NULL
    and empty texts have no spans; repeated rows give repeated results; a
    NULL id is kept; an empty table gives an empty result.  Other columns of
    ``docs`` are not read.
    """
    clean = F.replace(F.coalesce(F.col("text"), F.lit("")), F.lit(MARK), F.lit(MARK_STAND_IN))
    rows = text_rows(docs, id_col, text_col).select("doc_id", clean.alias("text"))
    text = F.col("text")
    long_value = lambda piece: F.length(F.regexp_extract(piece, ASSIGN, 2)) >= ASSIGN_VALUE
    found = rows.select(
        "doc_id",
        F.concat(
            _spans(text, ASSIGN, "assign", long_value), _spans(text, ACCESS, "access"), _spans(text, HEX, "hex")
        ).alias("base"),
        F.array_distinct(F.concat(*[_entropy_spans(text, c, allow, allow_whole) for c in classes])).alias("more"),
    )
    outside = F.filter(
        "more",
        lambda e: ~F.exists("base", lambda b: (b["start"] <= e["start"]) & (b["stop"] >= e["stop"])),
    )
    return found.select("doc_id", F.array_sort(F.concat("base", outside)).alias("spans"))


def render(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def secret_report(docs: DataFrame) -> DataFrame:
    """The digest columns of the secret scan, one row per document (see :func:`find_secrets`)."""
    base = F.filter("spans", lambda s: s["kind"] != "entropy")
    return find_secrets(docs).select(
        "doc_id",
        *[count_kind(F.col("spans"), k).alias(f"n_{k}") for k in KINDS],
        F.sha2(render(base), 256).alias("base_sha256"),
        render(F.col("spans")).alias("spans"),
    )
