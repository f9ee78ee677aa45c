"""Quality rules: a threshold table compiled into one projection.

Every metric is a built-in function over the word or line array of a row, and
every rule compares two metrics with whole-number arithmetic, so that the
verdict is exact.  There is no shuffle and no user function; a row's cost is
linear in its text (repeated windows are found by sorting 64-bit window
hashes, and only where a text has an equal pair at all).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import text_rows, words_of

WINDOW = 8

#: Stop words of the four languages of the corpus.
STOP_WORDS = tuple(
    """
    the of and to in a is that for it as was with be by on not he are this at from have or
    der die das und in den von zu mit sich auf für ist im dem nicht ein eine als auch
    de la le et les des en un du une est que qui dans par au sur pas avec pour
    el los las del se por con no su para es al lo como más y
    """.split()
)


@dataclass(frozen=True)
class Rule:
    """Fails where ``metric`` per ``per`` is above (or below) ``per_mille`` thousandths."""

    name: str
    metric: str
    per: str
    per_mille: int
    above: bool = True

    def sql(self) -> str:
        return f"1000 * {self.metric} {'>' if self.above else '<'} {self.per_mille} * {self.per}"


#: The contract's own two rules (fixed values).
BASE_RULES = (
    Rule("too_short", "n_words", "1", 20_000, above=False),
    Rule("repeated_windows", "n_repeat_words", "n_words", 300),
)

#: The method's rules; NULL metrics do not occur, empty texts fail the base already.
RULES = (
    Rule("long_words", "word_chars", "n_words", 12_000),
    Rule("short_words", "word_chars", "n_words", 2_000, above=False),
    Rule("symbols", "n_symbols", "n_words", 100),
    Rule("exclamations", "n_exclaims", "n_words", 300),
    Rule("stop_words", "n_stop_words", "n_words", 30, above=False),
    Rule("doubled_words", "n_doubled_words", "n_words", 200),
    Rule("repeated_lines", "n_dup_lines", "n_lines", 400),
)


def _covered(starts: Column) -> Column:
    """Words in the union of windows that begin at the ascending positions ``starts``."""
    gaps = F.transform(
        starts,
        lambda p, i: F.when(i == F.size(starts) - 1, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), F.get(starts, i + 1) - p)
        ),
    )
    return F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)


def _repeated_starts(hashes: Column) -> Column:
    """Ascending positions of the window hashes that occur twice or more."""
    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    bound = F.transform(F.array(order), lambda rows: F.transform(
        F.filter(
            F.transform(
                rows,
                lambda r, k: F.struct(
                    r["i"].alias("i"),
                    (
                        F.coalesce(F.get(rows, k - 1)["h"] == r["h"], F.lit(False))
                        | F.coalesce(F.get(rows, k + 1)["h"] == r["h"], F.lit(False))
                    ).alias("again"),
                ),
            ),
            lambda r: r["again"],
        ),
        lambda r: r["i"],
    ))
    return F.array_sort(bound[0])


def _paired(hashes: Column, span: int) -> Column:
    """Hash of each element with the one ``span`` places on (the tail stays alone and is cut later)."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + span)))


def quality_metrics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id`` and the metrics that the rules compare."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = text_rows(docs, id_col, text_col).select(
        "doc_id",
        text.alias("text"),
        words_of(F.col("text")).alias("words"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    words, n_words = F.col("words"), F.size("words")
    counted = split.select(
        "doc_id",
        n_words.cast("long").alias("n_words"),
        F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
        F.regexp_count(F.col("text"), F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        (F.length("text") - F.length(F.replace(F.col("text"), F.lit("!"), F.lit("")))).cast("long").alias("n_exclaims"),
        F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.filter(words, lambda w, i: F.coalesce(w == F.get(words, i - 1), F.lit(False)))).cast("long").alias("n_doubled_words"),
        words.alias("h1"),
    )
    # hashes of 2, 4 and 8 words by doubling; get() by position is constant-time on a stored array
    hashed = counted
    for span in (1, 2, 4):
        a = F.col(f"h{span}")
        hashed = hashed.withColumn(f"h{2 * span}", _paired(a, span)).drop(f"h{span}")
    windowed = hashed.withColumn("windows", F.slice("h8", F.lit(1), F.greatest(F.size("h8") - (WINDOW - 1), F.lit(0))))
    seen_again = F.size(F.array_distinct("windows")) < F.size("windows")
    starts = windowed.withColumn("starts", F.when(seen_again, _repeated_starts(F.col("windows"))))
    return starts.select(
        *[c for c in counted.columns if c != "h1"],
        F.when(F.col("starts").isNull(), F.lit(0)).otherwise(_covered(F.col("starts"))).cast("long").alias("n_repeat_words"),
    )


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    base_rules: tuple[Rule, ...] = BASE_RULES,
) -> DataFrame:
    """Metrics, verdict and the names of failed rules for every document.

    NULL, empty and blank texts have no words, all counts 0 and fail the
    base.  Repeated rows each give their own result row; a NULL id is kept.
    An empty table gives an empty result; other columns of ``docs`` are not
    read.  Lines are cut at ``\\n`` alone and compared whole.
    """
    failed = [F.when(F.expr(r.sql()), F.lit(r.name)) for r in (*base_rules, *rules)]
    base = F.expr(" OR ".join(f"({r.sql()})" for r in base_rules))
    metrics = quality_metrics(docs, id_col, text_col)
    judged = metrics.withColumn("failed_rules", F.concat_ws(",", *failed)).withColumn("base_failed", base)
    return judged.withColumn("kept", F.col("failed_rules") == "")
