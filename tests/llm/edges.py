"""Awkward document rows that every text operator must take."""

from __future__ import annotations

COLUMNS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, node long, spans string, kept boolean, n_words long, _budget long, pattern string"
)
CLASH = ("x", 1, "y", False, 2, 3, "z")

LONG = " ".join(f"word{k % 977} the" for k in range(30_000))


def rows():
    texts = {
        1: "The quick brown fox jumps over the lazy dog and the other dogs of the town that it is in",
        2: None,
        3: "",
        4: " \t\n\r ",
        5: "12 34 !?",
        6: LONG,
        7: "a",
        8: "Ünïcode wörds für die Straße und das Haus 漢字 🙂 \x01 \x1c \x85 end",
    }
    out = [(i, t, "en" if i % 2 else None, "s" if i != 5 else None, None, *CLASH) for i, t in texts.items()]
    return [*out, out[0], (None, texts[1], None, "s", None, *CLASH), (9, texts[1], "en", "t", None, *CLASH)]


def docs(spark):
    return spark.createDataFrame(rows(), COLUMNS)


def empty(spark):
    return spark.createDataFrame([], COLUMNS)
