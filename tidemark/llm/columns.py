"""Small shared helpers of the text operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value of the contracts: a word is a run of characters other than these.
WORD_SPACE = " \t\n\x0b\f\r"
WORD_SPLIT = r"[\x20\x09-\x0D]+"


def text_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text of ``docs``, so that no other column can clash with a result."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def words_of(text: Column) -> Column:
    """The words of a text as an array; none for NULL, empty or blank text."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(WORD_SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, WORD_SPLIT))
