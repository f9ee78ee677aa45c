"""Helpers for Arrow-batch operators: bounded slices of whole texts, vocabulary files."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Bounds of one Arrow batch between the JVM and a Python worker; a longer row is a batch of its own.
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``df.mapInArrow`` with small batches, so that what a worker and the JVM hold of one does not grow with the rows."""
    conf = df.sparkSession.conf
    conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df.mapInArrow(run, schema)


def text_column(batch: pa.RecordBatch, *names: str) -> pa.Array:
    """A column, or a field of nested ones: ``text_column(batch, "row", "text")``."""
    found = batch.column(names[0])
    for name in names[1:]:
        found = pc.struct_field(found, name)
    return found


def text_slices(batches: Iterator[pa.RecordBatch], *names: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of about ``max_bytes`` of text; a longer text is alone in its slice.

    The batches hold whole texts in the column ``text``, or where ``names`` lead; texts are never cut.
    """
    for batch in batches:
        start = held = 0
        sizes = pc.binary_length(text_column(batch, *(names or ("text",)))).fill_null(0).to_pylist()
        for row, size in enumerate(sizes):
            if held and held + size > max_bytes:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


def gathered(
    ids: list[bytes], index: np.ndarray, counts: np.ndarray, dtype: np.dtype, end: bytes | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of a batch in one array, and the borders of its texts.

    Text ``k`` is the next ``counts[k]`` places of ``index`` into ``ids``, closed by ``end``.
    """
    if end is not None:
        index, counts, ids = np.insert(index, np.cumsum(counts), len(ids)), counts + 1, [*ids, end]
    taken = pa.array(ids, pa.large_binary()).take(pa.array(index))
    _, ends, data = taken.buffers()
    places = np.frombuffer(ends, np.int64, len(taken) + 1) if len(taken) else np.zeros(1, np.int64)
    borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)
    flat = np.frombuffer(data, dtype, int(places[-1]) // dtype.itemsize) if places[-1] else np.zeros(0, dtype)
    return flat, places[borders] // dtype.itemsize


def vocabulary_path(name: str) -> str:
    """A vocabulary file: ``name`` itself where it is a path, else the installed public file of that name."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)
