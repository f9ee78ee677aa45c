"""Importance resampling towards a target distribution, with hashed n-gram features.

Text becomes features in Arrow kernels: ``ascii_lower``,
``split_pattern_regex``, ``list_flatten`` and ``dictionary_encode`` give the
words of a batch as indices into its distinct words.  Runs of n words are
index arrays shifted against each other; each distinct run is hashed once (the
CRC of a run goes on from that of the run without its last word).  One pass
over either corpus counts the hash buckets; the log ratio of the target's to
the corpus's smoothed share is the bucket's gain.  A second pass takes the
gain of every feature and reduces it over each document's segment.

Documents are drawn without replacement by Gumbel noise: the highest of
``weight + noise`` are kept.  The noise is a hash of the id, so the draw can
be repeated and does not depend on the partitioning.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import map_batches, text_slices
from tidemark.llm.columns import text_rows
from tidemark.operators.lineage import materialize
from tidemark.operators.ranking import with_rank

#: Fixed value of the contract: what separates words once A-Z is lower-cased.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UNIT = 1000


@dataclass(frozen=True)
class Resampling:
    """Longest run of words, hash buckets, least words of a drawn document, drawn percentage, seed of the noise."""

    n: int = 1
    buckets: int = 10_000
    least_words: int = 20
    percent: int = 10
    seed: int = 2024


def word_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row and word index of every word of a batch, and the distinct words."""
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), pattern=SEPARATORS)
    coded = pc.list_flatten(lists).dictionary_encode()
    rows = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
    words = coded.indices.to_numpy(zero_copy_only=False)
    distinct = coded.dictionary.cast(pa.binary()).to_pylist()
    held = np.array([bool(w) for w in distinct], bool)[words] if distinct else np.zeros(0, bool)
    return rows[held], words[held].astype(np.int64), distinct


def feature_buckets(texts: pa.Array, n: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every run of 1 to ``n`` words in a batch; repeats counted."""
    rows, words, distinct = word_arrays(texts)
    if not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    crc = np.array([zlib.crc32(w) for w in distinct], np.int64)
    out_rows, out_buckets = [rows], [(crc % buckets)[words]]
    runs, run_crc, at = words, crc, np.arange(len(words))  # at: where each run begins
    for size in range(2, n + 1):
        goes_on = at + size - 1 < len(words)
        goes_on[goes_on] = rows[at[goes_on] + size - 1] == rows[at[goes_on]]
        at, runs = at[goes_on], runs[goes_on]
        if not len(at):
            break
        last = words[at + size - 1]
        pairs, runs = np.unique(runs * len(distinct) + last, return_inverse=True)
        before, after = pairs // len(distinct), pairs % len(distinct)
        pair_crc = [zlib.crc32(b" " + distinct[w], c) for c, w in zip(run_crc[before].tolist(), after.tolist(), strict=True)]
        run_crc = np.array(pair_crc, np.int64)
        out_rows.append(rows[at])
        out_buckets.append((run_crc % buckets)[runs])
    return np.concatenate(out_rows), np.concatenate(out_buckets)


def bucket_counts(docs: DataFrame, how: Resampling, text_col: str = "text") -> np.ndarray:
    """Features of all texts by bucket; one row per bucket reaches the driver."""
    texts = docs.select(F.col(text_col).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(how.buckets, np.int64)
        for part in text_slices(batches):
            _, found = feature_buckets(part.column("text"), how.n, how.buckets)
            total += np.bincount(found, minlength=how.buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int64()), pa.array(total[held])], names=["bucket", "n"])

    summed = map_batches(texts, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(how.buckets, np.int64)
    for row in summed.collect():
        total[row["bucket"]] = row["n"]
    return total


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandfold log ratio of the smoothed shares, rounded down."""
    size = len(corpus)
    whole, wanted = float(corpus.sum() + size), float(target.sum() + size)
    ratios = zip(target.tolist(), corpus.tolist(), strict=True)
    gains = [math.floor(UNIT * math.log((t + 1.0) * whole / ((s + 1.0) * wanted))) for t, s in ratios]
    return np.array(gains, np.int64)


def weigh(docs: DataFrame, gains: np.ndarray, how: Resampling, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_features, weight)``: the mean gain of each document's features, rounded down."""
    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found, buckets = feature_buckets(part.column("text"), how.n, how.buckets)
            order = np.argsort(found, kind="stable")
            features = np.bincount(found, minlength=part.num_rows)
            # the first kind of features are the words: a text of w words has w - k + 1 runs of k words
            words = features if how.n == 1 else _words_of(features, how.n)
            total = np.zeros(part.num_rows, np.int64)
            held = np.flatnonzero(features)
            if len(held):
                begins = np.concatenate([[0], np.cumsum(features[held])[:-1]])
                total[held] = np.add.reduceat(shared.value.take(buckets[order]), begins)
            weight = total // np.maximum(features, 1)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in (words, features, weight))],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return map_batches(rows, run, f"doc_id {kind}, n_words long, n_features long, weight long")


def _words_of(features: np.ndarray, n: int) -> np.ndarray:
    """Words of texts that have ``features`` runs of 1 to ``n`` words."""
    short = np.array([sum(w - k + 1 for k in range(1, min(n, w) + 1)) for w in range(n + 1)])
    few = np.searchsorted(short, features)
    return np.where(features <= short[-1], few, (features + n * (n - 1) // 2) // n)


def noisy_score(how: Resampling):
    """Weight plus Gumbel noise, from the hash of the seed and the id."""
    key = F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-float(UNIT) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    return (F.col("weight") + noise).cast("long")


def resample(
    docs: DataFrame,
    target: DataFrame,
    how: Resampling = Resampling(),
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)`` of every document; ``rank`` is NULL where it is not drawn.

    Of the documents with ``least_words`` words, ``percent`` in a hundred
    (rounded down) are drawn, by highest score and then least ``doc_id``.
    NULL, empty and wordless texts have no features, weight 0 and are never
    drawn.  A NULL id hashes as an empty one and comes last in ties; repeated
    rows are documents of their own, in any order among themselves.  An empty
    target leaves gains that favour rare buckets; an empty corpus gives an
    empty result; columns besides id and text are not read.

    Scores are whole numbers in a range set by the gains, so their histogram
    is bounded (some ten thousand rows); it tells which documents can be drawn
    at all, and only those are sorted.
    """
    gains = bucket_gains(bucket_counts(docs, how, text_col), bucket_counts(target, how, target_text_col))
    weighed = weigh(docs, gains, how, id_col, text_col).withColumn("score", noisy_score(how))
    rows = materialize(weighed.withColumn("_tie", F.monotonically_increasing_id()), "weighed")
    able = rows.where(F.col("n_words") >= how.least_words)
    counts = {r["score"]: r["n"] for r in able.groupBy("score").agg(F.count("*").alias("n")).collect()}
    drawn = how.percent * sum(counts.values()) // 100
    bar, above = None, 0
    for score in sorted(counts, reverse=True):
        if above >= drawn:
            break
        bar, above = score, above + counts[score]
    columns = ["doc_id", "n_features", "weight", "score"]
    if bar is None:
        return rows.select(*columns, F.lit(None).cast("long").alias("rank"))
    near = (F.col("n_words") >= how.least_words) & (F.col("score") >= bar)
    placed = with_rank(rows.where(near), F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("_tie"), name="_rank")
    rank = F.when(F.col("_rank") < drawn, F.col("_rank") + 1).cast("long").alias("rank")
    return rows.where(~near).select(*columns, F.lit(None).cast("long").alias("rank")).union(placed.select(*columns, rank))
