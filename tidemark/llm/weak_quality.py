"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document.
Only the counts of the distinct vote patterns leave the cluster (at most
``3 ** len(LABELLERS)`` of them), and expectation-maximisation on those
counts estimates the share of good documents and how often each labeller
votes rightly in either class.  The posterior of a pattern is the soft label
of its documents.  A logistic scorer over hashed word shapes is then trained
on a bounded hash sample of soft-labelled documents and scores every document.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import map_batches, text_column, text_slices
from tidemark.llm.quality_rules import STOP_WORDS

SYMBOLS = b"#*$%&|<>{}[]~^=@\\"
_STOPS = frozenset(w.encode() for w in STOP_WORDS)
_SHAPE = bytes(
    0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x41 if 0x41 <= b <= 0x5A else 0x39 if 0x30 <= b <= 0x39 else b
    for b in range(256)
)
_RUNS = re.compile(rb"(.)\1+")

#: Labellers: statistic, at or above this bad, below this good (else no vote).
LABELLERS = (
    ("symbols", 0.25, 0.03),
    ("capitals", 0.35, 0.15),
    ("repeats", 0.25, 0.06),
    ("exclaims", 0.25, 0.05),
    ("odd_length", 1.0, 0.5),
    ("few_stops", 0.95, 0.88),
    ("same_lines", 0.40, 0.30),
    ("few_kinds", 0.75, 0.60),
)


def statistics(text: bytes, words: list[bytes]) -> list[float]:
    """One statistic per labeller, larger is worse; NaN where a text is too short to tell."""
    n = len(words)
    letters = text.translate(_SHAPE)
    upper, lower = letters.count(b"A"), letters.count(b"a")
    mean = (len(text) - text.count(b" ") - text.count(b"\n")) / n
    lines = [x for x in text.split(b"\n") if x.strip()]
    long = n >= 20
    stops = sum(w in _STOPS for w in text.lower().split()) if long else 0
    return [
        sum(map(text.count, (bytes([s]) for s in SYMBOLS))) / n,
        upper / (upper + lower) if upper + lower >= 20 else float("nan"),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / n if long else float("nan"),
        text.count(b"!") / n,
        max(0.0, (mean - 6.5) / 5, (3.5 - mean) / 2) if long else float("nan"),
        1 - stops / n if long else float("nan"),
        1 - len(set(lines)) / len(lines) if len(lines) >= 3 else float("nan"),
        1 - len(set(words)) / n if 20 <= n <= 400 else float("nan"),
    ]


def votes(text: bytes, words: list[bytes]) -> str:
    """A character per labeller: ``b`` bad, ``g`` good, ``-`` no vote."""
    return "".join(
        "b" if s >= bad else "g" if s < good else "-"
        for s, (_, bad, good) in zip(statistics(text, words), LABELLERS, strict=True)
    )


def features(text: bytes, words: list[bytes], dims: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word shapes and repeat marks with their share of the words, square-rooted."""
    shapes = Counter(_RUNS.sub(rb"\1", text.translate(_SHAPE)).split())
    n = len(words)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    shapes[b"\x00again"] = 16 * again
    slots = np.array([zlib.crc32(s) % dims for s in shapes], np.int64)
    values = np.sqrt(np.array(list(shapes.values()), np.float32) / n)
    return slots, values


@dataclass
class WeakLabels:
    """Share of good documents and per-labeller vote chances, index 0 bad and 1 good."""

    good: float = 0.8
    says_bad: np.ndarray = field(default_factory=lambda: np.zeros((2, len(LABELLERS))))

    def posterior(self, patterns: list[str]) -> np.ndarray:
        """Chance that a document with each vote pattern is good."""
        bad = np.array([[c == "b" for c in p] for p in patterns], bool).reshape(-1, len(LABELLERS))
        ok = np.array([[c == "g" for c in p] for p in patterns], bool).reshape(-1, len(LABELLERS))
        log = bad @ np.log(self.says_bad).T + ok @ np.log1p(-self.says_bad).T
        log += np.log([1 - self.good, self.good])
        odds = np.clip(log[:, 0] - log[:, 1], -500, 500)
        return 1 / (1 + np.exp(odds))


def fit_labellers(counts: dict[str, int], rounds: int = 200) -> WeakLabels:
    """Expectation-maximisation over vote-pattern counts, begun from "any bad vote is bad"."""
    patterns, n = list(counts), np.array(list(counts.values()), float)
    bad = np.array([[c == "b" for c in p] for p in patterns], float).reshape(-1, len(LABELLERS))
    cast = np.array([[c != "-" for c in p] for p in patterns], float).reshape(-1, len(LABELLERS))
    good = np.where(bad.any(axis=1), 0.1, 0.95)
    model = WeakLabels()
    for _ in range(rounds):
        weight = np.stack([(1 - good) * n, good * n])
        model.good = float(np.clip(weight[1].sum() / max(weight.sum(), 1e-9), 0.01, 0.99))
        model.says_bad = np.clip((weight @ bad + 0.01) / (weight @ cast + 0.02), 1e-4, 1 - 1e-4)
        after = model.posterior(patterns)
        if np.abs(after - good).max(initial=0) < 1e-7:
            break
        good = after
    return model


@dataclass
class QualityModel:
    labels: WeakLabels
    weights: np.ndarray
    bias: float

    def score(self, slots: np.ndarray, values: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[slots] @ values + self.bias, -50, 50))))


def _fit_scorer(x: np.ndarray, y: np.ndarray, steps: int = 300, rate: float = 0.05) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels by full-batch Adam with a small ridge."""
    theta = np.zeros(x.shape[1] + 1, np.float64)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta[:-1].astype(np.float32) + theta[-1], -50, 50)))
        gap = (p - y) / max(len(y), 1)
        grad = np.append(x.T @ gap.astype(np.float32) + 1e-5 * theta[:-1], gap.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return theta[:-1].astype(np.float32), float(theta[-1])


def _parts(text: str | None) -> tuple[bytes, list[bytes]]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw, raw.split()


def fit_quality(docs: DataFrame, text_col: str = "text", max_rows: int = 3000, dims: int = 2048) -> QualityModel:
    """Estimate the labellers on all documents and train the scorer on about ``max_rows`` of them.

    ``max_rows`` bounds the scorer's training sample: texts whose hash falls
    below ``max_rows`` over the number of distinct texts (an estimate within
    a few per cent), each once, so copies neither crowd nor empty it.
    Labeller statistics use every document.  Documents without words take no part.  With no documents,
    the labellers stay at their prior and the scorer is constant.
    """
    texts = docs.select(F.col(text_col).alias("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            seen = Counter(votes(*p) for p in map(_parts, part.column("text").to_pylist()) if p[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["pattern", "n"]
            )

    counted = map_batches(texts, vote, "pattern string, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counts = {r["pattern"]: r["n"] for r in counted.collect()}
    labels = fit_labellers(dict(sorted(counts.items())))
    worded = texts.where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    total = worded.agg(F.approx_count_distinct(F.xxhash64("text"), 0.02)).first()[0]

    def sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            rows = [p for p in map(_parts, part.column("text").to_pylist()) if p[1]]
            found = [features(*p, dims) for p in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([votes(*p) for p in rows], pa.string()),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.float32())),
                ],
                names=["pattern", "slots", "shares"],
            )

    share = 1 << 30 if total <= max_rows else (max_rows << 30) // total
    chosen = worded.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share)
    # equal texts share a hash: keep one row of each, or copies could swamp the sample
    rows = (
        map_batches(chosen, sample, "pattern string, slots array<long>, shares array<float>")
        .dropDuplicates(["slots", "shares"])
        .collect()
    )
    rows.sort(key=lambda r: (r["pattern"], r["slots"], r["shares"]))
    x = np.zeros((len(rows), dims), np.float32)
    for k, row in enumerate(rows):
        np.add.at(x[k], row["slots"], np.array(row["shares"], np.float32))
    weights, bias = _fit_scorer(x, labels.posterior([r["pattern"] for r in rows]))
    return QualityModel(labels, weights, bias)


def score_quality(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of a document), its ``votes``, ``p_good`` (posterior) and ``score`` (0 to 1).

    A text without words (NULL, empty, blank) has no votes and score 0.
    Repeated rows are scored alike; columns are nested in ``row``, so none
    can clash; an empty table gives an empty result.
    """
    nested = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    dims = len(model.weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value
        for batch in text_slices(batches, "row", text_col):
            parts = [_parts(t) for t in text_column(batch, "row", text_col).to_pylist()]
            cast = [votes(*p) if p[1] else None for p in parts]
            known = {p: float(g) for p in {c for c in cast if c} for g in judge.labels.posterior([p])}
            scores = [judge.score(*features(*p, dims)) if p[1] else 0.0 for p in parts]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(cast, pa.string()),
                    pa.array([known.get(c) for c in cast], pa.float64()),
                    pa.array(scores, pa.float64()),
                ],
                names=["row", "votes", "p_good", "score"],
            )

    kind = nested.schema["row"].dataType.simpleString()
    return map_batches(nested, run, f"row {kind}, votes string, p_good double, score double")


def quality_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``(doc_id, votes, p_good, score, kept)`` per document, by a model fitted on the same table."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    scored = score_quality(own, fit_quality(own))
    return scored.select(F.col("row.doc_id").alias("doc_id"), "votes", "p_good", "score", (F.col("score") >= least).alias("kept"))


def drop_low_quality(docs: DataFrame, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the documents that the classifier rejects."""
    return score_quality(docs, fit_quality(docs, text_col), text_col).where(F.col("score") >= least).select("row.*")
