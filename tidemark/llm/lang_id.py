"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads windows of ``WINDOW`` bytes of folded UTF-8 text from both
ends, labels every position, and a document's language is the one with the
largest mean probability over all its letter positions.  It is trained in
numpy by backpropagation through time on a bounded, documented sample of
windows of labelled documents; prediction covers every byte of every text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_slices

WINDOW = 64
HIDDEN = 8
UNKNOWN = "und"
MAX_LANGUAGES = 4096
_LETTER = re.compile(r"[^\W\d_]")
_LETTER_BYTE = np.array([0x61 <= b <= 0x7A or b >= 0x80 for b in range(256)])


@dataclass
class Direction:
    """A gated recurrent layer: per-byte input rows and recurrent weights of update, reset and candidate."""

    rows: np.ndarray  # 256 x 3H
    recur: np.ndarray  # H x 3H

    def run(self, steps: np.ndarray, keep: bool = False):
        """States after each of the steps (T x N bytes), and what the backward pass needs if ``keep``."""
        h_size = self.recur.shape[0]
        h = np.zeros((steps.shape[1], h_size), np.float32)
        states, saved = np.empty((len(steps), *h.shape), np.float32), []
        for t, byte in enumerate(steps):
            x, u = self.rows[byte], h @ self.recur
            gates = x[:, : 2 * h_size] + u[:, : 2 * h_size]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates *= 0.5
            gates += 0.5
            z, r, un = gates[:, :h_size], gates[:, h_size:], u[:, 2 * h_size :]
            n = np.tanh(x[:, 2 * h_size :] + r * un)
            new = n + z * (h - n)
            if keep:
                saved.append((h, z, r, n, un))
            h = states[t] = new
        return states, saved

    def back(self, steps: np.ndarray, saved: list, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the two weight tables from those of the states, through time."""
        h_size = self.recur.shape[0]
        d_in = np.empty((*steps.shape, 3 * h_size), np.float32)
        d_recur = np.zeros_like(self.recur)
        d_next = np.zeros_like(grads[0])
        for t in range(len(steps) - 1, -1, -1):
            h, z, r, n, un = saved[t]
            dh = grads[t] + d_next
            dn = dh * (1 - z) * (1 - n * n)
            da = np.concatenate([dh * (h - n) * z * (1 - z), dn * un * r * (1 - r), dn], axis=1)
            d_in[t] = da
            du = da.copy()
            du[:, 2 * h_size :] = dn * r
            d_recur += h.T @ du
            d_next = dh * z + du @ self.recur.T
        d_rows = np.zeros_like(self.rows)
        flat, order = d_in.reshape(-1, 3 * h_size), np.argsort(steps.ravel(), kind="stable")
        used, at = np.unique(steps.ravel()[order], return_index=True)
        if len(used):
            d_rows[used] = np.add.reduceat(flat[order], at, axis=0)
        return d_rows, d_recur


@dataclass
class ByteTagger:
    """The network: both directions, and a linear layer on both states at each position."""

    languages: list[str]
    ahead: Direction
    behind: Direction
    out: np.ndarray  # 2H x K
    bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int, hidden: int = HIDDEN) -> ByteTagger:
        rng = np.random.default_rng(seed)
        draw = lambda *shape, s=0.3: rng.normal(0, s, shape).astype(np.float32)
        layer = lambda: Direction(draw(256, 3 * hidden), draw(hidden, 3 * hidden))
        return cls(languages, layer(), layer(), draw(2 * hidden, len(languages)), np.zeros(len(languages), np.float32))

    def weights(self) -> list[np.ndarray]:
        return [self.ahead.rows, self.ahead.recur, self.behind.rows, self.behind.recur, self.out, self.bias]

    def _states(self, windows: np.ndarray, keep: bool = False):
        steps = np.ascontiguousarray(windows.T)
        fore, saved_fore = self.ahead.run(steps, keep)
        back, saved_back = self.behind.run(steps[::-1], keep)
        return steps, fore, back[::-1], saved_fore, saved_back

    def _soft(self, fore: np.ndarray, back: np.ndarray) -> np.ndarray:
        h = fore.shape[-1]
        p = fore @ self.out[:h] + back @ self.out[h:] + self.bias
        p -= p.max(axis=-1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(axis=-1, keepdims=True)
        return p

    def label(self, windows: np.ndarray) -> np.ndarray:
        """Label probabilities of every position (N x T x K) of byte windows (N x T)."""
        _, fore, back, _, _ = self._states(windows)
        return self._soft(fore, back).transpose(1, 0, 2)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """Mean cross entropy over letter positions, and its gradients by backpropagation through time."""
        steps, fore, back, saved_fore, saved_back = self._states(windows, keep=True)
        p, mask = self._soft(fore, back), _LETTER_BYTE[steps]
        each = np.arange(windows.shape[0])
        total = max(int(mask.sum()), 1)
        loss = float(-(np.log(p[:, each, labels] + 1e-12) * mask).sum() / total)
        p[:, each, labels] -= 1
        p *= mask[..., None] / np.float32(total)
        h = fore.shape[-1]
        d_out = np.concatenate([np.einsum("tnh,tnk->hk", s, p) for s in (fore, back)])
        d_fore, d_back = p @ self.out[:h].T, p @ self.out[h:].T
        grads = [*self.ahead.back(steps, saved_fore, d_fore), *self.behind.back(steps[::-1], saved_back, d_back[::-1])]
        return loss, [*grads, d_out, p.sum(axis=(0, 1))]

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int, seed: int, batch: int = 256, rate: float = 0.02):
        """Adam over shuffled batches, for a fixed number of steps whatever the sample's size."""
        rng = np.random.default_rng(seed)
        first = [np.zeros_like(w) for w in self.weights()]
        second = [np.zeros_like(w) for w in self.weights()]
        order = np.concatenate([rng.permutation(len(windows)) for _ in range(-(-steps * batch // len(windows)))])
        for step in range(1, steps + 1):
            pick = order[(step - 1) * batch : step * batch]
            _, grads = self.gradients(windows[pick], labels[pick])
            size = rate * (1 - 0.9 * step / steps)
            for w, g, m, v in zip(self.weights(), grads, first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= size * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-7)
        return self


class LetterPool:
    """The trained network laid out for prediction: one row per unit, windows along the columns.

    Gates use ``sigmoid(x) = tanh(x / 2) / 2 + 1 / 2`` with the halves folded
    into the weights.  Gives the same label probabilities as
    :meth:`ByteTagger.label`, summed over the letter positions of a window.
    """

    def __init__(self, model: ByteTagger):
        h = model.ahead.recur.shape[0]
        half = np.repeat(np.float32([0.5, 1.0]), [2 * h, h])
        inner = np.full(3 * h, 0.5, np.float32)
        self.layers = [
            (np.ascontiguousarray((d.rows * half).T), np.ascontiguousarray((d.recur * inner).T))
            for d in (model.ahead, model.behind)
        ]
        self.out = [np.ascontiguousarray(model.out[:h].T), np.ascontiguousarray(model.out[h:].T)]
        self.bias = model.bias[:, None]
        self.hidden = h

    def _advance(self, layer: int, byte: np.ndarray, h: np.ndarray) -> np.ndarray:
        rows, recur = self.layers[layer]
        k = self.hidden
        x, u = rows.take(byte, axis=1), recur @ h
        gates = x[: 2 * k]
        gates += u[: 2 * k]
        np.tanh(gates, out=gates)
        n, un = x[2 * k :], u[2 * k :]
        n += un
        un *= gates[k:]
        n += un
        np.tanh(n, out=n)
        h = (h - n) * np.float32(0.5)
        n += h
        h *= gates[:k]
        n += h
        return n

    def sums(self, windows: np.ndarray) -> np.ndarray:
        """Sums (N x K) of the label probabilities over the letter positions of windows (N x T)."""
        steps = np.ascontiguousarray(windows.T)
        mask = _LETTER_BYTE[steps].astype(np.float32)
        n = steps.shape[1]
        heard = np.empty((len(steps), len(self.bias), n), np.float32)
        h = np.zeros((self.hidden, n), np.float32)
        for t, byte in enumerate(steps):
            h = self._advance(0, byte, h)
            np.matmul(self.out[0], h, out=heard[t])
        total = np.zeros((len(self.bias), n), np.float32)
        h = np.zeros((self.hidden, n), np.float32)
        for t in range(len(steps) - 1, -1, -1):
            h = self._advance(1, steps[t], h)
            p = heard[t]
            p += self.out[1] @ h
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p *= mask[t] / p.sum(axis=0)
            total += p
        return total.T


def folded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def windows_of(raw: bytes) -> np.ndarray:
    """All bytes of a text as windows; the last one is filled up with zero bytes."""
    n = -(-len(raw) // WINDOW)
    return np.frombuffer(raw.ljust(n * WINDOW, b"\0"), np.uint8).reshape(n, WINDOW)


def pooled(model: ByteTagger, texts: list[str | None], block: int = 2048) -> tuple[list[str], list[float]]:
    """Language and score of whole texts: mean label probabilities over all letter positions."""
    rows = [windows_of(folded(t)) for t in texts]
    owner = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    windows = np.concatenate(rows) if rows else np.zeros((0, WINDOW), np.uint8)
    sums = np.zeros((len(texts), len(model.languages)))
    count = np.zeros(len(texts))
    pool = LetterPool(model)
    for at in range(0, len(windows), block):
        part, own = windows[at : at + block], owner[at : at + block]
        np.add.at(sums, own, pool.sums(part))
        np.add.at(count, own, _LETTER_BYTE[part].sum(axis=1))
    mean = sums / np.maximum(count, 1)[:, None]
    best = mean.argmax(axis=1)
    known = [bool(t) and bool(_LETTER.search(t)) for t in texts]
    names = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known, strict=True)]
    scores = [min(1.0, float(m[b])) if k else 0.0 for m, b, k in zip(mean, best.tolist(), known, strict=True)]
    return names, scores


def held_out(doc_id: Column) -> Column:
    """Documents of the held-out fold; a NULL id is in it, so that it is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def train_language_model(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    docs_per_language: int = 400,
    windows_per_doc: int = 4,
    steps: int = 300,
    seed: int = 11,
) -> ByteTagger | None:
    """Train on about ``docs_per_language`` distinct texts of each language, ``windows_per_doc`` windows of each.

    Only documents outside the held-out fold, with text and language, take
    part.  The sample is drawn by a hash of the text, the windows of a
    document by a hash of its bytes, from the whole text.  None if there is
    nothing to learn from.
    """
    known = docs.select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"), held_out(F.col(id_col)).alias("held_out")
    ).where("NOT held_out AND lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    # one output unit per language, so their number is bounded by the model itself
    # copies of a text come or stay out together, so shares go by distinct texts
    sizes = known.groupBy("lang").agg(F.count_distinct(F.xxhash64("text")).alias("n")).limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return None
    shares = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], docs_per_language / r["n"])])
    draw = F.pmod(F.xxhash64("text", F.lit(seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    chosen = known.where(draw < F.element_at(shares, F.col("lang"))).select("lang", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            langs, found = [], []
            for lang, text in zip(part.column("lang").to_pylist(), part.column("text").to_pylist(), strict=True):
                windows = windows_of(folded(text))
                pick = np.random.default_rng([seed, len(text)]).permutation(len(windows))[:windows_per_doc]
                found += [windows[k].tobytes() for k in pick]
                langs += [lang] * len(pick)
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(found, pa.binary())], names=["lang", "bytes"])

    rows = chosen.mapInArrow(cut, "lang string, bytes binary").distinct().collect()
    rows = sorted((r["lang"], bytes(r["bytes"])) for r in rows)
    if not rows:
        return None
    languages = sorted({lang for lang, _ in rows})
    windows = np.stack([np.frombuffer(b, np.uint8) for _, b in rows])
    labels = np.array([languages.index(lang) for lang, _ in rows])
    return ByteTagger.fresh(languages, seed).fit(windows, labels, steps, seed)


def identify_languages(
    docs: DataFrame, model: ByteTagger | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per document.

    NULL texts and texts without a letter are ``und`` with score 0, as is
    everything where there was nothing to learn from.  A NULL id counts as
    held out.  Repeated rows give repeated results, an empty table an empty
    one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tagger = shared.value
        for part in text_slices(batches):
            texts = part.column("text").to_pylist()
            names, scores = pooled(tagger, texts) if tagger else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text")
    )
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def language_report(docs: DataFrame) -> DataFrame:
    """Train on the learning folds of ``docs`` and predict every document."""
    return identify_languages(docs, train_language_model(docs))
