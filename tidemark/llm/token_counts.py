"""Token counts by compiled finite-state transducers.

A byte-level BPE tokenizer is compiled into two deterministic machines whose
transitions carry emission counts:

* The *boundary transducer* reads character classes and marks where a
  pre-token begins.  It has eight states.  A text is cut into chunks; every
  chunk's map from entry state to exit state is computed for all states at
  once, the maps are composed by a parallel prefix scan, and a second pass
  from the now known entry states emits the marks.
* The *merge transducer* reads the bytes of a pre-token.  A state is what the
  rest of the pre-token can still depend on: the longest suffix read that some
  vocabulary token may continue, the last token of the best split before each
  position in it, and the token counts there, relative to now.  The transition
  on a byte carries the change of the token count.  Transitions are compiled
  when first met, into dense tables; each pre-token starts in state 0, so its
  machine needs no maps across chunks.

A split ending in token ``t`` is the tokenizer's own exactly if merging the
bytes of ``t`` and of the token before it gives back those two tokens; that
test is all the compiler needs from the merge table.
"""

from __future__ import annotations

import hashlib
import json
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import text_slices, vocabulary_path
from tidemark.llm.columns import text_rows

# character classes: what the boundary transducer reads
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE_LAST, SPACE_ON, BLANK_LAST, BLANK_ON, STOP, PAD = range(11)
# its states
FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_BLANKS, JOINED, ONE_MORE, TWO_MORE = range(8)
CHUNK = 128


def boundary_machine() -> tuple[np.ndarray, np.ndarray]:
    """``next[state, class]`` and ``begins[state, class]`` of the pre-token pattern.

    SHORT and LONG are apostrophes before a contraction of one or two
    letters; ``_LAST`` blanks are followed by a non-blank, ``_ON`` blanks by a
    blank or the end of the text.
    """
    nxt = np.zeros((8, 11), np.uint8)
    begins = np.zeros((8, 11), bool)
    run_of = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, SHORT: IN_OTHERS, LONG: IN_OTHERS}
    for state in range(8):
        for cls, run in run_of.items():
            joins = state in (run, JOINED)
            nxt[state, cls], begins[state, cls] = run, not joins
            if cls in (SHORT, LONG) and not joins:
                nxt[state, cls] = ONE_MORE if cls == SHORT else TWO_MORE
        if state in (ONE_MORE, TWO_MORE):
            nxt[state, LETTER], begins[state, LETTER] = FRESH if state == ONE_MORE else ONE_MORE, False
        nxt[state, SPACE_LAST], begins[state, SPACE_LAST] = JOINED, True
        nxt[state, BLANK_LAST], begins[state, BLANK_LAST] = FRESH, True
        for cls in (SPACE_ON, BLANK_ON):
            nxt[state, cls], begins[state, cls] = IN_BLANKS, state != IN_BLANKS
        nxt[state, STOP], begins[state, STOP] = FRESH, True
        nxt[state, PAD], begins[state, PAD] = state, False
    return nxt, begins


def compose_maps(maps: np.ndarray) -> np.ndarray:
    """Inclusive parallel prefix scan of state maps (row ``i`` becomes maps 0..i applied in order)."""
    out, shift = maps.copy(), 1
    while shift < len(out):
        later = np.take_along_axis(out[shift:], out[:-shift].astype(np.intp), axis=1)
        out[shift:] = later
        shift *= 2
    return out


def run_boundary(classes: np.ndarray) -> np.ndarray:
    """Begin marks of the pre-tokens of a class sequence (entry state FRESH)."""
    nxt, begins = boundary_machine()
    n = len(classes)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, PAD, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    flat = nxt.ravel()
    maps = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))
    for step in grid:
        maps = flat[maps * np.uint8(11) + step[:, None]]
    entry = np.zeros(rows, np.uint8)
    if rows > 1:
        entry[1:] = compose_maps(maps)[:-1, FRESH]
    marks = np.empty((CHUNK, rows), bool)
    emits, state = begins.ravel(), entry
    for k, step in enumerate(grid):
        at = state * np.uint8(11) + step
        marks[k] = emits[at]
        state = flat[at]
    return marks.T.reshape(-1)[:n]


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """LETTER, NUMBER, blank (SPACE_ON, BLANK_ON) or OTHER of every code point, by the library's own patterns."""
    from tokenizers import Regex, pre_tokenizers

    points = np.concatenate([np.arange(0xD800), np.arange(0xE000, 0x110000)])
    every = "".join(map(chr, points))
    table = np.full(0x110000, OTHER, np.uint8)
    for pattern, cls in ((r"\p{L}+", LETTER), (r"\p{N}+", NUMBER), (r"\s+", BLANK_ON)):
        inside = np.ones(len(points), bool)
        for _, (a, b) in pre_tokenizers.Split(Regex(pattern), "removed").pre_tokenize_str(every):
            inside[a:b] = False
        table[points[inside]] = cls
    table[0x20] = SPACE_ON
    return table


def classify(points: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Classes of a code-point sequence; ``stops`` are the positions of text ends."""
    table = class_table()
    classes = table[points]
    classes[stops] = STOP
    after = np.append(classes[1:], STOP)
    blank = (classes == SPACE_ON) | (classes == BLANK_ON)
    last = blank & (after != SPACE_ON) & (after != BLANK_ON) & (after != STOP)
    classes[last & (classes == SPACE_ON)] = SPACE_LAST
    classes[last & (classes == BLANK_ON)] = BLANK_LAST
    quotes = np.flatnonzero((points == 0x27) & (classes == OTHER))
    if len(quotes):
        one = points[np.minimum(quotes + 1, len(points) - 1)]
        two = points[np.minimum(quotes + 2, len(points) - 1)]
        classes[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        classes[quotes[pair]] = LONG
    return classes


def _printable_bytes() -> dict[str, int]:
    """The fixed character that stands for each byte in byte-level vocabulary files."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


class MergeTransducer:
    """Lazily compiled transducer from the bytes of a pre-token to its token count.

    Transitions stand in an open-addressing table keyed by state * 256 + byte.
    When more than ``max_states`` states have been compiled, the next slice
    starts a new table, so memory is bounded whatever the texts hold.
    """

    def __init__(self, path: str, max_states: int = 1 << 17, few: int = 4):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte_of = _printable_bytes()
        raw = lambda shown: bytes(byte_of[c] for c in shown)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.rank = {(raw(a), raw(b)): k for k, (a, b) in enumerate(pairs)}
        self.specials = [t["content"] for t in spec["added_tokens"]]
        specials = set(self.specials)
        tokens = [raw(t) for t in spec["model"]["vocab"] if t not in specials]
        self.tokens = {t: t for t in tokens if len(t) == 1 or self.merge(t) == [t]}
        self.heads = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.sorted = sorted(self.tokens)
        self.max_states, self.few = max_states, few
        self.fits: dict[tuple[bytes, bytes], bool] = {}
        self._clear()

    def _clear(self) -> None:
        self.states: list[tuple] = [(b"", (None,), (0,))]
        self.ids = {self._key(*self.states[0]): 0}
        self.fits.clear()
        self._room(16)

    def _room(self, bits: int) -> None:
        """An empty transition table of ``2 ** bits`` places: transition, next state, emitted tokens."""
        self.bits, self.used = bits, 0
        self.slots = np.full(1 << bits, -1, np.int64)
        self.next = np.zeros(1 << bits, np.int32)
        self.emit = np.zeros(1 << bits, np.int16)

    def _find(self, slots: np.ndarray) -> np.ndarray:
        """Places of the transitions ``slots`` in the table, -1 where not compiled yet."""
        mask = (1 << self.bits) - 1
        at = ((slots.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        rest = np.flatnonzero(self.slots[at] != slots)
        while len(rest):
            gone = self.slots[at[rest]] == -1
            at[rest[gone]] = -1
            rest = rest[~gone]
            at[rest] = (at[rest] + 1) & mask
            rest = rest[self.slots[at[rest]] != slots[rest]]
        return at

    def _add(self, slot: int, state: int, step: int) -> None:
        if 4 * self.used > 1 << self.bits:
            old = [a[self.slots >= 0] for a in (self.slots, self.next, self.emit)]
            self._room(self.bits + 2)
            for s, n, e in zip(*(a.tolist() for a in old), strict=True):
                self._add(s, n, e)
        at = (slot * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - self.bits
        while self.slots[at] not in (-1, slot):
            at = (at + 1) & (1 << self.bits) - 1
        self.used += self.slots[at] == -1
        self.slots[at], self.next[at], self.emit[at] = slot, state, step

    def merge(self, piece: bytes) -> list[bytes]:
        """Plain merging: the lowest-ranked adjacent pair first."""
        parts = [piece[k : k + 1] for k in range(len(piece))]
        while len(parts) > 1:
            ranked = [(self.rank.get((a, b), 1 << 30), k) for k, (a, b) in enumerate(zip(parts, parts[1:], strict=False))]
            best, k = min(ranked)
            if best == 1 << 30:
                break
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        return parts

    def _fit(self, before: bytes | None, token: bytes) -> bool:
        if before is None:
            return True
        pair = (before, token)
        if (known := self.fits.get(pair)) is None:
            if len(self.fits) > self.max_states:
                self.fits.clear()
            known = self.fits[pair] = self.merge(before + token) == [before, token]
        return known

    def _key(self, tail: bytes, lasts: tuple, behind: tuple) -> bytes:
        """What tells states apart: for each position, which tokens may still be put there, and its count.

        A position matters only if a token can begin there and end later.
        Where few tokens can, the token before it counts by which of them it
        fits; all tokens with the same answers are one state.
        """
        out: list = [tail]
        for k, last in enumerate(lasts):
            head = tail[k:]
            if not head:
                out.append((last, behind[k]))
            elif head in self.heads:
                lo, hi = bisect_right(self.sorted, head), bisect_left(self.sorted, head + b"\xff" * 4)
                few = last is not None and hi - lo <= self.few
                out.append((tuple(self._fit(last, t) for t in self.sorted[lo:hi]) if few else last, behind[k]))
        return hashlib.blake2b(repr(out).encode(), digest_size=16).digest()

    def compile(self, slot: int) -> None:
        """Fill the transition ``slot`` = state * 256 + byte."""
        tail, lasts, behind = self.states[slot >> 8]
        grown = tail + bytes([slot & 255])
        for start in range(len(grown)):
            token = grown[start:]
            if token in self.tokens and self._fit(lasts[start], token):
                break
        else:
            raise ValueError("vocabulary lacks a byte")
        step = 1 - behind[start]
        lasts, behind = (*lasts, self.tokens[token]), (*(b + step for b in behind), 0)
        cut = next(k for k in range(len(grown) + 1) if grown[k:] in self.heads or k == len(grown))
        seen = (grown[cut:], lasts[cut:], behind[cut:])
        key = self._key(*seen)
        if (state := self.ids.get(key)) is None:
            state = self.ids[key] = len(self.states)
            self.states.append(seen)
        self._add(slot, state, step)

    def counts(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Tokens of the pre-tokens ``data[start : start + size]``, all streams stepped together."""
        if len(self.states) > self.max_states:  # bounded memory: compile anew
            self._clear()
        order = np.argsort(-sizes, kind="stable")
        at, left = starts[order], sizes[order]
        live_at = np.searchsorted(-left, -np.arange(int(left[0]) if len(left) else 0), side="left")
        state = np.zeros(len(at), np.int64)
        total = np.zeros(len(at), np.int32)
        few = 0
        for k, live in enumerate(live_at):
            if live < 24:
                few = k
                break
            slots = state[:live] << 8 | data[at[:live] + k]
            place = self._find(slots)
            if (place < 0).any():
                for slot in np.unique(slots[place < 0]).tolist():
                    self.compile(slot)
                place = self._find(slots)
            state[:live] = self.next[place]
            total[:live] += self.emit[place]
        else:
            few = len(live_at)
        for row in range(int(live_at[few]) if few < len(live_at) else 0):  # a few long streams: one by one
            s, n = int(state[row]), int(total[row])
            known: dict[int, tuple[int, int]] = {}
            for byte in data[at[row] + few : at[row] + left[row]].tolist():
                slot = s << 8 | byte
                if slot not in known:
                    self.compile(slot)
                    place = int(self._find(np.array([slot]))[0])
                    known[slot] = int(self.next[place]), int(self.emit[place])
                s, step = known[slot]
                n += step
            total[row] = n
        out = np.empty(len(at), np.int32)
        out[order] = total
        return out


@lru_cache(maxsize=2)
def transducer(path: str) -> MergeTransducer:
    return MergeTransducer(path)


def count_tokens(texts: list[str], machine: MergeTransducer) -> np.ndarray:
    """Token counts of whole texts; special strings inside a text are one token each."""
    segments: list[str] = []
    owner: list[int] = []
    extra = np.zeros(len(texts), np.int64)
    for row, text in enumerate(texts):
        parts = [text]
        for special in machine.specials:
            if special in text:
                parts = [p for part in parts for p in part.split(special)]
        extra[row] = len(parts) - 1
        segments += parts
        owner += [row] * len(parts)
    if not segments:
        return extra
    joined = "\n".join(segments) + "\n"
    stops = np.cumsum([len(s) + 1 for s in segments]) - 1
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    data = np.frombuffer(joined.encode("utf-8"), np.uint8)
    marks = run_boundary(classify(points, stops))
    begins = np.flatnonzero(marks)
    head = (data & 0xC0) != 0x80
    byte_at = np.flatnonzero(head)[begins]
    sizes = np.diff(np.append(byte_at, len(data)))
    inner = np.isin(begins, stops, invert=True)
    segment = np.searchsorted(stops, begins[inner])
    tokens = machine.counts(data, byte_at[inner], sizes[inner])
    return extra + np.bincount(np.asarray(owner)[segment], tokens, len(texts)).astype(np.int64)


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    limit: int = 1024,
) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` per document.

    NULL text counts as empty (0 bytes, 0 tokens).  Repeated rows give
    repeated results, a NULL id is kept, an empty table gives an empty
    result, and other columns are not read.  Work is done in slices of about
    2 MB of whole texts; a longer text is alone in its slice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(vocabulary_path(vocabulary))
        for part in text_slices(batches):
            tokens = count_tokens(part.column("text").to_pylist(), machine)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("n_bytes"), pa.array(tokens), pa.array(tokens > limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()
    text = F.coalesce(F.col("text"), F.lit(""))
    return rows.select("doc_id", text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")).mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )
