"""Benchmark decontamination with suffix arrays over the training text.

A shard is a run of whole documents, cut when it holds enough words; words
become numbers in the vocabulary of the benchmark (any other word is a gap
that matches nothing).  Only suffixes that begin with words which open some
benchmark window are kept: the first word, pair and quadruple are looked up
in the benchmark's own sorted tables by doubling.  The kept suffixes are
sorted by their first ``window`` words, which is the shard's suffix array;
every benchmark suffix is binary-searched in it, and each occurrence is then
extended word by word to its longest verbatim match.

The benchmark goes to the tasks in blocks of a fixed size.  Each further
block is another pass over the documents, with the matches so far carried in
the rows, so neither the benchmark's size nor the corpus's is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.lineage import materialize

#: Words are runs of ASCII letters and digits and of any character beyond ASCII; A-Z counts as a-z.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
)

FOUND = "n_words long, spans array<struct<start:int,stop:int>>, items array<string>, longest struct<words:int,item:string,start:int>"


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class BenchmarkBlock:
    """Search tables of a block of benchmark items, built on the driver and broadcast."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        items = [(i, w) for i, w in items if w]
        self.window = window
        self.names = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for _, ws in items for w in ws}))}
        flat: list[int] = []
        at, owner, width = [], [], []
        for k, (_, ws) in enumerate(items):
            wide = min(window, len(ws))
            for start in range(len(ws) - wide + 1):
                at.append(len(flat) + start)
                owner.append(k)
                width.append(wide)
            flat += [self.vocabulary[w] for w in ws] + [-2]
        self.text = np.array(flat + [-2] * window, np.int64)
        at, width = np.array(at, np.int64), np.array(width, np.int64)
        self.lead = int(min(4, width.min())) if len(width) else 0
        # the names of pairs and quadruples that open a window
        self.pairs = self.quads = np.zeros(0, np.int64)
        if self.lead >= 2:
            first = self.text[at] * len(self.vocabulary) + self.text[at + 1]
            third = self.text[at + 2] * len(self.vocabulary) + self.text[at + 3] if self.lead == 4 else first
            self.pairs = np.unique(np.concatenate([first, third]))
            if self.lead == 4:
                named = [np.searchsorted(self.pairs, x) for x in (first, third)]
                self.quads = np.unique(named[0] * len(self.pairs) + named[1])
        # the benchmark's own suffix array, then its distinct windows, each a range of that array
        own = keys(self.text, at, width, window)
        order = np.lexsort((_suffix_ranks(self.text)[at], own, width)) if len(at) else at
        self.array, width, own = at[order], width[order], own[order]
        owner_of = np.array(owner, np.int64)[order]
        fresh = np.ones(len(own), bool)
        fresh[1:] = (own[1:] != own[:-1]) | (width[1:] != width[:-1])
        self.low = np.flatnonzero(fresh)
        self.high = np.append(self.low[1:], len(own))
        self.windows, self.width = own[self.low], width[self.low]
        self.owners = owner_of

    def items_of(self, windows: np.ndarray) -> set[str]:
        return {self.names[o] for w in windows for o in np.unique(self.owners[self.low[w] : self.high[w]])}

    def bound(self, low: np.ndarray, high: np.ndarray, depth: np.ndarray, word: np.ndarray, after: bool) -> np.ndarray:
        """Binary search in ranges of the suffix array that agree on their first ``depth`` words."""
        low, high = low.copy(), high.copy()
        while (live := low < high).any():
            mid = (low + high) // 2
            seen = self.text[np.minimum(self.array[np.minimum(mid, len(self.array) - 1)] + depth, len(self.text) - 1)]
            right = live & ((seen <= word) if after else (seen < word))
            low, high = np.where(right, mid + 1, low), np.where(live & ~right, mid, high)
        return low


def _suffix_ranks(text: np.ndarray) -> np.ndarray:
    """Order numbers of all suffixes by prefix doubling; a negative word ends its item and sorts first."""
    place = np.arange(len(text))
    ends = np.append(np.flatnonzero(text < 0), len(text))
    end = ends[np.searchsorted(ends, place)]
    rank = np.where(text < 0, 0, text + 1)
    step, longest = 1, int((end - place).max()) if len(text) else 0
    while step < longest:
        ahead = np.where(place + step < end, rank[np.minimum(place + step, len(text) - 1)], 0)
        rank = np.unique(rank * (int(rank.max()) + 1) + ahead, return_inverse=True)[1].astype(np.int64)
        rank[text < 0] = 0
        step *= 2
    return rank


def keys(text: np.ndarray, at: np.ndarray, width: np.ndarray | int, window: int) -> np.ndarray:
    """Sort keys of suffixes: their first ``width`` word numbers, big-endian, 0 beyond."""
    grid = text[np.minimum(at[:, None] + np.arange(window), len(text) - 1)] + 1
    grid *= np.logical_and.accumulate(grid > 0, axis=1)
    grid *= np.arange(window) < np.reshape(width, (-1, 1))
    return np.ascontiguousarray(grid.astype(">u4")).view(f"S{4 * window}").ravel()


def _named(names: np.ndarray, step: int, radix: int, table: np.ndarray) -> np.ndarray:
    """Each position's number in ``table`` of the pair (name here, name ``step`` on), -1 if none."""
    after = np.append(names[step:], np.full(step, -1))
    key = np.where((names >= 0) & (after >= 0), names * radix + after, -1)
    place = np.minimum(np.searchsorted(table, key), len(table) - 1)
    return np.where(table[place] == key, place, -1)


def search_shard(text: np.ndarray, block: BenchmarkBlock) -> tuple[np.ndarray, ...]:
    """Occurrences ``(position, window, longest, item)`` of the block's windows in the shard ``text``."""
    names = text
    if block.lead >= 2:
        names = _named(text, 1, len(block.vocabulary), block.pairs)
    if block.lead == 4:
        names = _named(names, 2, len(block.pairs), block.quads)
    kept = np.flatnonzero(names >= 0) if len(block.windows) else np.zeros(0, np.int64)
    own = keys(text, kept, block.window, block.window)
    order = np.argsort(own, kind="stable")
    array, own = kept[order], own[order]
    first = np.searchsorted(own, block.windows, "left")
    padded = np.frombuffer(block.windows.tobytes(), np.uint8).reshape(len(block.windows), 4 * block.window).copy()
    padded[np.arange(4 * block.window) >= 4 * block.width[:, None]] = 0xFF
    high = np.searchsorted(own, padded.view(f"S{4 * block.window}").ravel(), "right") if len(padded) else first
    n = high - first
    window = np.repeat(np.arange(len(n)), n)
    position = array[np.repeat(first - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(len(window))] if len(
        window
    ) else np.zeros(0, np.int64)
    length = block.width[window]
    low, high = block.low[window], block.high[window]
    live = np.arange(len(window))
    while len(live):  # one more word: the range of benchmark suffixes that go on with it
        word = text[np.minimum(position[live] + length[live], len(text) - 1)]
        live, word = live[word >= 0], word[word >= 0]
        a = block.bound(low[live], high[live], length[live], word, after=False)
        b = block.bound(low[live], high[live], length[live], word, after=True)
        more = a < b
        live, a, b = live[more], a[more], b[more]
        low[live], high[live] = a, b
        length[live] += 1
    return position, window, length, block.owners[low]


def scan_shard(rows: list[tuple[list[bytes], dict | None]], block: BenchmarkBlock) -> list[dict]:
    """Matches of each row's words, joined with what earlier blocks found (``before``)."""
    get = block.vocabulary.get
    sizes = [len(w) for w, _ in rows]
    text = np.full(sum(sizes) + len(rows) + 1, -1, np.int64)
    starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + 1)]).astype(np.int64)
    for (ws, _), at, size in zip(rows, starts.tolist(), sizes, strict=False):
        text[at : at + size] = [get(w, -1) for w in ws]
    position, window, length, item = search_shard(text, block)
    out = [b or {"spans": [], "items": [], "longest": None} for _, b in rows]
    row = np.searchsorted(starts, position, "right") - 1
    order = np.lexsort((position, row))
    position, window, length, item, row = (x[order] for x in (position, window, length, item, row))
    hit_rows, from_ = np.unique(row, return_index=True)
    until = np.append(from_[1:], len(row))
    for r, a, b in zip(hit_rows.tolist(), from_.tolist(), until.tolist(), strict=False):
        at, win, long = position[a:b] - starts[r], window[a:b], length[a:b]
        spans = [(s["start"], s["stop"]) for s in out[r]["spans"]]
        spans += zip(at.tolist(), (at + block.width[win]).tolist(), strict=True)
        items = block.items_of(np.unique(win))
        best = int(np.lexsort((at, -long))[0])
        longest = {
            "words": int(long[best]),
            "item": block.names[item[a + best]],
            "start": int(at[best]),
        }
        before = out[r]["longest"]
        out[r] = {
            "spans": _merged(spans),
            "items": sorted(items.union(out[r]["items"])),
            "longest": before if before and before["words"] >= longest["words"] else longest,
        }
    return [m | {"n_words": n} for m, n in zip(out, sizes, strict=True)]


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([start, stop])
    return [{"start": a, "stop": b} for a, b in out]


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
    """Blocks of at most about ``block_words`` words, read by the driver one after the other."""
    held, size = [], 0
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    for row in items.toLocalIterator():
        ws = words(row["text"])
        if held and size + len(ws) > block_words:
            yield BenchmarkBlock(held, window)
            held, size = [], 0
        held.append((row["item"] if row["item"] is not None else "null", ws))
        size += len(ws)
    yield BenchmarkBlock(held, window)


def match_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    shard_words: int = 1 << 18,
    block_words: int = 1 << 21,
) -> DataFrame:
    """One row per document: ``row`` (all its columns), ``n_words``, merged hit ``spans`` (word
    positions, end exclusive), ``items`` with an occurring window, and the ``longest`` match.

    An item of fewer than ``window`` words is one window; items without
    words and NULL texts match nothing.  A NULL item id is listed as
    ``null``; items that share an id are listed once.  Repeated rows are each
    matched.  An empty benchmark matches nothing; an empty corpus gives an
    empty result.  Document columns are nested in ``row``, so none can clash.
    """
    spark = docs.sparkSession
    state = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.lit(None).cast("struct<spans:array<struct<start:int,stop:int>>,items:array<string>,longest:struct<words:int,item:string,start:int>>").alias("before"),
    )
    nested = state.schema["row"].dataType.simpleString()
    done: DataFrame | None = None
    for block in benchmark_blocks(benchmark, item_id_col, item_text_col, window, block_words):
        if done is not None:
            state = materialize(done, "benchmark-pass").select("row", F.struct("spans", "items", "longest").alias("before"))
        shared = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = pc.struct_field(batch.column("row"), text_col)
                start = held = 0
                shard: list = []
                for k in range(batch.num_rows + 1):
                    if shard and (k == batch.num_rows or held >= shard_words):
                        found = scan_shard(shard, shared.value)
                        table = pa.RecordBatch.from_pylist(found, schema=FOUND_SCHEMA)
                        yield pa.RecordBatch.from_arrays(
                            [batch.column("row").slice(start, k - start), *table.columns],
                            names=["row", *FOUND_SCHEMA.names],
                        )
                        start, held, shard = k, 0, []
                    if k < batch.num_rows:
                        ws = words(texts[k].as_py())
                        shard.append((ws, batch.column("before")[k].as_py()))
                        held += len(ws)

        done = state.mapInArrow(run, f"row {nested}, {FOUND}")
    return done


_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))
FOUND_SCHEMA = pa.schema(
    [
        ("n_words", pa.int64()),
        ("spans", _SPANS),
        ("items", pa.list_(pa.string())),
        ("longest", pa.struct([("words", pa.int32()), ("item", pa.string()), ("start", pa.int32())])),
    ]
)


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + (s["stop"] - s["start"]))


def contamination_report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """Digest columns of :func:`match_benchmark`, one row per document."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(options.get("text_col", "text")).alias("text"))
    found = match_benchmark(own, benchmark, **(options | {"text_col": "text"}))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("items"), ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark window."""
    found = match_benchmark(docs, benchmark, **options)
    return found.where(F.size("spans") == 0).select("row.*")
