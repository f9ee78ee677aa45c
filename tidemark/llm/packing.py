"""Packing documents into sequences by linear grouping, with best fit for the small ones.

Token counts are at most the capacity, so everything that has to be optimised
is a table of at most ``capacity`` lengths with their counts; pieces
themselves are only ranked, by length, and looked up.

1. Large pieces, longest first, are dealt into groups of equal cardinality,
   and each group is rounded up to its longest member: few sizes remain.
2. Configurations of these sizes are chosen one after the other: the largest
   size left, with the combination of others that fills the rest best (a
   subset sum over what is left), used as often as the counts allow.
3. The actual pieces of a group take its places in the order of their rank.
   They are never longer than the place; what they leave free stays open.
4. Small pieces go, longest first, where they fit best, counting the bins of
   equal free space together.  A bin takes a length as often as it fits, so
   its free space at least halves each time it is used: the table of
   placements stays within a small multiple of the capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.arrow import map_batches, text_slices
from tidemark.llm.byte_pieces import byte_pieces
from tidemark.llm.columns import text_rows
from tidemark.operators.lineage import materialize
from tidemark.operators.ranking import with_rank


@dataclass(frozen=True)
class Packing:
    """Tokens of a sequence, vocabulary, closing id, longest small piece, groups of large ones."""

    capacity: int = 2048
    vocabulary: str = "byte_bpe_50k.json"
    end_id: int = 0
    small: int = 256
    groups: int = 4096


@dataclass
class Intervals:
    """Where runs of consecutive ranks go: rank ``r`` of a run is in bin ``bin + (r - begin) // each``."""

    begin: list[int] = field(default_factory=list)
    bin: list[int] = field(default_factory=list)
    each: list[int] = field(default_factory=list)
    #: Slot of a large piece, or offset of the first small one in its bin.
    at: list[int] = field(default_factory=list)

    def add(self, begin: int, bin_: int, each: int, at: int) -> None:
        for column, value in zip((self.begin, self.bin, self.each, self.at), (begin, bin_, each, at), strict=True):
            column.append(value)

    def arrays(self) -> list[np.ndarray]:
        order = np.argsort(np.array(self.begin, np.int64), kind="stable")
        return [np.array(c, np.int64)[order] for c in (self.begin, self.bin, self.each, self.at)]


def cut_pieces(docs: DataFrame, how: Packing, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)``: documents longer than a sequence cut, the first piece the odd one."""
    rows = text_rows(docs, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = byte_pieces(how.vocabulary)
        for part in text_slices(batches, max_bytes=4 << 20):
            ids, stops = tool.encode(part.column("text"), how.end_id)
            raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
            size = np.diff(stops)
            number = -(-size // how.capacity)
            row = np.repeat(np.arange(len(size)), number)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)
            odd = size - (number - 1) * how.capacity
            start = np.where(piece == 0, 0, odd[row] + (piece - 1) * how.capacity)
            length = np.where(piece == 0, odd[row], how.capacity)
            begin = stops[:-1][row] + start
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id").take(pa.array(row)), pa.array(piece, pa.int32()), *(pa.array(c, pa.int64()) for c in (start, length, crc))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return map_batches(rows, run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def rounded_groups(counts: dict[int, int], groups: int) -> list[tuple[int, int]]:
    """``(size, members)`` of groups of equal cardinality, longest first; groups of one size are joined."""
    per = max(1, -(-sum(counts.values()) // groups))
    out: list[list[int]] = []
    room = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not room:
                if not out or out[-1][0] != length:
                    out.append([length, 0])
                room = per
            taken = min(left, room)
            out[-1][1] += taken
            left, room = left - taken, room - taken
    return [(size, n) for size, n in out]


def best_fill(sizes: list[int], left: list[int], room: int, from_: int) -> list[int]:
    """How often to use each size (indices ``from_`` on, sizes descending) to fill ``room`` as far as it goes."""
    reach, mask = [1], (1 << (room + 1)) - 1
    usable = [k for k in range(len(sizes) - 1, from_ - 1, -1) if left[k] and sizes[k] <= room]
    for k in usable:  # ascending, so that the walk back takes large sizes first
        bits = reach[-1]
        for _ in range(min(left[k], room // sizes[k])):
            more = bits | (bits << sizes[k]) & mask
            if more == bits:
                break
            bits = more
        reach.append(bits)
    use, total = [0] * len(sizes), reach[-1].bit_length() - 1
    for step in range(len(usable), 0, -1):
        k = usable[step - 1]
        n = min(left[k], total // sizes[k])
        while n and not reach[step - 1] >> (total - n * sizes[k]) & 1:
            n -= 1
        use[k], total = n, total - n * sizes[k]
    return use


def configurations(groups: list[tuple[int, int]], capacity: int) -> list[tuple[list[int], int]]:
    """``(uses of each size, times)`` that hold every member of the groups."""
    sizes, left = [s for s, _ in groups], [n for _, n in groups]
    out = []
    for k, size in enumerate(sizes):
        while left[k]:
            left[k] -= 1
            use = best_fill(sizes, left, capacity - size, k)
            left[k] += 1
            use[k] += 1
            times = min(left[j] // n for j, n in enumerate(use) if n)
            for j, n in enumerate(use):
                left[j] -= n * times
            out.append((use, times))
    return out


def place_large(counts: dict[int, int], how: Packing) -> tuple[Intervals, int]:
    """Bins and slots of the ranks of all pieces above ``how.small``, and the number of bins."""
    out = Intervals()
    whole = counts.get(how.capacity, 0)
    if whole:  # full pieces are alone
        out.add(0, 0, 1, 0)
    groups = rounded_groups({s: n for s, n in counts.items() if how.small < s < how.capacity}, how.groups)
    following, bins = [], whole
    at = whole
    for _, n in groups:
        following.append(at)
        at += n
    for use, times in configurations(groups, how.capacity):
        slot = 0
        for j, n in enumerate(use):
            for _ in range(n):
                out.add(following[j], bins, 1, slot)
                following[j], slot = following[j] + times, slot + 1
        bins += times
    return out, bins


def place_small(counts: dict[int, int], free: dict[int, int], begin: int, how: Packing) -> tuple[Intervals, int]:
    """Best fit of the small pieces into bins ranked by free space; returns the places and the number of bins.

    Ranks of small pieces begin at ``begin``, longest first.  New bins are
    numbered after the given ones.
    """
    out, bins = Intervals(), 0
    runs: dict[int, list[tuple[int, int]]] = {}
    open_ = 0  # bit f is set where bins with free space f are left

    def put(space: int, first: int, n: int) -> None:
        nonlocal open_
        if n and space:
            runs.setdefault(space, []).append((first, n))
            open_ |= 1 << space

    for space in sorted(free):
        put(space, bins, free[space])
        bins += free[space]
    for size in sorted((s for s in counts if s <= how.small), reverse=True):
        left = counts[size]
        while left:
            fitting = open_ >> size
            if not fitting:
                n = -(-left // (how.capacity // size))
                put(how.capacity, bins, n)
                bins += n
                continue
            space = size + (fitting & -fitting).bit_length() - 1
            first, n = runs[space].pop()
            if not runs[space]:
                open_ &= ~(1 << space)
            each, at = space // size, how.capacity - space
            full = min(n, left // each)
            if full:
                out.add(begin, first, each, at)
                begin, left = begin + full * each, left - full * each
                put(space - each * size, first, full)
                first, n = first + full, n - full
            if n and left:  # fewer than a bin takes
                out.add(begin, first, left, at)
                put(space - left * size, first, 1)
                begin, left, first, n = begin + left, 0, first + 1, n - 1
            put(space, first, n)
    return out, bins


def _looked_up(pieces: DataFrame, intervals: Intervals, small: bool) -> DataFrame:
    """``pieces`` with ``bin`` and ``at`` from their ``rank``; a small piece's offset is worked out from its length."""
    shared = pieces.sparkSession.sparkContext.broadcast(intervals.arrays())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, bin_, each, at = shared.value
        for batch in batches:
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            k = np.searchsorted(begin, rank, "right") - 1
            further = rank - begin[k]
            place = at[k]
            if small:
                place = place + further % each[k] * batch.column("length").to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(bin_[k] + further // each[k]), pa.array(place)], names=[*batch.schema.names, "bin", "at"]
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return map_batches(pieces, run, f"{kinds}, bin long, at long")


def _counts(rows: DataFrame, column: str) -> dict[int, int]:
    """Rows of each value of a column that has at most ``capacity`` values."""
    return {r[column]: r["n"] for r in rows.groupBy(column).agg(F.count("*").alias("n")).collect()}


def pack_documents(docs: DataFrame, how: Packing = Packing(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece of every document.

    A document is its tokens and the closing id, so NULL and empty texts are
    pieces of one token.  Only documents longer than a sequence are cut.
    Repeated rows and rows without id are documents of their own.  An empty
    table gives an empty result; columns besides id and text are not read.
    """
    pieces = materialize(cut_pieces(docs, how, id_col, text_col).withColumn("_tie", F.monotonically_increasing_id()), "pieces")
    lengths = _counts(pieces, "length")
    ranked = materialize(with_rank(pieces, F.col("length").desc(), F.col("_tie")).drop("_tie"), "ranked-pieces")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    intervals, _ = place_large(lengths, how)
    large = ranked.where(F.col("length") > how.small)
    by_bin = W.partitionBy("bin")
    before = F.coalesce(F.sum("length").over(by_bin.orderBy("at").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = _looked_up(large, intervals, small=False)
    free = (F.lit(how.capacity) - F.sum("length").over(by_bin)).alias("free")
    placed = materialize(placed.select(*columns, "bin", "at", before.alias("offset"), free), "large-pieces")
    bins = with_rank(placed.where("at = 0").select("bin", "free"), F.col("free"), F.col("bin"), name="sequence_id")
    spaces = _counts(bins, "free")
    first = placed.drop("free").join(bins.select("bin", "sequence_id"), "bin")

    begin = sum(n for s, n in lengths.items() if s > how.small)
    intervals, _ = place_small(lengths, spaces, begin, how)
    rest = _looked_up(ranked.where(F.col("length") <= how.small), intervals, small=True)
    rest = rest.select(*columns, F.col("bin").alias("sequence_id"), F.col("at").alias("offset"))
    return first.select(*columns, "sequence_id", "offset").union(rest)
