"""MinHash near-duplicates verified by odd sketches.

Every distinct shingle set gets ``BANDS * ROWS`` MinHash samples.  Bands of
them make candidate buckets; all samples are folded into a parity bitmap (the
odd sketch), whose XOR with another one counts the samples in which two sets
differ, so a population count estimates their similarity well where it is
high.  Pairs that the sketch does not rule out are confirmed on the full
sets, recomputed from the whole texts.

No group is expanded into all its pairs:

1. Equal sets are one node from the start.
2. In each bucket every node is compared with the bucket's hub, the node with
   the largest buckets of its own; a node confirms the best hub it has.
3. Nodes of a bucket that are still in different components have to be told
   apart.  Two sets can only reach the threshold if the rarest shingles of
   both, a fixed share of their sizes, have one in common; nodes that share
   none with a node of another component are done, however many of them a
   common template puts into one bucket.
4. The others are compared inside blocks of bounded size that carry the full
   sets; a node leaves a block with at most one link to each other component.

Steps 3 and 4 cover every pair of a bucket that is not linked yet, so no
candidate is dropped.  A pair of similarity 0.75 misses all bands with probability
5e-6, and its sketch is ruled out with probability below 1e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import map_batches, text_slices
from tidemark.llm.columns import text_rows
from tidemark.llm.components import connected_components
from tidemark.operators.lineage import materialize

SHINGLE = 5
#: Linked if PERCENT * union <= 100 * intersection (fixed value of the contract).
PERCENT = 75
BANDS, ROWS = 32, 4
SKETCH_BITS = 512
#: Bits in which the sketches of a pair at the threshold may differ: 57 expected, 5.4 deviations more.
SKETCH_LIMIT = 112
BLOCK = 512
#: Members that are sent with one copy of their hub's text.
HUB_CHUNK = 1024
#: Cells in which the shingles of open buckets are counted; a shared cell only makes a shingle look more common.
CELLS = 1 << 20
#: Parts in which the nodes of one component are named.
SALT = 16

_RNG = np.random.default_rng(20_240_611)
_PLACE = _RNG.integers(1, 1 << 63, SHINGLE, dtype=np.uint64) | np.uint64(1)
_SAMPLE = _RNG.integers(1, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64) | np.uint64(1)
_SHIFT = _RNG.integers(0, 1 << 63, (BANDS * ROWS, 1), dtype=np.uint64)
_SLOT = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    limit = 500_000

    def __missing__(self, word: bytes) -> int:
        value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        if len(self) < self.limit:
            self[word] = value
        return value


_HASHES = WordHashes()


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the 5-word shingles; with fewer words, of the whole sequence."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_HASHES) >= _HASHES.limit:
        _HASHES.clear()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    wide = min(SHINGLE, len(words))
    total = np.full(len(words) - wide + 1, wide, np.uint64)
    for k in range(wide):
        total += hashes[k : len(words) - wide + 1 + k] * _PLACE[k]
    return np.unique(mixed(total))


@dataclass
class Signature:
    node: int
    bands: np.ndarray
    sketch: np.ndarray


def min_samples(members: np.ndarray) -> np.ndarray:
    """The least value of each of the sample functions over a set (in pieces of bounded size)."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(members), 1024):
        least = np.minimum(least, (members[at : at + 1024] * _SAMPLE + _SHIFT >> np.uint64(24)).min(axis=1))
    return least


def signature(members: np.ndarray) -> Signature:
    node = int.from_bytes(hashlib.blake2b(members.tobytes(), digest_size=8).digest(), "little", signed=True)
    least = min_samples(members)
    rows = least.reshape(BANDS, ROWS)
    band = np.arange(1, BANDS + 1, dtype=np.uint64)
    for k in range(ROWS):
        band = mixed(band * _SLOT[k] + rows[:, k])
    slots = (mixed(least * _SLOT + _SLOT) % np.uint64(SKETCH_BITS)).astype(np.int64)
    parity = (np.bincount(slots, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return Signature(node, band.view(np.int64), np.packbits(parity).view(np.int64))


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_hash, n_shingles, node, bands, sketch)`` per document; the last three NULL for an empty set."""
    rows = text_rows(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            sizes, found = [], []
            for text in part.column("text").to_pylist():
                members = shingle_set(text)
                sizes.append(len(members))
                found.append(signature(members) if len(members) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text_hash"),
                    pa.array(sizes, pa.int64()),
                    pa.array([s and s.node for s in found], pa.int64()),
                    pa.array([None if s is None else s.bands for s in found], pa.list_(pa.int64())),
                    pa.array([None if s is None else s.sketch for s in found], pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "node", "bands", "sketch"],
            )

    return map_batches(
        rows, run, f"doc_id {kind}, text_hash long, n_shingles long, node long, bands array<long>, sketch array<long>"
    )


def differing_bits(a: Column, b: Column) -> Column:
    """Population count of the XOR of two sketches."""
    total = F.lit(0)
    for k in range(SKETCH_BITS // 64):
        total = total + F.bit_count(a[k].bitwiseXOR(b[k]))
    return total


def confirm(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``(a, b)`` of nodes whose full shingle sets reach the threshold; ``a`` is the hub of ``b``.

    ``texts`` holds the whole text of one document of each candidate node.  A
    hub's text is sent once for each ``HUB_CHUNK`` of its members and stands
    before them, so neither a pair nor a task carries more than its own texts.
    """
    chunks = pairs.groupBy("a").agg(F.ceil(F.count("*") / HUB_CHUNK).cast("int").alias("chunks"))
    hub = texts.select(F.col("node").alias("a"), "text").join(chunks, "a")
    hub = hub.select("a", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(None).cast("long").alias("b"), "text")
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks")).cast("int").alias("chunk")
    dealt = pairs.join(chunks, "a").select("a", chunk, "b")
    rows = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "chunk", "b", "text")
    together = hub.unionByName(rows).repartition("a", "chunk").sortWithinPartitions("a", "chunk", F.col("b").asc_nulls_first())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = np.zeros(0, np.uint64)
        for part in text_slices(batches):
            a, b = part.column("a").to_pylist(), part.column("b").to_pylist()
            good = []
            for k, text in enumerate(part.column("text").to_pylist()):
                members = shingle_set(text)
                if b[k] is None:
                    left = members
                    continue
                both = len(np.intersect1d(left, members, assume_unique=True))
                if 100 * both >= PERCENT * (len(left) + len(members) - both):
                    good.append(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array([c[k] for k in good], pa.int64()) for c in (a, b)], names=["a", "b"]
            )

    return map_batches(together, run, "a long, b long")


def _rooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket members with the root of their component (themselves if unlinked)."""
    roots = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    return members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))


def _open_buckets(members: DataFrame) -> DataFrame:
    """``(band, size, most)`` of the buckets that still hold several components; ``most`` is the largest one."""
    counts = members.groupBy("band", "root").agg(F.count("*").alias("n"))
    sizes = counts.groupBy("band").agg(
        F.count("*").alias("roots"), F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("most")
    )
    return sizes.where("roots > 1").drop("roots")


def _blocks(members: DataFrame) -> DataFrame:
    """Rows of the buckets that still hold several components, dealt to blocks of about BLOCK rows.

    In a bucket only the rows outside its largest component (``side`` 0) meet
    all rows (``side`` 1).  Both sides are dealt by a hash, so a block holds
    at most BLOCK times BLOCK comparisons whatever the bucket's size.
    """
    open_ = _open_buckets(members).select(
        "band",
        F.col("most.root").alias("main"),
        F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.col("size") - F.col("most.n")) / BLOCK).cast("int").alias("rest_blocks"),
    )
    rows = members.select("band", "node", "root").join(open_, "band")
    own = lambda n: F.pmod(F.xxhash64("node"), n).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    kept = [F.lit(0).alias("side"), "node", "root", "main"]
    rest = rows.where("root <> main").select("band", own(F.col("rest_blocks")).alias("i"), each(F.col("blocks")).alias("j"), *kept)
    every = rows.select(
        "band", each(F.col("rest_blocks")).alias("i"), own(F.col("blocks")).alias("j"), F.lit(1).alias("side"), *kept[1:]
    )
    return rest.union(every)


def _full_sets(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """``nodes`` (node, root) with the full shingle set, the bands and the sketch, computed once a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            found = [shingle_set(t) for t in part.column("text").to_pylist()]
            signed = [signature(m) for m in found]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("node"),
                    part.column("root"),
                    pa.array([m.tobytes() for m in found], pa.binary()),
                    pa.array([s.bands.tobytes() for s in signed], pa.binary()),
                    pa.array([s.sketch.tobytes() for s in signed], pa.binary()),
                ],
                names=["node", "root", "members", "bands", "sketch"],
            )

    wanted = texts.join(nodes, "node").select("node", "root", "text")
    return materialize(map_batches(wanted, run, "node long, root long, members binary, bands binary, sketch binary"), "open-sets")


def rare_prefixes(members: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rarest shingles of a set by which a partner must show itself, and which of them count on its smaller side.

    With the shingles in one order for all sets, a set of ``n`` shares one of
    its first ``n - ceil(0.75 n) + 1`` with any partner, and one of its first
    ``n - ceil(6 n / 7) + 1`` with any partner that is not smaller: those are
    0.75 and 2 * 0.75 / 1.75 of it, the least overlaps with such partners.
    Shingles that no other set can hold are left out.
    """
    n = len(members)
    often = counts[members % np.uint64(CELLS)]
    order = np.lexsort((members, often))[: n - -(-PERCENT * n // 100) + 1]
    short = np.arange(len(order)) <= n - -(-2 * PERCENT * n // (100 + PERCENT))
    shared = often[order] > 1
    return members[order][shared], short[shared]


def partnered(sets: DataFrame) -> DataFrame:
    """The nodes that share one of their rarest shingles with a node of another component."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CELLS, np.int64)
        for batch in batches:
            for members in batch.column("members").to_pylist():
                total += np.bincount((np.frombuffer(members, np.uint64) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["cell", "n"])

    cells = map_batches(sets.select("members"), count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    table = cells.toArrow()
    counts = np.zeros(CELLS, np.int64)
    counts[table.column("cell").to_numpy()] = table.column("n").to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(counts)

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, root = (batch.column(c).to_numpy() for c in ("node", "root"))
            for k, members in enumerate(batch.column("members").to_pylist()):
                rare, short = rare_prefixes(np.frombuffer(members, np.uint64), shared.value)
                if len(rare):
                    same = lambda v, n=len(rare): pa.array(np.full(n, v))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(rare.view(np.int64)), same(node[k]), same(root[k]), pa.array(short)],
                        names=["shingle", "node", "root", "short"],
                    )

    rows = map_batches(sets.select("node", "root", "members"), prefixes, "shingle long, node long, root long, short boolean")
    rows = materialize(rows, "rare-shingles")
    groups = rows.groupBy("shingle").agg(F.min("root").alias("a"), F.max("root").alias("b"), F.bool_or("short").alias("any"))
    met = groups.where("a <> b AND any").select("shingle")
    return rows.join(met, "shingle", "left_semi").select("node").distinct()


def link_block(rows: list[dict], band: int) -> list[tuple[int, int]]:
    """Links of a block: for each row outside the main component, one link to each other component.

    A pair belongs to the first band that both have in common, so that it is
    compared once, however many buckets it shares.
    """
    left, right = ([r for r in rows if r["side"] == side] for side in (0, 1))
    if not left or not right:
        return []
    table = lambda rs, c, kind: np.stack([np.frombuffer(r[c], kind) for r in rs])
    bands, sketch = table(right, "bands", np.int64), table(right, "sketch", np.uint64)
    node, root = (np.array([r[c] for r in right], np.int64) for c in ("node", "root"))
    sets = [np.frombuffer(r["members"], np.uint64) for r in right]
    sizes = np.array([len(m) for m in sets])
    links = []
    for x in left:
        near = (root != x["root"]) & ((root == x["main"]) | (node > x["node"]))
        at = np.flatnonzero(near)
        bits = np.bitwise_count(sketch[at] ^ np.frombuffer(x["sketch"], np.uint64)).sum(axis=1)
        at = at[bits <= SKETCH_LIMIT]
        own = np.frombuffer(x["bands"], np.int64)
        shared = bands[at] == own
        at = at[own[shared.argmax(axis=1)] == band] if len(at) else at
        if not len(at):
            continue
        mine = np.frombuffer(x["members"], np.uint64)
        pool = np.concatenate([sets[k] for k in at])
        hit = mine[np.minimum(np.searchsorted(mine, pool), len(mine) - 1)] == pool
        both = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(sizes[at])[:-1]]))
        good = at[100 * both >= PERCENT * (len(mine) + sizes[at] - both)]
        _, one = np.unique(root[good], return_index=True)
        links += [(min(x["node"], int(node[k])), max(x["node"], int(node[k]))) for k in good[one]]
    return links


def open_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between different components that share a bucket, confirmed on the full sets."""
    opened = members.join(_open_buckets(members), "band", "left_semi").select("node", "root").distinct()
    sets = _full_sets(opened, texts)
    left = materialize(members.join(partnered(sets), "node", "left_semi").select("band", "node", "root"), "left-members")
    blocks = materialize(_blocks(left), "blocks").join(sets.drop("root"), "node")
    keys = ["band", "i", "j"]
    dealt = blocks.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, links = [], None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (now := (row["band"], row["i"], row["j"])) != key:
                    links += link_block(held, key[0]) if held else []
                    held, key = [], now
                held.append(row)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])
                links = []
        links = link_block(held, key[0]) if held else []
        if links:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links, strict=True)], names=["a", "b"])

    return map_batches(dealt, run, "a long, b long").distinct()


def near_duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per document row.

    Documents are linked when their shingle sets have a Jaccard similarity
    of 0.75 or more; the component is named by its least ``doc_id``, and a row
    is ``kept`` if that is its own id.  NULL, empty and blank texts have an
    empty set, stand alone and are kept.  Rows that repeat a ``doc_id`` share
    the text's component and each get a row; a row without id joins its text's
    component, which is named by the ids it has (NULL if none, and then all its
    rows are kept).  :func:`drop_near_duplicates` lets exactly one row of every
    component survive.  An empty table gives an empty result; other columns are
    not read.
    """
    return _grouped(docs, id_col, text_col).select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of :func:`near_duplicate_groups` with their ``text_hash`` and whether the row ``survives`` for its component."""
    # the tie number is written with the row, so that it tells rows of one id and text apart
    signed = materialize(signatures(docs, id_col, text_col).withColumn("tie", F.monotonically_increasing_id()), "signatures")
    # equal sets: one node, represented by the row of least id (ids may be NULL or repeat with other texts)
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "tie")
    sets = signed.where("node IS NOT NULL").groupBy("node").agg(F.min(row).alias("row"))
    sets = materialize(sets.select("node", "row.doc_id", "row.text_hash", "row"), "nodes")
    same_row = lambda a, b: a["doc_id"].eqNullSafe(b["doc_id"]) & (a["text_hash"] == b["text_hash"])
    firsts = signed.join(sets, (signed["node"] == sets["node"]) & same_row(signed, sets), "left_semi").dropDuplicates(["node"])
    spread = materialize(firsts.select("node", F.explode("bands").alias("band")), "bands")
    buckets = spread.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    held = materialize(spread.join(buckets, "band"), "buckets")
    weights = held.groupBy("node").agg(F.sum("size").alias("weight"))
    sketches = firsts.select("node", "sketch").join(weights, "node")
    members = materialize(held.select("band", "node").join(sketches, "node"), "members")
    hubs = members.groupBy("band").agg(F.max(F.struct("weight", "node", "sketch")).alias("hub"))
    hubs = hubs.select("band", F.col("hub.node").alias("a"), F.col("hub.weight").alias("wa"), F.col("hub.sketch").alias("sa"))
    bits = differing_bits(F.col("sa"), F.col("sketch"))
    starred = members.join(hubs, "band").where((F.col("a") != F.col("node")) & (bits <= SKETCH_LIMIT))
    best = starred.groupBy("node").agg(F.min(F.struct(bits.alias("bits"), F.lit(0) - F.col("wa"), F.col("a").alias("a"))).alias("hub"))
    first_pairs = materialize(best.select(F.col("hub.a").alias("a"), F.col("node").alias("b")), "hub-pairs")

    # whole texts of the nodes that share a bucket, written once for both rounds
    wanted = members.select("node").distinct().join(sets, "node")
    own = text_rows(docs, id_col, text_col).withColumn("text_hash", F.xxhash64("text"))
    placed = own.join(wanted, same_row(own, wanted)).select("node", "text")
    texts = materialize(placed.dropDuplicates(["node"]), "candidate-texts")

    links = materialize(confirm(first_pairs, texts), "hub-links")
    links = links.union(materialize(open_links(_rooted(members, links), texts), "open-links"))

    roots = materialize(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), "roots")
    # the surviving row of a component, by (doc_id with NULL last, text hash, tie number); a component may hold a
    # third of all nodes, so its name goes back to them in SALT parts, and nodes without links need no name
    linked = sets.join(roots, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALT)))
    named = linked.groupBy("root").agg(F.min("row").alias("first"))
    named = named.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALT - 1).cast("long"))))
    names = linked.join(named, ["root", "salt"]).select("node", "first")
    names = names.union(sets.join(roots, "node", "left_anti").select("node", F.col("row").alias("first")))
    names = names.select("node", F.col("first.doc_id").alias("component_id"), F.col("first.tie").alias("kept_tie"))
    names = materialize(names, "names")
    alone = F.col("node").isNull()
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "node", "tie")
        .join(names, "node", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
            (alone | (F.col("tie") == F.col("kept_tie"))).alias("survives"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group (and every row whose text has no words)."""
    keys = [F.col("doc_id").alias("_kept_id"), F.col("text_hash").alias("_kept_hash")]
    repeats = (F.count("*") > 1) & (F.max("n_shingles") > 0)
    rows = _grouped(docs, id_col, text_col).groupBy(*keys).agg(F.max("survives").alias("_kept"), repeats.alias("_repeats"))
    kept = materialize(rows.where("_kept").select("_kept_id", "_kept_hash", "_repeats"), "kept-rows")
    same_row = docs[id_col].eqNullSafe(kept["_kept_id"]) & (F.xxhash64(docs[text_col]) == kept["_kept_hash"])
    found = docs.join(kept, same_row)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    once = found.where("NOT _repeats").select(*columns)
    if kept.where("_repeats").isEmpty():
        return once
    # rows of one id and one text: any of them
    return once.union(found.where("_repeats").dropDuplicates(["_kept_id", "_kept_hash"]).select(*columns))
