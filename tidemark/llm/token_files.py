"""Token-ID output: flat unsigned integer files with 64-bit document offsets.

The corpus is range-partitioned by document id, so that shard ``k`` holds
smaller ids than shard ``k + 1``.  One task writes one shard of three files:
``.ids`` (little-endian unsigned integers of the least width that holds the
vocabulary), ``.off`` (``n_docs + 1`` offsets, unsigned 64-bit) and ``.doc``
(document ids, signed 64-bit).  A shard's base in the whole stream is the
prefix sum of the shard sizes before it.  Files are written under a
temporary name and moved into place, so a retried task replaces its own.

Files go through ``pyarrow.fs`` to the shared folder; local ones are read by
memory map.
"""

from __future__ import annotations

import os
import uuid
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.arrow import BATCH_BYTES, gathered, map_batches, text_slices, vocabulary_path
from tidemark.llm.byte_pieces import MARKS, byte_text
from tidemark.llm.columns import text_rows
from tidemark.session import staging_path

#: Stands for a NULL document id in ``.doc`` files (such rows come first).
NULL_ID = -(2**63)
#: Units remembered in a worker, and the longest of them.
MAX_CACHED, MAX_UNIT = 800_000, 64


class UnitEncoder:
    """Encodes batches of texts with the tokenizers library, each distinct unit between ASCII blanks once.

    Exact for vocabularies whose patterns fold case, drop blanks and span
    neither blanks nor the border between a letter and a mark: the ids of a
    text are then those of its units in order, and the ids of a unit those of
    its folded word and of its last marks.  A Latin-1 word of
    letters is one pre-token and goes straight to the library's model;
    everything else, and what might hold a special string, goes through the
    whole library.
    """

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        top = max(self.tokenizer.get_vocab_size(with_added_tokens=True) - 1, end_id)
        self.dtype = np.dtype("<u2" if top < 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        self.end = self._raw([end_id])
        self.known: dict[str, bytes] = {"": b""}
        self.check()

    def check(self) -> None:
        """Vocabularies that cannot be cut at blanks and last marks are an error."""
        probe = "The cat's 12 Dogs, in the U.S.\nhello.World  (x), it's 3.5: so?! one; \t\xc4pfel. Caf\xe9, \xaa\xb5\xdf end."
        whole = [self._alone(probe) + self.end]
        try:
            same = self.encode([probe]) == whole
        except Exception:  # a model of another kind may refuse the vocabulary's byte characters
            same = False
        if not same:
            raise ValueError("not a vocabulary that folds case, drops blanks and splits off full stops and commas")

    def _raw(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def _alone(self, text: str) -> bytes:
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _joined(self, words: list[str]) -> list[bytes]:
        """Ids of Latin-1 words without blanks: one call for many, cut apart by the tokens' offsets."""
        out = []
        for at in range(0, len(words), 2000):
            part = words[at : at + 2000]
            found = self.tokenizer.encode("\n".join(part), add_special_tokens=False)
            raw = self._raw(found.ids)
            begins = np.array([b for b, _ in found.offsets], np.int64)
            borders = np.cumsum([0, *(len(w) + 1 for w in part)])
            cuts = (np.searchsorted(begins, borders) * self.dtype.itemsize).tolist()
            out += [raw[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return out

    def units(self, units: list[str]) -> list[bytes]:
        """Ids of distinct units without ASCII blanks."""
        known, model, code = self.known, self.model, self.code
        out = list(map(known.get, units))
        rest = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            unit = units[k]
            body = unit.rstrip(MARKS)
            if not body.isalpha() or len(unit) > MAX_UNIT or not (body.isascii() or _latin(body)):
                rest.append(k)
                continue
            word = body.lower()
            ids = known.get(word)
            if ids is None:
                ids = array(code, [t.id for t in model(word if word.isascii() else byte_text(word))]).tobytes()
                known[word] = ids
            if len(body) < len(unit):
                ids += self._marks(unit[len(body) :])
            known[unit] = out[k] = ids
        if rest:
            special = "<|" in "".join([units[k] for k in rest])
            plain = [u for u in (units[k] for k in rest) if len(u) <= MAX_UNIT and _latin(u) and not (special and "<|" in u)]
            known.update(zip(plain, self._joined(plain), strict=True))
            for k in rest:
                unit = units[k]
                out[k] = known[unit] if unit in known else self._alone(unit)
                if len(unit) <= MAX_UNIT:
                    known[unit] = out[k]
        if len(known) > MAX_CACHED:  # go on with those of this batch
            self.known = {"": b""} | {u: ids for u, ids in zip(units, out, strict=True) if len(u) <= MAX_UNIT}
        return out

    def _marks(self, marks: str) -> bytes:
        """Ids of a run of marks, which is one pre-token."""
        ids = self.known.get(marks)
        if ids is None:
            ids = self._alone(marks)
            if len(marks) <= MAX_UNIT:
                self.known[marks] = ids
        return ids

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch in one array, and the borders of its texts; NULL is empty, the end id closes each."""
        lists = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = pc.list_flatten(lists).dictionary_encode()
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        index = coded.indices.to_numpy(zero_copy_only=False)
        return gathered(self.units(coded.dictionary.to_numpy(zero_copy_only=False).tolist()), index, counts, self.dtype, self.end)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, with the end id, as bytes."""
        flat, stops = self.encode_batch(pa.array(texts, pa.string()))
        return [flat[a:b].tobytes() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


def _latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(path: str, end_id: int) -> UnitEncoder:
    return UnitEncoder(path, end_id)


def _file_system(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def placed(spark: SparkSession, folder: str) -> str:
    """``folder`` with the scheme that Spark itself writes it under.

    A path without one belongs to the cluster's default file system, which
    tasks can only know from Spark: a row written there tells.
    """
    spark.range(1, numPartitions=1).write.mode("overwrite").parquet(f"{folder}/place")
    return spark.read.parquet(f"{folder}/place").inputFiles()[0].rsplit("/place/", 1)[0]


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "word_bpe_49k.json",
    end_id: int = 1,
) -> tuple[str, list[dict]]:
    """Write the shards; returns the folder and the manifest in shard order.

    The manifest has one entry per non-empty shard (``part, n_docs,
    n_tokens, width, base``), as many as there are shuffle partitions; the
    driver sees nothing else.  Rows with equal ids are ordered by their text.
    """
    spark = docs.sparkSession
    folder = placed(spark, folder or staging_path(spark, "token-files"))
    job = uuid.uuid4().hex

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(vocabulary_path(vocabulary), end_id)
        part, attempt = TaskContext.get().partitionId(), TaskContext.get().taskAttemptId()
        store, root = _file_system(folder)
        store.create_dir(root, recursive=True)
        names = {kind: f"{root}/part-{part:06d}.{kind}" for kind in ("ids", "off", "doc")}
        streams, at, n_docs = {}, 0, 0
        for piece in text_slices(batches, max_bytes=BATCH_BYTES):
            if not streams:
                streams = {k: store.open_output_stream(f"{n}.{job}-{attempt}") for k, n in names.items()}
                streams["off"].write(np.zeros(1, "<u8").tobytes())
            flat, stops = tool.encode_batch(piece.column("text"))
            streams["ids"].write(flat.tobytes())
            streams["off"].write((at + stops[1:]).astype("<u8").tobytes())
            at, n_docs = at + int(stops[-1]), n_docs + piece.num_rows
            ids = piece.column("doc_id").fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            streams["doc"].write(ids.astype("<i8").tobytes())
        for kind, stream in streams.items():
            stream.close()
            if store.get_file_info(names[kind]).type != pafs.FileType.NotFound:
                store.delete_file(names[kind])
            store.move(f"{names[kind]}.{job}-{attempt}", names[kind])
        if n_docs:
            columns = [[part], [n_docs], [at], [tool.dtype.itemsize]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["part", "n_docs", "n_tokens", "width"]
            )

    rows = text_rows(docs, id_col, text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")
    )
    ordered = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    written = map_batches(ordered, write, "part long, n_docs long, n_tokens long, width long").collect()
    manifest, base = [], 0
    for shard in sorted((r.asDict() for r in written), key=lambda r: r["part"]):
        manifest.append(shard | {"base": base})
        base += shard["n_tokens"]
    return folder, manifest


def _ids(store: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    """A whole file as an array: memory-mapped where local."""
    if isinstance(store, pafs.LocalFileSystem):
        return np.memmap(path, dtype, mode="r")
    return np.frombuffer(store.open_input_file(path).read(), dtype)


def read_token_files(spark: SparkSession, folder: str, manifest: list[dict], block: int = 2048) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read back from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _file_system(folder)
        for batch in batches:
            for k in batch.column("id").to_pylist():
                shard = manifest[k]
                name = f"{root}/part-{shard['part']:06d}"
                ids = _ids(store, f"{name}.ids", f"<u{shard['width']}")
                off, doc = _ids(store, f"{name}.off", "<u8"), _ids(store, f"{name}.doc", "<i8")
                for a in range(0, shard["n_docs"], block):
                    cut = off[a : a + block + 1].astype(np.int64)
                    sums = [
                        zlib.crc32(ids[s:e].astype("<u4").tobytes())
                        for s, e in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)
                    ]
                    own = np.asarray(doc[a : a + block])
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(own, mask=own == NULL_ID),
                            pa.array(shard["base"] + cut[:-1]),
                            pa.array(np.diff(cut)),
                            pa.array(sums, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    shards = spark.range(0, len(manifest), 1, numPartitions=max(1, len(manifest)))
    return shards.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_file_report(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1) -> DataFrame:
    """Write the token files of ``docs`` and read one row per document back from them.

    NULL text is empty: its document holds the end id alone.  A NULL id
    sorts first and comes back NULL; repeated ids keep their rows, in the
    order of the text's hash; an empty table writes no file and gives no row.
    Columns besides id and text are not read.
    """
    folder, manifest = write_token_files(docs, vocabulary=vocabulary, end_id=end_id)
    return read_token_files(docs.sparkSession, folder, manifest)
