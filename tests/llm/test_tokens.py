from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from tests.llm import edges
from tidemark.llm.arrow import vocabulary_path
from tidemark.llm.token_counts import boundary_machine, compose_maps, count_tokens, token_counts, transducer
from tidemark.llm.token_files import UnitEncoder, token_file_report

tokenizers = pytest.importorskip("tokenizers")
ALPHABET = " \n\t'''strevmld aAé1٣!!#€ ​漢🙂İſΣς\x1c\x85　ö̸ "


def library(name):
    return tokenizers.Tokenizer.from_file(vocabulary_path(name))


def odd_texts(seed):
    rng = random.Random(seed)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(600)]
    texts += ["".join(chr(rng.choice([rng.randint(1, 255), rng.randint(256, 0xD7FF), rng.randint(0xE000, 0x10FFFF)])) for _ in range(30)) for _ in range(200)]
    texts += ["", " " * 300, "a" * 3000, "'ll'LL're it's", "x<|endoftext|>", "a b<|endoftext|>  <|startoftext|> x", "\n\n ok  "]
    return texts


def test_transducer_counts_are_the_librarys():
    texts, machine = odd_texts(1), transducer(vocabulary_path("byte_bpe_50k.json"))
    expected = [len(e.ids) for e in library("byte_bpe_50k.json").encode_batch(texts, add_special_tokens=False)]
    assert count_tokens(texts, machine).tolist() == expected
    machine.max_states = 10  # compiled anew before each slice
    assert count_tokens(texts[:200], machine).tolist() == expected[:200]
    machine.max_states = 1 << 17


def test_prefix_scan_of_state_maps():
    rng = np.random.default_rng(0)
    maps = rng.integers(0, 8, (13, 8)).astype(np.uint8)
    scanned, so_far = compose_maps(maps), np.arange(8)
    for k, m in enumerate(maps):
        so_far = m[so_far]
        assert (scanned[k] == so_far).all()
    nxt, begins = boundary_machine()
    assert nxt.max() < 8 and begins[:, 9].all()


def test_unit_encoding_is_the_librarys():
    texts, tool = odd_texts(2), UnitEncoder(vocabulary_path("word_bpe_49k.json"), 1)
    expected = library("word_bpe_49k.json").encode_batch(texts, add_special_tokens=False)
    assert tool.encode(texts) == [np.array([*e.ids, 1], "<u2").tobytes() for e in expected]


def test_token_files_round_trip(spark):
    rows = sorted(edges.rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    got = token_file_report(edges.docs(spark)).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [r[0] for r in rows]
    at = 0
    for row, out in zip(rows, got, strict=True):
        ids = [*library("word_bpe_49k.json").encode(row[1] or "", add_special_tokens=False).ids, 1]
        assert (out["start"], out["n_tokens"]) == (at, len(ids))
        assert out["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_file_report(edges.empty(spark)).count() == 0


def test_token_counts_of_awkward_rows(spark):
    got = token_counts(edges.docs(spark)).collect()
    lib = library("byte_bpe_50k.json")
    expected = sorted((len((r[1] or "").encode()), len(lib.encode(r[1] or "").ids)) for r in edges.rows())
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == expected
    assert all(r["over_limit"] == (r["n_tokens"] > 1024) for r in got)
    assert token_counts(edges.empty(spark)).count() == 0


def test_vocabularies_that_cannot_be_cut_are_refused():
    with pytest.raises(ValueError, match="folds case"):
        UnitEncoder(vocabulary_path("byte_bpe_50k.json"), 0)


def test_units_of_known_words_need_no_library():
    """Case and last marks are no reason to encode a word again; a full memo goes on with its last batch."""
    tool = UnitEncoder(vocabulary_path("word_bpe_49k.json"), 1)
    texts = ["Some WORDS, here!\nHere?! words... Élan.", "so;e"]
    expected = [np.array([*library("word_bpe_49k.json").encode(t, add_special_tokens=False).ids, 1], "<u2").tobytes() for t in texts]
    assert tool.encode(["here words some élan x! x?! x, x. x..."]) and tool.encode(["so;e"])
    tool.model = tool.tokenizer = None
    assert tool.encode(texts) == expected


def test_a_full_memo_keeps_what_its_last_batch_needs(monkeypatch):
    from tidemark.llm import token_files

    monkeypatch.setattr(token_files, "MAX_CACHED", 20)
    tool, texts = UnitEncoder(vocabulary_path("word_bpe_49k.json"), 1), [f"Word{chr(97 + k)}, it's {'y' * 70}! x{k}." for k in range(26)]
    expected = [np.array([*library("word_bpe_49k.json").encode(t, add_special_tokens=False).ids, 1], "<u2").tobytes() for t in texts]
    assert tool.encode(texts) == expected and tool.encode(texts) == expected
    assert max(map(len, tool.known)) <= token_files.MAX_UNIT
    assert all(tool.encode([t]) == [e] for t, e in zip(texts, expected, strict=True)) and len(tool.known) < 60
