from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.conftest import SF_SMALL
from tidemark.llm.arrow import vocabulary_path
from tidemark.llm.byte_pieces import BytePieces, byte_pieces

NAME = "byte_bpe_50k.json"


def library(texts, end):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(NAME))
    return [[*t.encode(x or "", add_special_tokens=False).ids, *([] if end is None else [end])] for x in texts]


def pieces(texts, end):
    ids, stops = byte_pieces(NAME).encode(pa.array(texts, pa.string()), end)
    return [ids[a:b].tolist() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)]


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a \n b", "a\n\nb c", "x\x1c y \x1dz", "don't  we'll\t it's", "<|endoftext|>",
       "a <|endoftext|> b", "a<|end of text|>  c", "é　 ü x \xa0 y", "漢字 漢字", "🙂 🙂🙂 \x85 z", "!\x1f ! ?", "1 22  333 4444", "\n", "a\n", "a\u2003 b \u3000c", "a\u1680 \u2028b"]


@pytest.mark.parametrize("end", [None, 0])
def test_odd_texts(end):
    assert pieces(ODD, end) == library(ODD, end)
    assert pieces([], end) == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab1!'s <|>\n\t\r\x1c\x1f\x85\xa0 é漢🙂\u2003\u2028\u180e\u200b"), max_size=24) | st.none(), max_size=5))
def test_any_texts(texts):
    assert pieces(texts, 0) == library(texts, 0)


def test_corpus():
    texts = pq.read_table(f"{SF_SMALL}/documents.parquet").column("text").to_pylist()
    assert pieces(texts, 0) == library(texts, 0)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        BytePieces(vocabulary_path("word_bpe_49k.json"))
    assert byte_pieces(NAME).encode(pa.array([], pa.string()))[0].dtype == np.uint32


def test_pieces_of_known_words_need_no_library():
    """Last marks and line breaks are no reason to encode a word again."""
    tool, texts = BytePieces(vocabulary_path(NAME)), ["So here, a word?! élan.\nNext word.", "So a\nNext!"]
    tool.encode(pa.array(["So a here word élan x, x?! x. x!\nNext x", "Next"]), 0)
    tool.model = tool.tokenizer = None
    ids, stops = tool.encode(pa.array(texts), 0)
    assert [ids[a:b].tolist() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)] == library(texts, 0)


def test_a_full_memo(monkeypatch):
    from tidemark.llm import byte_pieces as module

    monkeypatch.setattr(module, "MAX_CACHED", 20)
    tool, texts = BytePieces(vocabulary_path(NAME)), [f"W{k} word{chr(97 + k)}, it's {'y' * 70}!\n{'z' * 70}\nEnd {'v' * 70}." for k in range(26)]
    for part in (texts, texts, texts[:1], texts[3:9]):
        ids, stops = tool.encode(pa.array(part), 0)
        assert [ids[a:b].tolist() for a, b in zip(stops[:-1].tolist(), stops[1:].tolist(), strict=True)] == library(part, 0)
    assert max(len(u) for known in tool.known.values() for u in known) <= module.MAX_UNIT
