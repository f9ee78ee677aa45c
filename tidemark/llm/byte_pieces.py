"""Token ids of byte-level BPE for whole Arrow batches of text.

A pre-token of the vocabulary's pattern never holds a blank after a
non-blank, so a text may be cut before each blank that follows a non-blank.
A batch is split at spaces by an Arrow kernel and coded as a dictionary; each
distinct piece is encoded once by the tokenizers library, apart from its last
marks and from what follows a line break, and the ids of the batch are
gathered from those of its pieces.  Texts
in which a space follows another blank are cut by a pattern instead, and texts
with special strings are left to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.arrow import gathered, vocabulary_path

#: The library's blanks; Python's ``isspace`` takes four control characters more.
_BLANK = r"\t-\r \x85\xa0  -     　"
_UNITS = re.compile(f"[{_BLANK}]*[^{_BLANK}]+|[{_BLANK}]+")
#: Letters and numbers among the code points below LATIN, which no version of Unicode changes any more.
LATIN = "ɐ"
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_NUMBER = r"0-9\xb2\xb3\xb9\xbc-\xbe"
#: Fixed value: the vocabulary's pre-token pattern, over those code points.
_PRE_TOKENS = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^{_BLANK}{_LETTER}{_NUMBER}]+"
    f"|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+"
)
_BEYOND_LATIN = re.compile(f"[^\x00-{chr(ord(LATIN) - 1)}]")
_VISIBLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
#: How the vocabulary writes bytes: visible ones as themselves, the others in order from U+0100.
_HIDDEN = sorted(set(range(256)) - _VISIBLE)
_BYTES = "".join(chr(b if b in _VISIBLE else 0x100 + _HIDDEN.index(b)) for b in range(256))
#: A piece between spaces that is empty, ends with a blank of either kind or may hold a special string.
_ODD_PIECE = r"(?:^|[\s\x0b\x1c-\x1f\x{85}\p{Z}])$|<\|"
#: Units remembered in a worker, and the longest of them.
MAX_CACHED, MAX_UNIT = 800_000, 64
#: Marks that are split off the end of a word; a run of them is one pre-token.
MARKS = ".,;:!?"


def byte_text(text: str) -> str:
    """``text`` as byte-level vocabularies write it, one character for each byte."""
    return charmap_decode(text.encode(), "strict", _BYTES)[0]


class BytePieces:
    """Encoder of a byte-level BPE vocabulary that has no normaliser and no prefix space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model.tokenize
        #: Ids of units that follow a space, without it, and of those that do not.
        self.known: dict[str, dict[str, bytes]] = {" ": {}, "": {}}
        self.line_break = self._alone(["\n"])[0]
        self.check()

    def check(self) -> None:
        """Only such vocabularies can be cut at blanks; others are an error."""
        probe = " it's 12 ab\n\nAB .,!x \xe4\xf6 we'll"
        whole = self.tokenizer.encode(probe, add_special_tokens=False).ids
        try:
            same = np.frombuffer(b"".join(self._joined([" it's 12 ab\n\nAB .,!x \xe4\xf6", " we'll"])), np.uint32).tolist() == whole
        except Exception:  # a model of another kind may refuse the vocabulary's byte characters
            same = False
        if not same or self.tokenizer.decode(whole) != probe:
            raise ValueError("not a byte-level vocabulary whose pre-tokens begin at blanks")

    def _alone(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch(texts, add_special_tokens=False)
        return [np.array(f.ids, np.uint32).tobytes() for f in found]

    def _joined(self, units: list[str]) -> list[bytes]:
        """Ids of units below LATIN that begin with a space and end without a blank, each pre-token encoded once."""
        parts = _PRE_TOKENS.findall("".join(units))
        own, model = {}, self.model
        for part in set(parts):
            own[part] = array("I", [t.id for t in model(byte_text(part))]).tobytes()
        ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
        cuts = np.searchsorted(ends, np.cumsum(np.fromiter(map(len, units), np.int64, len(units))), "right").tolist()
        ids, out, a = [own[p] for p in parts], [], 0
        for b in cuts:
            out.append(ids[a] if b - a == 1 else b"".join(ids[a:b]))
            a = b
        return out

    def _learn(self, units: list[str], lead: str) -> None:
        """Make units without line breaks between words known; ``lead`` is what stands before them."""
        known, model, bare = self.known[lead], self.model, self.known[""]
        ascii_lead = "\u0120" if lead else ""
        joined, other = [], []
        for unit in units:
            if unit in known:
                continue
            word = unit.rstrip(MARKS)
            if not word.isalpha() or len(unit) > MAX_UNIT or not (plain := word.isascii()) and _BEYOND_LATIN.search(word):
                simple = lead and unit and not unit[-1].isspace() and "<|" not in unit and not _BEYOND_LATIN.search(unit)
                (joined if simple else other).append(unit)
                continue
            ids = known.get(word)
            if ids is None:
                ids = array("I", [t.id for t in model(ascii_lead + word if plain else byte_text(lead + word))]).tobytes()
                known[word] = ids
            if len(word) < len(unit):
                marks = unit[len(word) :]
                if marks not in bare:
                    bare[marks] = self._alone([marks])[0]
                known[unit] = ids + bare[marks]
        if joined:
            known.update(zip(joined, self._joined([lead + u for u in joined]), strict=True))
        if other:
            known.update(zip(other, self._alone([lead + u for u in other]), strict=True))

    def units(self, units: list[str], lead: str) -> list[bytes]:
        """Ids of distinct units, each encoded as a text of its own that begins with ``lead`` (a space or nothing)."""
        known = self.known[lead]
        out = list(map(known.get, units))
        new = [k for k, ids in enumerate(out) if ids is None]
        if not new:
            return out
        # a single line break between words is a pre-token of its own
        lines = {k: p for k in new if "\n" in units[k] and (p := _lines(units[k]))}
        self._learn([units[k] for k in new if k not in lines] + [p[0] for p in lines.values()], lead)
        self._learn([word for p in lines.values() for word in p[1:]], "")
        bare = self.known[""]
        for k, (first, *rest) in lines.items():
            known[units[k]] = self.line_break.join([known[first], *map(bare.__getitem__, rest)])
        for k in new:
            out[k] = known[units[k]]
        for unit in {w for k in new if len(units[k]) > MAX_UNIT for w in (units[k], *lines.get(k, ())) if len(w) > MAX_UNIT}:
            known.pop(unit, None), bare.pop(unit, None)
        if sum(map(len, self.known.values())) > MAX_CACHED:  # go on with those of this batch
            self.known = {" ": {}, "": {}} | {lead: {u: ids for u, ids in zip(units, out, strict=True) if len(u) <= MAX_UNIT}}
        return out

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch in one array, and the borders of its texts; NULL is empty, ``end_id`` closes each."""
        lists = pc.split_pattern(texts.fill_null(""), " ")
        coded = pc.list_flatten(lists).dictionary_encode()
        pieces, index = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        borders = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))]).astype(np.int64)
        first = borders[:-1]
        odd_piece = pc.match_substring_regex(coded.dictionary, pattern=_ODD_PIECE).to_numpy(zero_copy_only=False)
        odd = np.add.reduceat(odd_piece[index].astype(np.int64), first) > 0 if len(first) else np.zeros(0, bool)
        # slots: pieces after a space, then first pieces and the units of odd texts
        more: dict[str, int] = {}
        slot = lambda u: more.setdefault(u, len(pieces) + len(more))
        index[first] = [slot(pieces[k]) for k in index[first].tolist()]
        counts = np.diff(borders)
        rows = np.flatnonzero(odd).tolist()
        if rows:
            parts, last = [], 0
            for row in rows:
                text = texts[row].as_py() or ""
                own = [text] if "<|" in text else _UNITS.findall(text)
                parts += [index[last : borders[row]], np.array([slot(u) for u in own], np.int64)]
                last, counts[row] = borders[row + 1], len(own)
            index = np.concatenate([*parts, index[last:]])
            for k in np.flatnonzero(odd_piece).tolist():  # nothing refers to them any more
                pieces[k] = ""
        end = None if end_id is None else np.uint32(end_id).tobytes()
        return gathered([*self.units(pieces, " "), *self.units([*more], "")], index, counts, np.dtype(np.uint32), end)


def _lines(unit: str) -> list[str] | None:
    """The words of a unit that are parted by single line breaks and hold no other blank at their ends."""
    words = unit.split("\n")
    return words if "<|" not in unit and all(w and not (w[0].isspace() or w[-1].isspace()) for w in words) else None


@lru_cache(maxsize=2)
def byte_pieces(vocabulary: str) -> BytePieces:
    return BytePieces(vocabulary_path(vocabulary))
