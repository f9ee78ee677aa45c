from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.conftest import SF_SMALL
from tests.llm import edges
from tests.llm.test_byte_pieces import library
from tidemark.llm.packing import Packing, best_fill, configurations, pack_documents, place_large, place_small, rounded_groups


def best_fit(sizes, capacity):
    """Best fit decreasing, one item after the other."""
    bins = []
    for s in sorted(sizes, reverse=True):
        fitting = [k for k, f in enumerate(bins) if f >= s]
        if fitting:
            bins[min(fitting, key=lambda k: bins[k])] -= s
        else:
            bins.append(capacity - s)
    return len(bins)


def planned(sizes, how):
    """The plan carried out item by item: bins as lists of (offset, size)."""
    counts = dict(Counter(sizes))
    ordered = sorted(sizes, reverse=True)
    large = [s for s in ordered if s > how.small]
    places, n = place_large(counts, how)
    bins = defaultdict(list)
    begin, bin_, each, at = places.arrays()
    for rank, s in enumerate(large):
        k = np.searchsorted(begin, rank, "right") - 1
        bins[int(bin_[k] + (rank - begin[k]) // each[k])].append((int(at[k]), s))
    assert set(bins) == set(range(n))
    rows = []
    for k in range(n):
        slots = sorted(bins[k])
        assert [a for a, _ in slots] == list(range(len(slots)))
        rows.append([s for _, s in slots])
    rows.sort(key=lambda r: how.capacity - sum(r))
    out = [[(sum(r[:k]), s) for k, s in enumerate(r)] for r in rows]
    places, total = place_small(counts, dict(Counter(how.capacity - sum(r) for r in rows)), len(large), how)
    out += [[] for _ in range(total - len(out))]
    begin, bin_, each, at = places.arrays()
    for rank, s in list(enumerate(ordered))[len(large) :]:
        k = np.searchsorted(begin, rank, "right") - 1
        further = rank - int(begin[k])
        out[int(bin_[k]) + further // int(each[k])].append((int(at[k]) + further % int(each[k]) * s, s))
    return out


@pytest.mark.parametrize("groups", [3, 20, 4096])
@pytest.mark.parametrize("kind", ["mixed", "large", "small", "halves", "one", "none"])
def test_plan_is_gapless_and_tight(groups, kind):
    rng = random.Random(groups)
    draw = {
        "mixed": lambda: min(200, int(rng.expovariate(1 / 45)) + 1),
        "large": lambda: rng.randint(60, 200),
        "small": lambda: rng.randint(1, 20),
        "halves": lambda: rng.choice([99, 100, 101, 102]),
    }.get(kind, lambda: 1)
    sizes = [draw() for _ in range({"one": 1, "none": 0}.get(kind, 900))]
    how = Packing(capacity=200, small=25, groups=groups)
    bins = planned(sizes, how)
    assert Counter(s for b in bins for _, s in b) == Counter(sizes)
    for b in bins:
        end = 0
        for at, s in sorted(b):
            assert at == end
            end += s
        assert 0 < end <= 200
    if groups == 4096:
        assert len(bins) <= best_fit(sizes, 200) + 1


def test_groups_and_configurations():
    groups = rounded_groups({9: 3, 7: 4, 5: 1}, 4)
    assert groups == [(9, 4), (7, 4)] and sum(n for _, n in rounded_groups({9: 10**12, 4: 7}, 5)) == 10**12 + 7
    used = Counter()
    for use, times in configurations([(9, 3), (6, 2), (4, 10**9)], 13):
        assert sum(n * s for n, s in zip(use, (9, 6, 4), strict=True)) <= 13
        used.update({k: n * times for k, n in enumerate(use)})
    assert used == {0: 3, 1: 2, 2: 10**9}
    assert best_fill([9, 6, 4], [0, 2, 1], 11, 0) == [0, 1, 1]


def check(rows, texts, how):
    """Rows against the library's ids: every document cut as agreed, every sequence filled without a gap."""
    ids = dict(zip(texts, library(list(texts.values()), how.end_id), strict=True))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(ids)
    for doc, own in pieces.items():
        own.sort(key=lambda r: r["piece"])
        at = 0
        for k, r in enumerate(own):
            part = np.array(ids[doc][at : at + r["length"]], "<u4")
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part.tobytes()))
            assert r["length"] == how.capacity or k == 0
            at += r["length"]
        assert at == len(ids[doc]) and len(own) == -(-at // how.capacity)
    for held in sequences.values():
        end = 0
        for at, n in sorted(held):
            assert at == end
            end += n
        assert end <= how.capacity
    return len(sequences), [r["length"] for r in rows]


def test_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").repartition(3)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for how in (Packing(), Packing(capacity=300, small=40, groups=30)):
        n, lengths = check(pack_documents(docs, how).collect(), texts, how)
        assert n <= best_fit(lengths, how.capacity) * (1.0 if how.groups > 4000 else 1.05) + 1


def test_awkward_rows(spark):
    got = pack_documents(edges.docs(spark)).collect()
    by = Counter(r["doc_id"] for r in got)
    assert by[6] > 20 and by[1] == 2 and by[None] == 1
    assert {(r["start"], r["length"]) for r in got if r["doc_id"] in (2, 3)} == {(0, 1)}
    assert sum(r["length"] for r in got if r["doc_id"] == 6) == len(library([edges.LONG], 0)[0])
    assert pack_documents(edges.empty(spark)).count() == 0
    only_full = spark.createDataFrame([(1, " the" * 2047), (2, " the" * 4095)], "doc_id long, text string")
    assert sorted((r["length"], r["offset"]) for r in pack_documents(only_full).collect()) == [(2048, 0)] * 3
