from __future__ import annotations

import random

from tests.llm import edges
from tidemark.llm.decontam import BenchmarkBlock, contamination_report, decontaminate, match_benchmark, scan_shard, words


def brute(document, items, window):
    hit, named, longest = set(), set(), 0
    for name, item in items:
        wide = min(window, len(item))
        for a in range(len(item) - wide + 1 if item else 0):
            for p in range(len(document) - wide + 1):
                if document[p : p + wide] == item[a : a + wide]:
                    hit.update(range(p, p + wide))
                    named.add(name)
                    n = wide
                    while p + n < len(document) and a + n < len(item) and document[p + n] == item[a + n]:
                        n += 1
                    longest = max(longest, n)
    return hit, named, longest


def test_shards_match_brute_force():
    rng = random.Random(3)
    for _ in range(150):
        letters = "abcd"[: rng.randint(1, 4)]
        text = lambda n: [rng.choice(letters).encode() for _ in range(n)]  # noqa: B023, E731
        window = rng.choice([1, 2, 3, 5, 10])
        items = [(str(k), text(rng.randint(0, rng.choice([3, 14])))) for k in range(rng.randint(0, 4))]
        shard = [(text(rng.randint(0, 30)), None) for _ in range(rng.randint(1, 5))]
        for (document, _), found in zip(shard, scan_shard(shard, BenchmarkBlock(items, window)), strict=True):
            hit, named, longest = brute(document, items, window)
            assert {i for s in found["spans"] for i in range(s["start"], s["stop"])} == hit
            assert set(found["items"]) == named
            assert (found["longest"] or {"words": 0})["words"] == longest


def test_words_fold_ascii_only():
    assert words("Ab-É9 ñ_x y") == ["ab".encode(), "É9".encode(), "ñ".encode(), "x y".encode()]
    assert words(None) == []


def test_blocks_and_awkward_rows(spark):
    docs = edges.docs(spark)
    items = [(1, edges.rows()[0][1]), (2, None), (3, ""), (None, "word1 the"), (1, "wörds für die"), (4, "nowhere to be found")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = sorted(map(str, contamination_report(docs, benchmark).collect()))
    assert whole == sorted(map(str, contamination_report(docs, benchmark, block_words=3, shard_words=5).collect()))
    by_id = {r["doc_id"]: r for r in contamination_report(docs, benchmark).collect()}
    assert [by_id[k]["contaminated"] for k in (1, 2, 3, 4, 5, 6, 7, 8, 9)] == [True, False, False, False, False, True, False, True, True]
    assert by_id[1]["n_hit"] == by_id[1]["n_words"] and by_id[8]["n_hit"] == 3
    kept = decontaminate(docs, benchmark)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {2, 3, 4, 5, 7}
    none = spark.createDataFrame([], "item_id long, text string")
    assert match_benchmark(docs, none).where("size(spans) > 0").count() == 0
    assert contamination_report(edges.empty(spark), benchmark).count() == 0
