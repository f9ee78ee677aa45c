from __future__ import annotations

import random

import numpy as np

from tests.llm import edges
from tidemark.llm.components import connected_components
from tidemark.llm import near_dup
from tidemark.llm.near_dup import CELLS, drop_near_duplicates, near_duplicate_groups, rare_prefixes, shingle_set, signature


def shingles(text):
    words = tuple((text or "").encode().lower().split())
    if not words:
        return frozenset()
    return frozenset(words[k : k + 5] for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([words])


def brute(rows):
    sets, root = {i: shingles(t) for i, t in rows}, {i: i for i, _ in rows}
    find = lambda x: x if root[x] == x else find(root[x])
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_groups_match_brute_force(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(400)]
    rows = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 120]))]
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 14)):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append(" ".join(copy).upper() if rng.random() < 0.3 else "  ".join(copy))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    got = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    expected = brute(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_awkward_rows(spark):
    got = near_duplicate_groups(edges.docs(spark)).collect()
    assert len(got) == len(edges.rows())
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"], r["kept"]))
    assert [r[2] for r in by[1]] == [True, True]  # both rows carry the component's own id
    assert by[2] == by[2][:1] == [(0, 2, True)] and by[3] == [(0, 3, True)] and by[4] == [(0, 4, True)]
    assert len(by[1]) == 2 and by[9][0][1:] == (1, False) and by[None][0][1:] == (1, False)
    docs = edges.docs(spark)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, 8}
    assert near_duplicate_groups(edges.empty(spark)).count() == 0


def test_repeated_and_missing_ids(spark):
    base = " ".join(f"w{k}" for k in range(60))
    near, other = base.replace("w59", "x"), " ".join(f"v{k}" for k in range(60))
    rows = [(5, base), (5, other), (None, near), (7, near.replace("w0 ", "y ")), (8, other), (None, other.replace("v59", "x"))]
    got = near_duplicate_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"]) for r in got) == [(0, 5), (0, 5), (5, 5), (5, 5), (7, 5), (8, 5)]


def test_sketch_counts_differing_samples():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 62, 4000, dtype=np.uint64))
    near, far = np.sort(np.append(base[:3600], rng.integers(0, 1 << 62, 400, dtype=np.uint64))), base[:1000]
    parity = lambda x: signature(x).sketch.view(np.uint64)
    bits = lambda a, b: int(np.bitwise_count(parity(a) ^ parity(b)).sum())
    assert bits(base, base) == 0 < bits(base, near) < 112 < bits(base, far)
    assert len(shingle_set("one two")) == 1 and len(shingle_set("")) == 0


def test_components(spark):
    rng = random.Random(2)
    edges_ = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(45)] + [(100 + k, 101 + k) for k in range(40)]
    root = {n: n for e in edges_ for n in e}
    find = lambda x: x if root[x] == x else find(root[x])
    for a, b in edges_:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges_, "u long, v long")).collect()}
    assert got == {n: find(n) for e in edges_ if e[0] != e[1] for n in e}


def test_one_row_of_every_group_stays(spark):
    texts = [" ".join(f"{c}{k}" for k in range(60)) for c in "abcdef"]
    near = lambda t: t.replace("59", "x")
    rows = [
        (None, texts[0]), (None, texts[0]), (None, near(texts[0])),  # a group without ids
        (None, texts[1]), (3, near(texts[1])),  # a group of which one has an id
        (None, texts[2]),  # alone, without id
        (4, texts[3]), (4, texts[3]), (4, near(texts[3])),  # one id, one group
        (4, texts[4]),  # the id again with another group's text
        (2, near(texts[4])), (6, texts[5]), (None, ""), (None, None), (7, " "), (7, " "),
    ]
    docs = spark.createDataFrame([(*r, "clash", n) for n, r in enumerate(rows)], "doc_id long, text string, tie string, n long").repartition(3)
    got = near_duplicate_groups(docs).collect()
    assert len(got) == len(rows) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    left = [(r["doc_id"], r["text"]) for r in kept.collect()]
    worded = sorted(((i or 0), t[0]) for i, t in left if t and t.strip())
    assert worded == [(0, "a"), (0, "c"), (2, "e"), (3, "b"), (4, "d"), (6, "f")]
    assert sorted((i or 0) for i, t in left if not (t and t.strip())) == [0, 0, 7, 7]


def jaccard(a, b):
    return len(a & b) / len(a | b)


def test_rare_prefixes_meet_in_every_linked_pair():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    sets = []
    for _ in range(60):
        base = rng.choice(pool, int(rng.integers(1, 60)), replace=False)
        sets.append(np.unique(base))
        for cut in (1, 3, 8):
            sets.append(np.unique(np.append(base[cut:], rng.integers(0, 1 << 62, cut // 2, dtype=np.uint64))))
    sets = [m for m in sets if len(m)]
    counts = np.bincount((np.concatenate(sets) % np.uint64(CELLS)).astype(np.int64), minlength=CELLS)
    found = [rare_prefixes(m, counts) for m in sets]
    linked = 0
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            if i != j and len(x) <= len(y) and jaccard(set(x.tolist()), set(y.tolist())) >= 0.75:
                (a, short), (b, _) = found[i], found[j]
                assert set(a[short].tolist()) & set(b.tolist())
                linked += 1
    assert linked > 100


def template_rows(n, seed=3):
    """Documents that share a template of 45 words (similarity near 0.6, none linked) and a pair of near copies."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(45)]
    rows = [" ".join(template + [f"o{rng.randrange(10**9)}" for _ in range(13)]) for _ in range(n)]
    return rows + [rows[0].replace("t0 ", "x "), rows[n // 2] + " end"]


def test_a_common_template_deals_no_blocks(spark, monkeypatch):
    dealt = {}
    real = near_dup.materialize

    def seen(df, name):
        out = real(df, name)
        if name in ("blocks", "rare-shingles"):
            dealt[name] = out.count()
        return out

    monkeypatch.setattr(near_dup, "materialize", seen)
    for n in (500, 2000):
        rows = template_rows(n)
        got = near_duplicate_groups(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)).collect()
        names = {r["doc_id"]: r["component_id"] for r in got}
        assert (names.pop(n), names.pop(n + 1)) == (0, n // 2) and all(k == v for k, v in names.items())
        assert dealt["blocks"] <= 40 * n and dealt["rare-shingles"] <= 40 * n
