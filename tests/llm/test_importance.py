from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import edges
from tidemark.llm.importance import Resampling, _words_of, feature_buckets, resample
from tidemark.operators.ranking import with_rank


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


def runs(text, n):
    ws = words(text)
    return [" ".join(ws[k : k + size]) for size in range(1, n + 1) for k in range(len(ws) - size + 1)]


def brute(rows, target, how):
    bucket = lambda f: zlib.crc32(f.encode()) % how.buckets
    found = [[bucket(f) for f in runs(t, how.n)] for _, t in rows]
    s, t = Counter(b for f in found for b in f), Counter(bucket(f) for x in target for f in runs(x, how.n))
    S, T = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (S + how.buckets) / ((s[b] + 1) * (T + how.buckets))))
    out = []
    for (i, text), f in zip(rows, found, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"{how.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, len(words(text))])
    able = sorted((r for r in out if r[5] >= how.least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for place, r in enumerate(able[: how.percent * len(able) // 100]):
        r[4] = place + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("how", [Resampling(percent=40), Resampling(n=3, buckets=50, least_words=5, percent=33, seed=1)])
def test_matches_brute_force(spark, how):
    rng = random.Random(4)
    pool = [f"{c}{k}" for c in ("Wort", "x", "é", "ß9") for k in range(30)]
    rows = [(k, rng.choice([" ", "-", "\n", "\x00"]).join(rng.choices(pool, k=rng.randint(0, 60)))) for k in range(300)]
    rows += [(7, rows[7][1]), (300, None), (301, ""), (302, " .!\x7f"), (None, rows[3][1]), (303, " ".join(pool * 400))]
    target = [" ".join(rng.choices(pool[:20], k=40)) for _ in range(9)] + [None, ""]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, score string").repartition(5)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    assert Counter(map(tuple, resample(docs, wanted, how).collect())) == brute(rows, target, how)


def test_runs_of_words_are_hashed_as_their_text():
    texts = ["One two  two-three", None, "", "ä b ä b", "x"]
    rows, buckets = feature_buckets(pa.array(texts), 3, 1 << 20)
    expected = Counter((k, zlib.crc32(f.encode()) % (1 << 20)) for k, t in enumerate(texts) for f in runs(t, 3))
    assert Counter(zip(rows.tolist(), buckets.tolist(), strict=True)) == expected
    for n in (1, 2, 4):
        sizes = np.array([len(runs(" ".join("w" * w), n)) for w in range(12)])
        assert _words_of(sizes, n).tolist() == list(range(12))


def test_awkward_rows(spark):
    target = spark.createDataFrame([("the quick fox",)], "text string")
    got = resample(edges.docs(spark), target, Resampling(least_words=1, percent=100)).collect()
    assert len(got) == len(edges.rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] != 1}
    assert all(by[i][1:3] == (0, 0) and by[i]["rank"] is None for i in (2, 3, 4))
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, len(got) - 2))
    empty = edges.empty(spark)
    assert resample(empty, target).count() == 0
    assert resample(edges.docs(spark), empty).count() == len(got)


def test_ranks_span_partitions(spark):
    rows = [(k % 7, k) for k in range(1000)] + [(3, 2000 + k) for k in range(3000)]
    df = spark.createDataFrame(rows, "a int, b long").repartition(8)
    got = {(r["a"], r["b"]): r["rank"] for r in with_rank(df, df["a"].desc(), df["b"]).collect()}
    assert got == {x: k for k, x in enumerate(sorted(rows, key=lambda r: (-r[0], r[1])))}
