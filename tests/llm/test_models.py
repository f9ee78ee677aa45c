from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from tests.conftest import SF_SMALL
from tests.llm import edges
from tidemark.llm.lang_id import ByteTagger, Direction, LetterPool, _LETTER_BYTE, identify_languages, train_language_model, windows_of
from tidemark.llm import weak_quality
from tidemark.llm.weak_quality import LABELLERS, QualityModel, WeakLabels, drop_low_quality, features, fit_labellers, quality_scores


def test_backpropagation_through_time_matches_finite_differences():
    rng = np.random.default_rng(0)
    model = ByteTagger.fresh(["a", "b", "c"], 1, hidden=4)
    for name in ("ahead", "behind"):
        layer = getattr(model, name)
        setattr(model, name, Direction(layer.rows.astype(float), layer.recur.astype(float)))
    windows, labels = rng.integers(97, 103, (5, 7)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = model.gradients(windows, labels)
    for w, g in zip(model.weights(), grads, strict=True):
        for _ in range(6):
            at = tuple(rng.integers(0, s) for s in w.shape)
            at = (int(rng.integers(97, 103)), at[1]) if w.shape[0] == 256 else at
            keep, losses = w[at], []
            for step in (1e-2, -1e-2):
                w[at] = keep + step
                losses.append(model.gradients(windows, labels)[0])
            w[at] = keep
            assert abs((losses[0] - losses[1]) / 2e-2 - g[at]) < 1e-3


def test_prediction_layout_gives_the_same_labels():
    model = ByteTagger.fresh(["a", "b"], 2)
    windows = windows_of("Größe und Maß, the size 12 of it".encode() * 9)
    plain = np.einsum("ntk,nt->nk", model.label(windows), _LETTER_BYTE[windows].astype(np.float32))
    assert np.abs(plain - LetterPool(model).sums(windows)).max() < 1e-3


def test_language_accuracy_and_awkward_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = train_language_model(docs)
    got = identify_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.95 * len(got) > 0
    odd = identify_languages(edges.docs(spark), model).collect()
    assert len(odd) == len(edges.rows())
    assert {r["doc_id"] for r in odd if r["lang_pred"] == "und"} == {2, 3, 4, 5}
    assert all(r["score"] == 0 if r["lang_pred"] == "und" else 0 < r["score"] <= 1 for r in odd)
    assert all(r["held_out"] for r in odd if r["doc_id"] is None)
    assert train_language_model(edges.empty(spark)) is None
    assert {r["lang_pred"] for r in identify_languages(edges.docs(spark), None).collect()} == {"und"}


def test_a_language_of_few_texts_with_many_copies_is_learned(spark):
    rows = [(c * 1_000 + k, f"{'wort' * (c + 1)} und noch {c}", "de") for c in range(3) for k in range(1_000)]
    rows += [(10_000 + k, f"some words and number {k}", "en") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train_language_model(docs, docs_per_language=4, steps=1)
    assert model.languages == ["de", "en"]


def test_expectation_maximisation_finds_the_labellers():
    rng = np.random.default_rng(3)
    m = len(LABELLERS)
    says_bad = np.stack([rng.uniform(0.3, 0.8, m), rng.uniform(0.005, 0.04, m)])
    good = rng.random(20_000) < 0.8
    cast = rng.random((20_000, m)) < says_bad[good.astype(int)]
    silent = rng.random((20_000, m)) < 0.1
    counts: dict[str, int] = {}
    for bad, none in zip(cast, silent, strict=True):
        pattern = "".join("-" if n else "b" if b else "g" for b, n in zip(bad, none, strict=True))
        counts[pattern] = counts.get(pattern, 0) + 1
    model = fit_labellers(counts)
    assert abs(model.good - good.mean()) < 0.02 and np.abs(model.says_bad - says_bad).max() < 0.04


def test_posterior_and_score_match_plain_sums():
    rng = np.random.default_rng(5)
    m = len(LABELLERS)
    labels = WeakLabels(0.7, rng.uniform(0.05, 0.9, (2, m)))
    patterns = ["".join(rng.choice(list("bg-"), m)) for _ in range(40)]
    for pattern, got in zip(patterns, labels.posterior(patterns), strict=True):
        chance = [1 - labels.good, labels.good]
        for c in (0, 1):
            for vote, says in zip(pattern, labels.says_bad[c], strict=True):
                chance[c] *= {"b": says, "g": 1 - says, "-": 1.0}[vote]
        assert abs(got - chance[1] / sum(chance)) < 1e-9
    weights = rng.normal(size=512).astype(np.float32)
    model = QualityModel(labels, weights, 0.3)
    text = b"Some words, some MORE words!! and and 12 odd_things"
    words = text.split()
    shape = lambda w: re.sub(r"(.)\1+", r"\1", "".join("a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else c for c in w))
    counts = Counter(shape(w.decode()).encode() for w in words) + Counter({b"\x00again": 16})
    total = 0.3 + sum(float(weights[zlib.crc32(s) % 512]) * math.sqrt(n / len(words)) for s, n in counts.items())
    assert abs(model.score(*features(text, words, 512)) - 1 / (1 + math.exp(-total))) < 1e-5


def test_copies_do_not_empty_the_scorers_sample(spark, monkeypatch):
    rows = [(k, "one text that was copied very often") for k in range(20_000)]
    rng = random.Random(1)
    shapes = ["xx", "XX", "Xx", "9x", "x9", "99", "X9", "x.", "X,", "x-x", "#", "x!"]
    rows += [(100_000 + k, " ".join(rng.choices(shapes, k=30))) for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sizes = []
    fit = weak_quality._fit_scorer
    monkeypatch.setattr(weak_quality, "_fit_scorer", lambda x, y, **o: sizes.append(len(y)) or fit(x, y, **o))
    weak_quality.fit_quality(docs, max_rows=3000)
    weak_quality.fit_quality(docs, max_rows=100)
    assert sizes[0] >= 500 and 60 <= sizes[1] <= 150


def test_quality_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_scores(docs).join(labels, "doc_id").collect()
    clean, junk = [r for r in got if r["quality"] == 1], [r for r in got if r["quality"] == 0]
    assert sum(r["kept"] for r in clean) >= 0.99 * len(clean) and sum(r["kept"] for r in junk) <= 0.2 * len(junk)
    odd = quality_scores(edges.docs(spark)).collect()
    assert len(odd) == len(edges.rows()) and not any(r["kept"] for r in odd if r["doc_id"] in (2, 3, 4))
    assert quality_scores(edges.empty(spark)).count() == 0
    assert drop_low_quality(edges.docs(spark)).columns == edges.docs(spark).columns
