from __future__ import annotations

import math
import re
from collections import Counter

import pytest

from tests.conftest import SF_SMALL
from tests.llm import edges
from tidemark.llm.mixing import MixTarget, mix_documents, mixed_rows, source_weights


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize(
    "target",
    [MixTarget(entropy=0.9995, max_epochs=2.5), MixTarget(budget=9_000, max_epochs=1.2), MixTarget(entropy=0.0)],
)
def test_streams_hold_the_budget(spark, target):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("source < 'src15' OR doc_id % 2 = 0")
    texts = {r["doc_id"]: (r["source"], n_words(r["text"])) for r in docs.collect()}
    weights = {r["source"]: r for r in source_weights(docs, target).collect()}
    assert abs(sum(w["weight"] for w in weights.values()) - 1) < 1e-9
    streams: dict[str, list] = {}
    for r in mixed_rows(docs, target).collect():
        assert texts[r["doc_id"]] == (r["source"], r["n_tokens"])
        streams.setdefault(r["source"], []).append(r)
    for source, rows in streams.items():
        at, budget = 0, weights[source]["budget"]
        assert weights[source]["epochs"] <= target.max_epochs + 0.01 or target.entropy == 0
        for r in sorted((r for r in rows if r["n_tokens"]), key=lambda r: r["at"]):
            assert r["at"] == at < budget
            assert r["block"] == int(at / max(weights[source]["weight"] * target.block_tokens, 1))
            at += r["n_tokens"]
        assert at >= budget
        if target.budget is None:  # every document at least once
            assert {r["doc_id"] for r in rows if r["epoch"] == 0} >= {i for i, (s, n) in texts.items() if s == source and n}
    used = Counter(r["doc_id"] for rows in streams.values() for r in rows)
    assert Counter(r["doc_id"] for r in mix_documents(docs, target).select("doc_id").collect()) == used


def plain_weights(tokens, target):
    """Exponent and weights worked out with plain bisection over the sources' token counts."""
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def weights(a):
        z = sum(p**a for p in share.values())
        return {s: p**a / z for s, p in share.items()}

    entropy = lambda a: -sum(w * math.log(w) for w in weights(a).values())

    def largest(ok):
        if ok(1.0):
            return 1.0
        low, high = 0.0, 1.0
        for _ in range(60):
            low, high = ((low + high) / 2, high) if ok((low + high) / 2) else (low, (low + high) / 2)
        return low

    exponent = largest(lambda a: entropy(a) >= target.entropy * math.log(len(tokens)))
    most = max(tokens, key=tokens.get)
    budget = lambda a: target.budget or tokens[most] / weights(a)[most]
    epochs = lambda a: max(budget(a) * weights(a)[s] / n for s, n in tokens.items())
    if epochs(exponent) > target.max_epochs:
        low, high = exponent, 1.0
        for _ in range(60):
            low, high = ((low + high) / 2, high) if epochs((low + high) / 2) > target.max_epochs else (low, (low + high) / 2)
        exponent = high
    return weights(exponent), budget(exponent)


@pytest.mark.parametrize(
    "target",
    [MixTarget(), MixTarget(entropy=0.9, max_epochs=50), MixTarget(entropy=0.99, max_epochs=3), MixTarget(entropy=0.8, max_epochs=1.3, budget=900)],
)
def test_exponent_and_weights_match_plain_bisection(spark, target):
    tokens = {"a": 700, "b": 90, "c": 31, None: 150, "d": 4}
    rows = [(k, s, "w " * (n // 2 + part)) for k, (s, n) in enumerate(tokens.items()) for part in (0, n % 2)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    weights, budget = plain_weights(tokens, target)
    got = {r["source"]: r for r in source_weights(docs, target).collect()}
    assert {s: r["tokens"] for s, r in got.items()} == tokens
    for source, r in got.items():
        assert abs(r["weight"] - weights[source]) < 1e-5
        assert abs(r["budget"] - budget * weights[source]) <= 1.51 + 1e-4 * budget


def test_many_rows_without_id_or_of_one_id_are_spread(spark, monkeypatch):
    from tidemark.llm import mixing

    written = {}
    real = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df, name: written.setdefault(name, real(df, name)))
    rows = [(None if k % 2 else 7, "hot", "the same text") for k in range(18_000)] + [(k, "hot", f"text {k}") for k in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4)
    mixed = mixed_rows(docs)
    at = sorted((r["at"], r["n_tokens"]) for r in mixed.collect())
    assert len(at) == 20_000 and at[0][0] == 0
    assert all(a + n == b for (a, n), (b, _) in zip(at, at[1:], strict=False))
    place = written["mix-permuted"].selectExpr("shiftright(_place, 33) AS part").groupBy("part").count()
    sizes = [r["count"] for r in place.collect()]
    assert len(sizes) > 1 and max(sizes) < 2 * 20_000 / len(sizes)


def test_awkward_rows(spark):
    docs = edges.docs(spark)
    mixed = mix_documents(docs)
    assert mixed.columns == docs.columns and {r["doc_id"] for r in mixed.collect()} >= {1, 5, 6, 7, 8, 9, None}
    assert mixed_rows(edges.empty(spark)).count() == 0 and mix_documents(edges.empty(spark)).count() == 0


def test_documents_without_words_are_all_used(spark):
    rows = [(k, "hot", ("", None, " \n")[k % 3]) for k in range(60)] + [(60, "hot", "all the words " * 20), (61, "cold", "few words")]
    docs = spark.createDataFrame([*rows, (None, "hot", "")], "doc_id long, source string, text string")
    whole = max(r["tokens"] / r["weight"] for r in source_weights(docs, MixTarget()).collect())
    for target in (MixTarget(), MixTarget(entropy=0.0), MixTarget(budget=int(whole) + 1, entropy=0.0)):
        used = Counter(r["doc_id"] for r in mixed_rows(docs, target).where("epoch = 0").collect())
        assert used == Counter([*range(62), None])
    one = docs.where("source = 'hot'")
    assert mixed_rows(one).count() == 62
    assert mix_documents(one).count() == 62


def test_pipeline_stages_against_the_operators(spark):
    import corpus_pipeline as pipeline
    from tests.llm.test_decontam import brute as hits
    from tests.llm.test_near_dup import brute as groups
    from tidemark.llm.decontam import words

    assert [n for n, _ in pipeline.STAGES][1] == "minhash_near_dedup" and len(pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(150).cache()
    (_, quality), (_, dedup), (_, decontaminate), (_, mix), (_, files) = pipeline.STAGES
    good = quality(spark, docs, SF_SMALL)
    assert good.columns == docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in good.collect()}
    assert all(r["doc_id"] in kept for r in docs.collect() if labels.get(r["doc_id"]) == 1)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert {r["doc_id"] for r in dedup(spark, docs, SF_SMALL).collect()} == {i for i, (_, c) in groups(rows).items() if i == c}
    items = [(str(r["item_id"]), words(r["text"])) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    clean = decontaminate(spark, docs, SF_SMALL)
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in rows if not hits(words(t), items, 10)[0]}
    assert set(kept) <= {r["doc_id"] for r in mix(spark, good, SF_SMALL).collect()}
    assert files(spark, docs, SF_SMALL).count() == docs.count()
    for name, stage in pipeline.STAGES[:4]:
        assert stage(spark, edges.docs(spark), SF_SMALL).columns == edges.docs(spark).columns, name
        assert stage(spark, edges.empty(spark), SF_SMALL).count() == 0, name


def _table(spark, rows, folder):
    rows.write.mode("overwrite").parquet(str(folder / "documents.parquet"))
    spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").write.mode("overwrite").parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def test_whole_pipeline_against_brute_force(spark, tmp_path):
    """Every stage but the classifier and the draw of the copies worked out plainly on what the stage before kept."""
    import zlib

    import numpy as np

    import corpus_pipeline as pipeline
    from tests.llm.test_decontam import brute as hits
    from tests.llm.test_near_dup import brute as groups
    from tests.llm.test_tokens import library
    from tidemark.llm.decontam import words
    from tidemark.llm.weak_quality import drop_low_quality

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    sf_dir = _table(spark, docs, tmp_path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in drop_low_quality(docs).collect()]
    kept = {i for i, (_, c) in groups(rows).items() if i == c}
    items = [(str(r["item_id"]), words(r["text"])) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    texts = {i: t for i, t in rows if i in kept and not hits(words(t), items, 10)[0]}
    assert 0 < len(texts) < len(rows) < docs.count()
    got = sorted(pipeline.run(spark, sf_dir).collect(), key=lambda r: r["start"])
    left = docs.where(docs["doc_id"].isin(list(texts)))
    copies = Counter(r["doc_id"] for r in mix_documents(left).select("doc_id").collect())
    assert Counter(r["doc_id"] for r in got) == copies and set(copies) == set(texts)
    at, tool = 0, library("word_bpe_49k.json")
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    for r in got:
        ids = np.array([*tool.encode(texts[r["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_whole_pipeline_on_awkward_and_empty_tables(spark, tmp_path):
    import corpus_pipeline as pipeline

    got = pipeline.run(spark, _table(spark, edges.docs(spark), tmp_path / "odd"))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert {r["doc_id"] for r in got.collect()} <= {r[0] for r in edges.rows()}
    assert pipeline.run(spark, _table(spark, edges.empty(spark), tmp_path / "none")).count() == 0
    for stage in (s for _, s in pipeline.STAGES[4:]):
        assert stage(spark, edges.docs(spark), SF_SMALL).count() == len(edges.rows())
