"""Mixing sources to target weights by temperature.

Source token shares ``p`` become weights proportional to ``p ** exponent``.
The exponent is the largest one, at most 1, whose weights reach a target
entropy; it is then raised again as far as the repetition limit asks.  Both
searches halve an interval, five halvings to each pass over the share table.
Weights are realised as whole and partial epochs of each source: every epoch
is a pseudo-random permutation of the source, and the stream of a source is
cut into blocks that each hold its weight's part of a fixed token budget.

A source's running token sum is a two-level prefix sum: the permuted copies
are range-partitioned, the totals of a source's parts are summed up in a small
table, and rows only within their part.  A source, an id or a text that holds
a third of all rows is spread over as many parts as any other rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.columns import words_of
from tidemark.operators.lineage import materialize
from tidemark.operators.ranking import PLACE_BITS

#: Rows with NULL source are a source of their own.
SOURCE_KEY = "_mix_source"


@dataclass(frozen=True)
class MixTarget:
    """Share of the greatest possible entropy to reach, most epochs of any source, token budget.

    Without a budget, it is the least one at which every source is used once
    in full, so mixing repeats but never drops documents.
    """

    entropy: float = 0.95
    max_epochs: float = 1.5
    budget: int | None = None
    block_tokens: int = 1 << 20
    seed: int = 7


def token_count(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def _halve(ok, passes: int = 6, cuts: int = 32) -> float:
    """Largest exponent in [0, 1] for which ``ok`` (monotone, true at small ones) holds; 0 if none.

    ``ok`` judges a list of exponents in one pass over the data.
    """
    low, high = 0.0, 1.0
    for _ in range(passes):
        points = [low + (high - low) * k / cuts for k in range(1, cuts + 1)]
        good = ok(points)
        held = sum(1 for g in good if g)
        if held == cuts:
            return high
        low, high = (points[held - 1] if held else low), points[held]
    return low


def _entropies(shares: DataFrame, points: list[float]) -> list[float]:
    p = F.col("p")
    sums = [F.sum(F.pow(p, a)).alias(f"z{k}") for k, a in enumerate(points)]
    sums += [F.sum(F.pow(p, a) * F.log(p)).alias(f"s{k}") for k, a in enumerate(points)]
    row = shares.agg(*sums).first()
    return [math.log(row[f"z{k}"]) - a * row[f"s{k}"] / row[f"z{k}"] for k, a in enumerate(points)]


def source_weights(docs: DataFrame, target: MixTarget, source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(source, docs, tokens, share, weight, budget, epochs)`` for each source that has tokens.

    The table has a row per source and is written to the shared folder; the
    driver sees aggregates only.
    """
    counted = docs.select(F.col(source_col).alias("source"), token_count(F.col(text_col)).alias("tokens"))
    sources = materialize(
        counted.groupBy("source").agg(F.count("*").alias("docs"), F.sum("tokens").alias("tokens")), "sources"
    ).where("tokens > 0")
    whole = sources.agg(F.sum("tokens"), F.min("tokens"), F.max("tokens"), F.count("*")).first()
    total, least, most, n = (whole[0] or 0), (whole[1] or 1), (whole[2] or 1), whole[3]
    shares = sources.withColumn("p", F.col("tokens") / F.lit(float(max(total, 1))))
    exponent = 1.0
    if n > 1:
        wanted = target.entropy * math.log(n)
        exponent = _halve(lambda points: [h >= wanted for h in _entropies(shares, points)])
        if target.budget is None:
            # the smallest source repeats (most / least) ** (1 - exponent) times as often as the largest
            if most > least:
                exponent = max(exponent, 1 - math.log(target.max_epochs) / math.log(most / least))
        else:
            over = lambda a: target.budget / total * (least / total) ** (a - 1) / z(a) > target.max_epochs
            z = lambda a: shares.agg(F.sum(F.pow("p", F.lit(a)))).first()[0]
            low, high = exponent, 1.0
            for _ in range(30 if over(exponent) else 0):
                middle = (low + high) / 2
                low, high = (middle, high) if over(middle) else (low, middle)
            exponent = high if over(exponent) else exponent
    z_all = shares.agg(F.sum(F.pow("p", F.lit(exponent)))).first()[0] or 1.0
    budget = target.budget
    if budget is None:
        budget = most / ((most / max(total, 1)) ** exponent / z_all)
    weight = F.pow("p", F.lit(exponent)) / F.lit(z_all)
    given = shares.withColumn("weight", weight).withColumn("budget", F.round(weight * F.lit(float(budget))).cast("long"))
    # rounding must not cut the last document of a source that is to be used in full
    given = given.withColumn("budget", F.when((F.col("tokens") - F.col("budget")).between(0, 1), F.col("tokens")).otherwise(F.col("budget")))
    return given.select(
        "source", "docs", "tokens", F.col("p").alias("share"), "weight", "budget", (F.col("budget") / F.col("tokens")).alias("epochs")
    )


def _epoch_rows(docs: DataFrame, weights: DataFrame) -> DataFrame:
    """Rows joined with their source's budget, one copy for each epoch that is begun."""
    given = weights.select(
        F.coalesce(F.xxhash64("source"), F.lit(0)).alias(SOURCE_KEY), F.col("budget").alias("_budget"),
        F.col("tokens").alias("_tokens"), F.col("docs").alias("_docs"), F.col("weight").alias("_weight"),
    )
    begun = F.greatest(F.ceil(F.col("_budget") / F.col("_tokens")).cast("int"), F.lit(1))
    return docs.join(given, SOURCE_KEY, "left").withColumn(
        "_epoch", F.explode(F.when(F.col("_tokens").isNull(), F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), begun - 1)))
    )


def mixed_rows(
    docs: DataFrame,
    target: MixTarget = MixTarget(),
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """``(doc_id, source, epoch, n_tokens, block, at)`` for every document copy in the mixed stream.

    ``at`` is the copy's token position in its source's stream and ``block``
    the block that it falls in; a copy is used if it begins before the
    source's budget, and all of epoch 0 is where the budget covers the source
    (always, if none is given).  NULL sources form one source.  Texts without
    words have no tokens and go with the place they hash to; a source without
    any tokens is passed through once, in block 0.  Repeated rows are separate
    documents.  An empty table gives an empty result; other columns are not read.
    """
    weights = source_weights(docs, target, source_col, text_col)
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        F.coalesce(F.xxhash64(F.col(source_col)), F.lit(0)).alias(SOURCE_KEY),
        token_count(F.col(text_col)).alias("n_tokens"),
        F.xxhash64(F.col(text_col)).alias("_text"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    copies = _epoch_rows(rows, weights)
    # a tie number tells copies of one id and text apart, which are alike in all that the result shows
    order = F.xxhash64("doc_id", "epoch", F.lit(target.seed))
    copies = copies.withColumnRenamed("_epoch", "epoch").withColumn("_order", order).drop("_docs")
    keys = [SOURCE_KEY, "epoch", "_order", "doc_id", "n_tokens", "_text", "_tie"]
    copies = materialize(copies, "mix-copies")
    # a stated number of partitions: one source or id is spread even where the rows are few enough to be coalesced
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    permuted = copies.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_text", "_tie", "_order")
    permuted = materialize(permuted.withColumn("_place", F.monotonically_increasing_id()), "mix-permuted")
    part = [SOURCE_KEY, "_part"]
    permuted = permuted.withColumn("_part", F.shiftright("_place", PLACE_BITS))
    totals = permuted.groupBy(*part).agg(F.sum("n_tokens").alias("_n"))
    running = W.partitionBy(SOURCE_KEY).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    bases = totals.select(*part, F.coalesce(F.sum("_n").over(running), F.lit(0)).alias("_base"))
    within = W.partitionBy(*part).orderBy("_place").rowsBetween(W.unboundedPreceding, -1)
    placed = permuted.withColumn("_own", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(bases, part)
    at = F.col("_base") + F.col("_own")
    # documents without words that hash behind the source's last word begin at its budget
    covered = F.lit(target.budget is None) | (F.col("_budget") >= F.col("_tokens"))
    used = placed.where(F.col("_budget").isNull() | (at < F.col("_budget")) | ((F.col("epoch") == 0) & covered))
    quota = F.greatest(F.col("_weight") * F.lit(float(target.block_tokens)), F.lit(1.0))
    return used.select(
        "doc_id", "source", F.col("epoch").cast("int").alias("epoch"), "n_tokens",
        F.coalesce(F.floor(at / quota), F.lit(0)).cast("long").alias("block"), at.cast("long").alias("at"),
    )


def mix_documents(
    docs: DataFrame, target: MixTarget = MixTarget(), id_col: str = "doc_id", source_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``docs`` with every document as often as the mix uses it (see :func:`mixed_rows`)."""
    plan = mixed_rows(docs, target, id_col, source_col, text_col)
    uses = plan.groupBy(F.col("doc_id").alias("_mix_id"), F.col("source").alias("_mix_src"), F.col("n_tokens").alias("_mix_n"), "epoch")
    times = uses.agg(F.lit(1)).groupBy("_mix_id", "_mix_src", "_mix_n").agg(F.count("*").cast("int").alias("_mix_times"))
    same = (
        docs[id_col].eqNullSafe(times["_mix_id"])
        & docs[source_col].eqNullSafe(times["_mix_src"])
        & token_count(docs[text_col]).eqNullSafe(times["_mix_n"])
    )
    repeated = docs.join(times, same).withColumn("_mix_k", F.explode(F.sequence(F.lit(1), F.col("_mix_times"))))
    return repeated.select(*[F.col(f"`{c}`") for c in docs.columns])
