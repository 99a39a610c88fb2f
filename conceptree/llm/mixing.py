"""Temperature mixing of sources, with DataFrame functions only.

A source's weight is its token share raised to an exponent, over the sum of these. The exponent
is searched by repeated sections until the weights' entropy meets a target, and moved back towards 1
(the natural shares) where a source would be repeated more than allowed. The weights are realised by permuted blocks:
each epoch of a source is a new permutation of its documents in blocks, taken whole while the
source's budget lasts, and up to the budget in the last epoch.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from conceptree.llm.blocks import free_name, group_key, running_totals
from conceptree.session import materialize

#: The exponent is looked for between 0 (equal weights) and this; 1 keeps the natural shares.
STEEPEST = 8.0
_SECTIONS, _ROUNDS = 32, 5


def word_count(text: str = "text") -> Column:
    """Number of words; a null text has none."""
    trimmed = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, "[\\x20\\x09-\\x0D]+"))).cast("long")


@dataclass
class Mixture:
    """``exponent`` and ``budget`` (tokens), and a table of group, tokens, weight, quota (tokens)."""

    exponent: float
    budget: float
    sources: DataFrame


def _measures(shares: DataFrame, exponents: list[float], budget: float) -> list[tuple[float, float, float]]:
    """(exponent, entropy over its maximum, most repeats under the budget) for each exponent."""
    tried = shares.withColumn("x", F.explode(F.array(*[F.lit(x) for x in exponents])))
    tried = tried.withColumn("raised", F.exp(F.col("x") * F.log("share")))
    rows = (
        tried.groupBy("x")
        .agg(
            F.sum("raised").alias("z"),
            F.sum(F.col("raised") * F.log("raised")).alias("zlog"),
            F.max(F.col("raised") / F.col("tokens")).alias("ratio"),
            F.count(F.lit(1)).alias("n"),
        )
        .collect()  # one row for each exponent tried
    )
    out = []
    for r in rows:
        z = r["z"]
        most = math.log(r["n"])
        out.append((r["x"], (math.log(z) - r["zlog"] / z) / most if most else 1.0, budget * r["ratio"] / z))
    return sorted(out)


def mixture(
    tokens: DataFrame, entropy: float, max_repeats: float, budget: float | None = None, steepest: float = STEEPEST
) -> Mixture:
    """Weights for a table of (group, tokens).

    ``entropy`` is the target over the greatest possible, 0 to 1; with ``steepest`` 1, weights are
    flattened towards it but never sharpened. ``budget`` is in tokens, those of the table if not given.
    If a source would be repeated more than ``max_repeats`` times, the exponent moves towards 1 until
    none is; if even natural shares repeat more, the budget is lowered to the limit. So no source,
    however small, takes from the budget of the others. Groups without tokens have no weight.
    """
    shares = tokens.where("tokens > 0")
    total = shares.agg(F.sum("tokens")).first()[0]
    if not total:
        empty = shares.select("group", "tokens", F.lit(0.0).alias("weight"), F.lit(0.0).alias("quota"))
        return Mixture(1.0, 0.0, empty)
    shares = shares.withColumn("share", F.col("tokens") / F.lit(float(total)))
    budget = min(float(total if budget is None else budget), max_repeats * total)
    limit = max_repeats * (1 + 1e-9)

    def search(low: float, high: float, holds) -> float:
        """The smallest exponent in the range for which ``holds``; that of the range's end if none."""
        for _ in range(_ROUNDS):
            steps = [low + (high - low) * i / _SECTIONS for i in range(_SECTIONS + 1)]
            first = next((x for x, h, r in _measures(shares, steps, budget) if holds(h, r)), high)
            low, high = max(low, first - (high - low) / _SECTIONS), first
            if low >= high:
                break
        return high

    exponent = search(0.0, steepest, lambda h, _: h <= entropy)
    if exponent < 1:
        exponent = search(exponent, 1.0, lambda _, r: r <= limit)
    elif exponent > 1 and _measures(shares, [exponent], budget)[0][2] > limit:
        exponent = max(1.0, search(1.0, exponent, lambda _, r: r > limit) - (exponent - 1) / _SECTIONS**_ROUNDS)
    raised = F.exp(F.lit(exponent) * F.log("share"))
    z = shares.agg(F.sum(raised)).first()[0]
    weight = raised / F.lit(z)
    quota = F.least(weight * F.lit(budget), F.col("tokens") * F.lit(float(max_repeats)))
    return Mixture(exponent, budget, shares.select("group", "tokens", weight.alias("weight"), quota.alias("quota")))


def mix_sources(
    docs: DataFrame,
    entropy: float = 0.95,
    max_repeats: float = 4.0,
    budget: float | None = None,
    steepest: float = STEEPEST,
    seed: int = 11,
    per_block: int = 1 << 20,
) -> DataFrame:
    """The draws: doc_id, source, n_tokens, weight, epoch, block, before.

    One row for each time that a document of ``docs`` (doc_id, source, text) is drawn; ``epoch``
    counts from 0, and ``before`` is the number of tokens ahead of it in its source's
    permutation of that epoch. A document's tokens are its words. A document is drawn while the
    tokens ahead of it are below its source's quota, so a source exceeds it by less than one document.
    Rows that repeat a doc_id and source are one document; null is a source, and a doc_id, like any
    other. A source without any word has no weight and is not drawn; an empty table gives none.
    """
    sized = materialize(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count().alias("n_tokens"))
        .groupBy("doc_id", "source")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .withColumn("group", group_key("source")),
        "sized",
    )
    mixed = mixture(
        materialize(sized.groupBy("group").agg(F.sum("n_tokens").alias("tokens")), "source_tokens"),
        entropy,
        max_repeats,
        budget,
        steepest,
    )
    quotas = materialize(mixed.sources, "quotas")
    epochs = F.greatest(F.ceil(F.col("quota") / F.col("tokens") - 1e-9), F.lit(1)).cast("int")
    whole = F.floor(F.col("quota") / F.col("tokens") + 1e-9)
    drawn = (
        sized.join(quotas, "group")
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), epochs - 1)))
        .withColumn("left", F.when(F.col("epoch") < whole, F.lit(float("inf"))).otherwise(F.col("quota") - whole * F.col("tokens")))
        .withColumn("_queue", F.concat("group", F.lit("|"), F.col("epoch").cast("string")))
        .select("doc_id", "source", "n_tokens", "weight", "epoch", "left", "_queue")
    )
    placed = running_totals(drawn, "_queue", ["doc_id"], "n_tokens", seed, per_block)
    return placed.where("before < left").select("doc_id", "source", "n_tokens", "weight", "epoch", "block", "before")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs``, each as often as its document is drawn, with the columns of ``docs``.

    Other columns, whatever their names, go along; for nulls, ties, repeated rows and empty tables see ``mix_sources``.
    """
    mark, times, copy = (free_name(docs, c) for c in ("_mark", "_times", "_copy"))
    drawn = mix_sources(docs, **how).groupBy("doc_id", "source").agg(F.count(F.lit(1)).cast("int").alias(times))
    found = docs.withColumn(mark, group_key("doc_id", "source")).join(drawn.select(group_key("doc_id", "source").alias(mark), times), mark)
    return found.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
