"""Temperature mixing of sources, realised as block permutations within a token budget."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanderbeam.llm.sharding import prefix_sums
from wanderbeam.llm.text import words
from wanderbeam.session import materialise

# Source tables up to this many rows are broadcast (a row is a name and four numbers).
BROADCAST_SOURCES = 100_000


@dataclass(frozen=True)
class MixSpec:
    """Targets of a mix.

    ``entropy``: wanted entropy of the weights as a fraction of ln(number of sources).
    ``max_repeats``: no source may be used more often than this. If both are given and
    disagree, the repetition limit wins. ``budget``: tokens to draw; None draws as many as there are.
    """

    entropy: float | None = 0.95
    max_repeats: float | None = 4.0
    budget: int | None = None
    steps: int = 40
    seed: str = "mix"


def document_tokens(text: Column) -> Column:
    """Words plus one end token, so that an empty document weighs something too."""
    return (F.size(words(text)) + 1).cast("long")


def source_tokens(docs: DataFrame, source: str, tokens: Column) -> DataFrame:
    """One row per source with its documents and tokens; NULL is a source of its own."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.count(F.lit(1)).alias("docs"), F.sum(tokens).cast("long").alias("tokens")
    )


def bisect_exponent(sources: DataFrame, spec: MixSpec) -> float:
    """The exponent whose weights meet the target, in [0, 1].

    Five halvings at a time: one aggregation over the sources evaluates the 31 dyadic points
    inside the interval, and the interval shrinks to the one that five single bisection steps
    would reach. Entropy falls and the largest repetition falls as the exponent grows to 1, so
    the entropy target is an upper bound for it and the repetition limit a lower one. One source,
    or none, gives 1. Only the 62 sums reach the driver, never the sources.
    """
    totals = sources.agg(F.sum("tokens"), F.count(F.lit(1)), F.min("tokens")).first()
    whole, count = totals[0] or 0, totals[1]
    if count < 2:
        return 1.0
    budget = spec.budget or whole
    share = F.col("tokens") / F.lit(float(whole))

    def sums(points: list[float]) -> list[tuple[float, float]]:
        """(entropy, largest repetition) at each exponent."""
        power = [F.pow(share, F.lit(a)) for a in points]
        row = sources.agg(*[x for p in power for x in (F.sum(p), F.sum(p * F.ln(share)), F.max(p / F.col("tokens")))]).first()
        out = []
        for k, a in enumerate(points):
            z, zl, most = row[3 * k : 3 * k + 3]
            out.append((math.log(z) - a * zl / z, budget * most / z))
        return out

    def bisected(good) -> tuple[float, float]:
        """The last halving of [0, 1] with ``good`` true at its lower end."""
        low, high = 0.0, 1.0
        for _ in range(max(1, spec.steps // 5)):
            step = (high - low) / 32
            points = [low + step * k for k in range(1, 32)]
            k = sum(good(x) for x in sums(points))  # monotone: true up to a point
            low, high = low + step * k, low + step * (k + 1)
        return low, high

    alpha = 1.0
    if spec.entropy is not None:
        target = spec.entropy * math.log(count)
        if sums([1.0])[0][0] < target:
            alpha = bisected(lambda x: x[0] >= target)[0]
    if spec.max_repeats is not None:
        # At exponent 1 every source repeats budget / whole times; no exponent below it repeats less.
        if sums([alpha])[0][1] > spec.max_repeats:
            alpha = max(alpha, bisected(lambda x: x[1] > spec.max_repeats)[1])
    return alpha


def mixing_plan(sources: DataFrame, spec: MixSpec) -> DataFrame:
    """source, docs, tokens, weight, allowance, passes, rest and alpha of every source.

    ``allowance`` is the source's part of the budget in tokens: ``passes`` whole uses of the
    source and ``rest`` tokens of one more.
    """
    alpha = bisect_exponent(sources, spec)
    whole = sources.agg(F.sum("tokens")).first()[0] or 1
    power = F.pow(F.col("tokens") / F.lit(float(whole)), F.lit(alpha))
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    planned = sources.withColumn("weight", power / F.lit(float(norm))).withColumn(
        "allowance", F.floor(F.col("weight") * F.lit(float(spec.budget or whole)) + F.lit(1e-6)).cast("long")
    )
    return planned.select(
        "source",
        "docs",
        "tokens",
        "weight",
        "allowance",
        F.expr("allowance div tokens").cast("int").alias("passes"),
        (F.col("allowance") % F.col("tokens")).alias("rest"),
        F.lit(alpha).alias("alpha"),
    )


def permutation_key(doc_id: str, seed: str, block: Column) -> Column:
    """Place of a document in the permutation of one block, the same on every recomputation."""
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.md5(F.concat_ws("#", F.lit(seed), name, block.cast("string")))


def mix(
    docs: DataFrame,
    spec: MixSpec = MixSpec(),
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    partitions: int | None = None,
    names: tuple[str, str, str] = ("mix_tokens", "mix_block", "mix_key"),
) -> DataFrame:
    """The mixed corpus: the rows of ``docs`` plus the columns ``names``: tokens, block and key.

    Columns of ``docs`` that have one of these names are left out.

    Every source is used ``passes`` times in whole, each block in a permutation of its own
    (order by ``mix_block``, ``mix_key``), then the last block takes its permutation as long as
    the ``rest`` tokens last. Only (source, key, tokens) are range-partitioned to find where
    the last block ends, so a source with most of the rows is spread over all tasks; what
    comes back is one cut key per source, and the texts themselves are never shuffled.
    Rows of one source with the same id stand or fall together in the last block. NULL sources
    are one source, NULL ids one id, NULL texts empty. An empty table gives no rows.
    """
    kept = [c for c in docs.columns if c not in names]
    counted = docs.select(*[F.col(f"`{c}`") for c in kept], document_tokens(F.col(f"`{text}`")).alias("__mix_tokens"))
    narrow = materialise(
        counted.select(F.col(f"`{source}`").alias("source"), F.col(f"`{doc_id}`").alias("doc_id"), F.col("__mix_tokens").alias("mix_tokens")),
        "mix-rows",
    )
    sources = materialise(source_tokens(narrow, "source", F.col("mix_tokens")), "mix-sources")
    plan = materialise(mixing_plan(sources, spec), "mix-plan")
    small = plan.count() <= BROADCAST_SOURCES
    offered = plan.withColumnRenamed("source", "__source")

    def with_plan(df: DataFrame, name: Column, side: DataFrame) -> DataFrame:
        return df.join(F.broadcast(side) if small else side, name.eqNullSafe(side["__source"])).drop("__source")

    last = with_plan(narrow, narrow["source"], offered.select("__source", "passes", "rest").where("rest > 0"))
    keyed = (
        last.withColumn("key", permutation_key("doc_id", spec.seed, F.col("passes")))
        .groupBy("source", "key", "rest")
        .agg(F.sum("mix_tokens").alias("tokens"))
    )
    summed = prefix_sums(keyed, ["source", "key"], {"tokens": "before"}, partitions)
    summed = materialise(summed, "mix-sums")
    base = summed.groupBy(F.col("source").alias("__source")).agg(F.min("before").alias("base"))
    cuts = (
        with_plan(summed, summed["source"], base)
        .where(F.col("before") - F.col("base") + F.col("tokens") <= F.col("rest"))
        .groupBy(F.col("source").alias("__source"))
        .agg(F.max("key").alias("cut"))
    )
    ends = offered.alias("p").join(cuts.withColumnRenamed("__source", "__cut"), F.expr("p.__source <=> __cut"), "left")
    ends = materialise(ends.select("__source", F.col("passes").alias("__passes"), F.col("cut").alias("__end")), "mix-ends")
    used = with_plan(counted, F.col(f"`{source}`"), ends)
    block = F.explode(F.sequence(F.lit(0), F.col("__passes"))).alias("__mix_block")
    rows = used.select("*", block).withColumn("__mix_key", permutation_key(doc_id, spec.seed, F.col("__mix_block")))
    taken = (F.col("__mix_block") < F.col("__passes")) | F.coalesce(F.col("__mix_key") <= F.col("__end"), F.lit(False))
    added = [F.col(c).alias(n) for c, n in zip(("__mix_tokens", "__mix_block", "__mix_key"), names)]
    return rows.where(taken).select(*[F.col(f"`{c}`") for c in kept], *added)
