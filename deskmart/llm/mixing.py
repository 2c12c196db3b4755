"""Mixing sources to target weights: temperature, and budgets realised as permuted blocks."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskmart.llm.common import KEY, text_key, text_of, written

WORD = r"[^\x20\x09-\x0D]+"
DOCS_PER_BIN = 20_000
_STEPS, _WAYS = 10, 16  # ten jobs of four bisection steps each


@dataclass(frozen=True)
class Target:
    """What the mix aims at.

    ``max_repeats``: no source is seen more often than this. ``entropy``: of the weights, in nats.
    With both, the limit on repeats wins. ``budget``: tokens in all; None for the least budget that
    shows every document at least once.
    """

    max_repeats: float | None = 1.5
    entropy: float | None = None
    budget: int | None = None


def units(docs: DataFrame, source: str = "source") -> DataFrame:
    """source, doc_id, key of the text, tokens (words) and copies of the different rows of ``docs``."""
    return (docs.select(F.coalesce(F.col(source).cast("string"), F.lit("")).alias("source"), "doc_id", *text_key(),
                        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("tokens"))
            .groupBy("source", "doc_id", *KEY, "tokens").agg(F.count("*").alias("copies")))


def _measures(sources: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """For each exponent: entropy of the weights, and the most and fewest repeats for a budget of all tokens."""
    a, p = F.col("a"), F.col("share")
    rows = (sources.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
            .groupBy("a").agg(F.sum(F.pow(p, a)), F.sum(F.pow(p, a) * a * F.log(p)),
                              F.max(F.pow(p, a - 1)), F.min(F.pow(p, a - 1))).collect())
    found = {row[0]: (math.log(row[1]) - row[2] / row[1], row[3] / row[1], row[4] / row[1]) for row in rows}
    return [found[x] for x in exponents]


def bisect_exponent(sources: DataFrame, target: Target, tokens: int) -> float:
    """The smallest exponent in 0 .. 1 (the flattest mix) that keeps to the target.

    Repeats and entropy both fall as the exponent rises to 1, so the interval around the crossing is
    halved; one job tries the inner points of four halvings, as one aggregate over the sources. An
    unreachable target ends at the nearer end: 1 leaves the natural shares.
    """
    def keeps(measure: tuple[float, float, float]) -> bool:
        entropy, most, fewest = measure
        repeats = most / fewest if target.budget is None else most * target.budget / tokens
        if target.max_repeats is not None and repeats > target.max_repeats * (1 + 1e-12):
            return False
        return target.entropy is None or target.max_repeats is not None or entropy <= target.entropy

    if target.max_repeats is not None and target.entropy is not None:
        limit = bisect_exponent(sources, Target(target.max_repeats, None, target.budget), tokens)
        return max(limit, bisect_exponent(sources, Target(None, target.entropy, target.budget), tokens))
    low, high = 0.0, 1.0
    if keeps(_measures(sources, [low])[0]):
        return low
    for _ in range(_STEPS):
        inner = [low + (high - low) * i / _WAYS for i in range(1, _WAYS)]
        kept = [x for x, m in zip(inner, _measures(sources, inner)) if keeps(m)]
        high = kept[0] if kept else high
        low = max((x for x in inner if x < high), default=low)
    return high


def plan_sources(rows: DataFrame, target: Target) -> DataFrame:
    """One row per source with tokens: share, exponent, weight, token budget, and ``bits``, the
    number of hash bits that deal the source's rows into bins of about DOCS_PER_BIN."""
    sums = written(
        rows.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens"), F.count("*").alias("rows"))
        .where("tokens > 0"), "sources")
    total = sums.agg(F.sum("tokens")).first()[0]
    if not total:
        return sums.select("source", "tokens", *(F.lit(0.0).alias(c) for c in ("share", "exponent", "weight")),
                           F.lit(0).cast("long").alias("budget"), F.lit(0).alias("bits"))
    shares = sums.withColumn("share", F.col("tokens") / F.lit(total))
    exponent = bisect_exponent(shares, target, total)
    power = F.pow("share", F.lit(exponent))
    scale, fewest = shares.agg(F.sum(power), F.min(power / F.col("share"))).first()
    budget = target.budget if target.budget is not None else total * scale / fewest
    weight = power / F.lit(scale)
    bits = F.ceil(F.log2(F.greatest(F.lit(1.0), F.col("rows") / DOCS_PER_BIN))).cast("int")
    return written(shares.select(
        "source", "tokens", "share", F.lit(exponent).alias("exponent"), weight.alias("weight"),
        F.round(weight * F.lit(float(budget))).cast("long").alias("budget"), bits.alias("bits")), "plan")


def place(epoch: Column, seed: int) -> Column:
    """Where a row stands in the permutation of its source in an epoch: 63 hash bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch, "doc_id", *KEY), 1)


def _offsets(rows: DataFrame) -> DataFrame:
    """``rows`` (source, epoch, place, bits, tokens, copies) with ``start``: the tokens that stand
    before the row in its source and epoch.

    Rows are summed up per bin of the leading hash bits, bins per source and epoch, and only rows of
    one bin are sorted together; equal rows are one.
    """
    rows = rows.withColumn("bin", F.expr("shiftright(place, 63 - bits)"))
    weight = F.col("tokens") * F.col("copies")
    bins = rows.groupBy("source", "epoch", "bin").agg(F.sum(weight).alias("_n"))
    order = Window.partitionBy("source", "epoch").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    skips = bins.select("source", "epoch", "bin", F.coalesce(F.sum("_n").over(order), F.lit(0)).alias("_skip"))
    own = (Window.partitionBy("source", "epoch", "bin").orderBy("place", "doc_id", *KEY)
           .rowsBetween(Window.unboundedPreceding, -1))
    return (rows.withColumn("_own", F.coalesce(F.sum(weight).over(own), F.lit(0)))
            .join(skips, ["source", "epoch", "bin"])
            .withColumn("start", F.col("_skip") + F.col("_own")).drop("_skip", "_own", "bin"))


def mix_schedule(docs: DataFrame, source: str = "source", target: Target = Target(), blocks: int = 64,
                 seed: int = 4) -> DataFrame:
    """doc_id, source, tokens, epoch, block, place, weight, exponent of every showing of a document.

    Weights are token shares to the power of the exponent, normalised. Each source walks through
    its documents, epoch after epoch, each in a new permutation; a showing that would pass the
    source's token budget ends the walk, where equal rows count as one. The walk is cut into
    ``blocks`` equal parts of the budget, so every block holds all sources by weight; inside a block
    documents are shown by ``place``.

    A source without a token in any document has no weight and is shown once, in block 0. Null
    sources are one source, null texts have no tokens, null ids are one id; repeated rows are shown
    as often as they occur; further columns are ignored; an empty table gives no rows.
    """
    rows = written(units(docs, source), "units")
    plan = plan_sources(rows, target)
    own = plan.select("source", F.col("tokens").alias("own_tokens"), "budget", "bits", "weight", "exponent")
    planned = rows.join(own, "source", "left")
    last = F.coalesce(F.floor((F.col("budget") - 1) / F.col("own_tokens")), F.lit(0))
    shown = (planned.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(last, F.lit(0)).cast("long"))))
             .withColumn("bits", F.coalesce("bits", F.lit(0)))
             .withColumn("place", place(F.col("epoch"), seed)))
    walked = _offsets(shown)
    begin = F.col("epoch") * F.col("own_tokens") + F.col("start")
    end = begin + F.col("tokens") * F.col("copies")
    # least() passes over nulls, so sources without a budget are told apart first
    block = F.when(F.col("budget").isNotNull(), F.least(F.floor(begin * blocks / F.col("budget")), F.lit(blocks - 1)))
    return (walked.where(F.col("budget").isNull() | (end <= F.col("budget")))
            .withColumn("block", F.coalesce(block, F.lit(0)).cast("int"))
            .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
            .select("doc_id", "source", "tokens", F.col("epoch").cast("int").alias("epoch"), "block", "place",
                    F.coalesce("weight", F.lit(0.0)).alias("weight"), F.coalesce("exponent", F.lit(0.0)).alias("exponent")))


def mix_documents(docs: DataFrame, source: str = "source", target: Target = Target(), seed: int = 4) -> DataFrame:
    """The rows of ``docs``, with all their columns, as often as ``mix_schedule`` shows them.

    A budget cuts a permutation at one place, so each source has full epochs and one last place;
    texts are read once more and meet only that small table. Null sources are one source, null texts have no tokens and
    null ids are one id; repeated rows are shown as often as they occur; an empty table stays empty.
    """
    rows = written(units(docs, source), "units")
    plan = plan_sources(rows, target)
    full = F.floor(F.col("budget") / F.col("own_tokens"))
    cuts = plan.select("source", F.col("tokens").alias("own_tokens"), "budget", "bits").withColumn("epoch", full)
    partial = _offsets(rows.join(cuts.where("budget > epoch * own_tokens"), "source")
                       .withColumn("place", place(F.col("epoch"), seed)))
    end = F.col("epoch") * F.col("own_tokens") + F.col("start") + F.col("tokens") * F.col("copies")
    reached = partial.where(end <= F.col("budget")).groupBy("source").agg(F.max("place").alias("cut"))
    final = written(cuts.join(reached, "source", "left").select(
        F.col("source").alias("_source"), F.col("epoch").alias("_epoch"), F.coalesce("cut", F.lit(-1)).alias("_cut")), "cuts")
    joined = (docs.select(F.struct(*docs.columns).alias("row"), "doc_id", *text_key(),
                          F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"))
              .join(final, "_source", "left"))
    times = F.coalesce(F.col("_epoch") + (place(F.col("_epoch"), seed) <= F.col("_cut")).cast("long"), F.lit(1))
    return (joined.withColumn("times", times.cast("long")).where("times > 0")
            .withColumn("showing", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
            .select("row.*"))
