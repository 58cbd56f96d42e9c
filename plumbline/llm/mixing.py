"""Temperature mixing of sources, realised as budgeted block permutations.

A source's weight is its share of all tokens to the power ``alpha``, normalised: 1 keeps the mixture, 0 makes all sources
equal. ``alpha`` is found by bisection: the smallest that respects a limit on how often a source is repeated, or the one
whose weights reach a target entropy.

The weights are realised on blocks. Each source's rows are dealt by a seeded hash to BLOCKS_PER_SOURCE blocks; an epoch is
a seeded permutation of the blocks. A source's budget buys whole epochs and then blocks of the next permutation, as long
as their middle is within what is left, so realised tokens are within half a block of the weight. A hot source is spread
over as many blocks as any other, and only its blocks' sizes are ever ordered.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import SPACE_CLASS, row_and, stratum_key, text_or_empty

BLOCKS_PER_SOURCE = 1024
SEED = 8_191

#: The most epochs of any source, where the budget is that of one epoch of the source that is repeated least.
REPEAT_LIMIT = 1.5


def entropy(weights: list[float]) -> float:
    """In nats."""
    return -sum(w * math.log(w) for w in weights if w > 0)


def tempered(shares: list[float], alpha: float) -> list[float]:
    """Normalised powers of the shares; computed from logarithms so that no power underflows."""
    logs = [alpha * math.log(s) for s in shares]
    top = max(logs)
    powers = [math.exp(x - top) for x in logs]
    return [p / math.fsum(powers) for p in powers]


def solve_alpha(shares: list[float], repeat_limit: float | None = None, target_entropy: float | None = None) -> float:
    """The exponent in [0, 1], by bisection.

    With ``repeat_limit``: the smallest exponent at which no source is repeated more than so many times as often as the
    one repeated least. With ``target_entropy`` (nats): the exponent of that entropy, or the nearest end of the range.
    """
    if (repeat_limit is None) == (target_entropy is None):
        raise ValueError("give a repetition limit or a target entropy")
    if len(shares) < 2:
        return 1.0

    def too_flat(alpha: float) -> bool:
        weights = tempered(shares, alpha)
        if target_entropy is not None:
            return entropy(weights) > target_entropy
        repeats = [w / s for w, s in zip(weights, shares, strict=True)]
        return max(repeats) > repeat_limit * min(repeats) * (1 + 1e-12)

    if not too_flat(0.0):
        return 0.0
    low, high = 0.0, 1.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if too_flat(mid) else (low, mid)
    return high


def word_count() -> object:
    """Words of a text, the default measure of tokens."""
    return F.size(F.filter(F.split(text_or_empty(), f"[{SPACE_CLASS}]+"), lambda w: w != "")).cast("long")


def source_weights(
    docs: DataFrame, tokens, repeat_limit: float | None, target_entropy: float | None, budget: int | None
) -> DataFrame:
    """``_s, tokens, weight, alpha, target``: one row per source, of a list whose length is the number of sources.

    Without a ``budget`` the least repeated source is taken exactly once. Sources without tokens have no weight.
    """
    spark = docs.sparkSession
    totals = docs.select(stratum_key("source").alias("_s"), tokens.alias("_t")).groupBy("_s").agg(F.sum("_t").alias("n"))
    rows = sorted((r["_s"], r["n"]) for r in totals.filter("n > 0").collect())
    schema = "_s string, tokens long, weight double, alpha double, target double"
    if not rows:
        return spark.createDataFrame([], schema)
    total = sum(n for _, n in rows)
    shares = [n / total for _, n in rows]
    alpha = solve_alpha(shares, repeat_limit, target_entropy)
    weights = tempered(shares, alpha)
    size = budget if budget is not None else max(n / w for (_, n), w in zip(rows, weights, strict=True))
    made = [(s, n, w, alpha, w * size) for (s, n), w in zip(rows, weights, strict=True)]
    return spark.createDataFrame(made, schema)


def _taken(
    docs: DataFrame,
    repeat_limit: float | None = REPEAT_LIMIT,
    target_entropy: float | None = None,
    budget: int | None = None,
    tokens=None,
    seed: int = SEED,
    blocks: int = BLOCKS_PER_SOURCE,
) -> DataFrame:
    """``_row`` as often as its block is taken, and what the mixture decided about it."""
    tokens = word_count() if tokens is None else tokens
    weights = source_weights(docs, tokens, repeat_limit, target_entropy, budget)
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce("text", F.lit("")))
    dealt = row_and(docs, "doc_id", "text", "source").withColumns({"_s": stratum_key("source"), "block": F.pmod(key, F.lit(blocks)).cast("int")})

    # Epochs and the partial epoch of each block: ordered within a source by the seeded hash of (epoch, block).
    sizes = dealt.select("_s", "block", tokens.alias("_t")).groupBy("_s", "block").agg(F.sum("_t").alias("_t"))
    plan = sizes.join(F.broadcast(weights) if weights.count() <= 10_000 else weights, "_s", "left")
    whole = F.floor(F.col("target") / F.col("tokens") + 1e-9)
    plan = plan.withColumns(
        {
            "_whole": F.coalesce(whole, F.lit(1)).cast("int"),
            "_left": F.coalesce(F.greatest(F.lit(0.0), F.col("target") - whole * F.col("tokens")), F.lit(0.0)),
        }
    )
    drawn = F.xxhash64(F.lit(seed), F.col("_whole"), F.col("block"), F.col("_s"))
    before = Window.partitionBy("_s").orderBy(drawn, "block").rowsBetween(Window.unboundedPreceding, -1)
    middle = F.coalesce(F.sum("_t").over(before), F.lit(0)) + F.col("_t") / 2
    plan = plan.withColumn("_times", F.col("_whole") + (middle < F.col("_left")).cast("int"))
    each = plan.filter("_times > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_times") - 1)))
    order = F.xxhash64(F.lit(seed), F.col("epoch"), F.col("block"), F.col("_s"))
    ranked = each.select(
        "_s",
        "block",
        "alpha",
        "weight",
        "epoch",
        F.row_number().over(Window.partitionBy("_s", "epoch").orderBy(order, "block")).alias("block_rank"),
    )
    # A row's block names all its copies: they travel with the block's plan, and the rows are read once.
    copies = ranked.groupBy("_s", "block").agg(
        F.first("alpha").alias("alpha"),
        F.first("weight").alias("weight"),
        F.sort_array(F.collect_list(F.struct("epoch", "block_rank"))).alias("_copies"),
    )
    return (
        dealt.select("_row", "_s", "block").join(copies, ["_s", "block"])
        .withColumn("_copy", F.explode("_copies"))
        .select("_row", "alpha", "weight", F.col("_copy.epoch"), "block", F.col("_copy.block_rank"))
    )


def mixed(
    docs: DataFrame,
    repeat_limit: float | None = REPEAT_LIMIT,
    target_entropy: float | None = None,
    budget: int | None = None,
    tokens=None,
    seed: int = SEED,
    blocks: int = BLOCKS_PER_SOURCE,
) -> DataFrame:
    """``docs`` with each row as often as its block is taken, and ``alpha, weight, epoch, block, block_rank``.

    ``epoch`` counts from 0 and ``block_rank`` is the block's place in the permutation of that epoch. Only ``budget``
    tokens below a source's weight leave rows out, by whole blocks; without a budget every source is taken at least
    once. A null source is a source. Rows without tokens are taken as often as their block; of a source that has no
    tokens at all, once. Rows with equal ids and texts share a block. An empty table gives an empty result. A column that
    has the name of one that is added gives way to it.
    """
    added = ["alpha", "weight", "epoch", "block", "block_rank"]
    taken = _taken(docs, repeat_limit, target_entropy, budget, tokens, seed, blocks)
    return taken.select(*[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in added], *added)


def mixed_rows(
    docs: DataFrame,
    repeat_limit: float | None = REPEAT_LIMIT,
    target_entropy: float | None = None,
    budget: int | None = None,
    tokens=None,
    seed: int = SEED,
    blocks: int = BLOCKS_PER_SOURCE,
) -> DataFrame:
    """The rows of ``mixed`` with the columns of ``docs`` alone, whatever their names."""
    return _taken(docs, repeat_limit, target_entropy, budget, tokens, seed, blocks).select("_row.*")
