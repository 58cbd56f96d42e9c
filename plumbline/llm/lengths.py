"""Token counts as an exact histogram of encoded lengths.

Documents are encoded once and counted by group and length; suffix sums over the distinct lengths of a group then
answer, for every context limit L, how many documents are longer, how many tokens all documents have, and how many are
left if each is truncated to L. Quantiles are read off the same table. The histogram of a group has as many rows as the
group has distinct lengths, whatever its number of documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import column_of, give_back, pieces
from plumbline.llm.encoding import encoder


def encoded_lengths(docs: DataFrame, tokenizer: str, groups: list[str]) -> DataFrame:
    """``groups`` and ``n_tokens`` of each row (null text: 0 tokens)."""
    wanted = docs.select(*groups, F.col("text").cast("string").alias("text"))
    schema = wanted.drop("text").withColumn("n_tokens", F.lit(0).cast("long")).schema

    def count(batches):
        tokens = encoder(tokenizer)
        try:
            for piece in pieces(batches):
                n = tokens.counts_of(column_of(piece, "text"))
                yield pa.RecordBatch.from_arrays([*piece.columns[:-1], pa.array(n)], names=[*groups, "n_tokens"])
        finally:
            tokens.rest()
            give_back()

    return wanted.mapInArrow(count, schema)


def length_histogram(docs: DataFrame, tokenizer: str, groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """One row per group and encoded length.

    ``n_tokens`` is the length, ``n_docs`` the documents of it, ``docs_upto`` and ``docs_longer`` those of at most and of
    more than it, ``group_docs`` and ``group_tokens`` all of the group, ``truncated_tokens`` the tokens that are left
    with a context limit of ``n_tokens``, and ``rank_share`` = docs_upto / group_docs, so the smallest length whose
    share is at least q is the q-quantile. A limit between two lengths L < M <= next leaves
    truncated_tokens(L) + (M - L) * docs_longer(L). Null groups are groups; an empty table gives no rows.
    """
    names = [f"_g{i}" for i in range(len(groups))]
    renamed = docs.select(*[F.col(g).alias(n) for g, n in zip(groups, names, strict=True)], "text")
    counted = encoded_lengths(renamed, tokenizer, names).groupBy(*names, "n_tokens").agg(F.count("*").alias("n_docs"))
    group = Window.partitionBy(*names)
    upto = group.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    whole = counted.select(
        *names,
        "n_tokens",
        "n_docs",
        F.sum("n_docs").over(upto).alias("docs_upto"),
        F.sum("n_docs").over(group).alias("group_docs"),
        F.sum(F.col("n_docs") * F.col("n_tokens")).over(upto).alias("_tokens_upto"),
        F.sum(F.col("n_docs") * F.col("n_tokens")).over(group).alias("group_tokens"),
    )
    longer = F.col("group_docs") - F.col("docs_upto")
    return whole.select(
        *[F.col(n).alias(g) for g, n in zip(groups, names, strict=True)],
        "n_tokens",
        "n_docs",
        "docs_upto",
        longer.alias("docs_longer"),
        "group_docs",
        "group_tokens",
        (F.col("_tokens_upto") + longer * F.col("n_tokens")).alias("truncated_tokens"),
        F.round(F.col("docs_upto") / F.col("group_docs"), 9).alias("rank_share"),
    )


def at_limits(histogram: DataFrame, groups: list[str], limits: list[int]) -> DataFrame:
    """Documents and tokens within given context limits: truncated totals for limits that are no length, too."""
    rows = histogram.select(*groups, "n_tokens", "n_docs", "group_tokens")
    each = rows.withColumn("context_limit", F.explode(F.array(*[F.lit(x).cast("long") for x in limits])))
    return each.groupBy(*groups, "context_limit").agg(
        F.sum(F.least("n_tokens", "context_limit") * F.col("n_docs")).alias("truncated_tokens"),
        F.sum(F.when(F.col("n_tokens") <= F.col("context_limit"), F.col("n_docs")).otherwise(0)).alias("docs_within"),
        F.max("group_tokens").alias("group_tokens"),
    )


def quantiles(histogram: DataFrame, groups: list[str], shares: list[float]) -> DataFrame:
    """The smallest length that at least a share q of a group's documents do not exceed, for each q."""
    each = histogram.withColumn("share", F.explode(F.array(*[F.lit(float(q)) for q in shares])))
    enough = F.col("docs_upto") >= F.col("share") * F.col("group_docs") - 1e-9
    return each.filter(enough).groupBy(*groups, "share").agg(F.min("n_tokens").alias("n_tokens"))
