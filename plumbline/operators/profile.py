"""Column profiles and tallies for quality reports."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

SAMPLE_VALUES = 5


def long_values(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, value)`` with one row per cell; values as text, nulls kept."""
    names = list(columns or df.columns)
    # Adding zero makes one value of the two zeros of a float column.
    kinds = dict(df.dtypes)
    same_zero = lambda c: F.col(f"`{c}`") + F.lit(0.0) if kinds[c] in ("float", "double") else F.col(f"`{c}`")
    as_text = df.select(*[same_zero(c).cast(kinds[c]).cast("string").alias(c) for c in names])
    return as_text.unpivot([], names, "column", "value")


def column_value_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """``(column, value, n)``; null and NaN count as values. Equal cells merge before the shuffle."""
    return long_values(df, columns).groupBy("column", "value").agg(F.count("*").alias("n"))


def column_profile(counts: DataFrame, samples: int = SAMPLE_VALUES) -> DataFrame:
    """``column, n_distinct, nulls, fill_rate, sample`` from ``column_value_counts`` rows.

    The figures are partial sums. The sample ranks values with a limit Spark applies in every task before
    the shuffle, so a column with a billion distinct values sends only a handful of them per task.
    """
    figures = counts.groupBy("column").agg(
        F.count("value").alias("n_distinct"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.sum("n").alias("_rows"),
    )
    # Nulls rank last and are skipped by the list, so both branches read the same counts.
    first = Window.partitionBy("column").orderBy(F.col("value").asc_nulls_last())
    sample = (
        counts.select("column", "value", F.row_number().over(first).alias("_rank"))
        .filter(F.col("_rank") <= samples)
        .groupBy("column")
        .agg(F.sort_array(F.collect_list("value")).alias("sample"))
    )
    return figures.join(sample, "column", "left").select(
        "column",
        "n_distinct",
        "nulls",
        F.round(F.lit(1.0) - F.col("nulls") / F.col("_rows"), 6).alias("fill_rate"),
        F.coalesce("sample", F.array().cast("array<string>")).alias("sample"),
    )


def attribution_counts(df: DataFrame, chain: str | Column = "blockchain") -> DataFrame:
    """Rows per chain, with one named group for rows that carry no chain label."""
    label = F.col(chain) if isinstance(chain, str) else chain
    return df.groupBy(F.coalesce(label, F.lit("__unattributed__")).alias("chain")).agg(
        F.count("*").alias("n")
    )


def quarantine_counts(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reason").agg(F.count("*").alias("n"))


def quarantine_head(quarantine: DataFrame, limit: int = 10) -> DataFrame:
    return quarantine.orderBy("row_index").limit(limit)
