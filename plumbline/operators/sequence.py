"""Order-dependent checks over a capture, without sorting it in one task.

The order is a unique integer column such as ``row_index``. Rows are cut into buckets of consecutive order
values; ``lag`` runs inside each bucket, and the first row of a bucket takes the last value of the bucket
before it from an edge table. Bucket width grows with the span, so there are at most ``MAX_BUCKETS`` edges
(about 2 MB) at any size, and because the order is unique no bucket can hold more rows than its width.
Orders with big holes are range-partitioned by Spark's sampler instead and written once, so that the
partition number can serve as the bucket.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from plumbline.sources.workspace import Workspace

MAX_BUCKETS = 65_536
MIN_BUCKET_ROWS = 16_384
# Above this many order values per row the fixed-width buckets could be uneven.
SPARSE_FACTOR = 16

SECOND = 1_000_000
BACKWARD_TOLERANCE_S = 60.0
TRAILING_MAX_ROWS = 64
TRAILING_MAX_RATIO = 0.10


@dataclass(frozen=True)
class Span:
    """Extent of the order column: first and last value and the number of rows."""

    low: int
    high: int
    rows: int


def measure_span(df: DataFrame, order_by: str) -> Span:
    row = df.agg(
        F.min(order_by).alias("low"), F.max(order_by).alias("high"), F.count(order_by).alias("rows")
    ).first()
    return Span(row.low or 0, row.high or 0, row.rows)


def _bucketed(
    df: DataFrame, order_by: str, span: Span, min_rows: int, workspace: Workspace | None
) -> DataFrame:
    extent = span.high - span.low + 1
    if extent <= SPARSE_FACTOR * max(span.rows, 1):
        width = max(min_rows, -(-extent // MAX_BUCKETS))
        offset = F.col(order_by) - F.lit(span.low)
        return df.withColumn("_bucket", F.floor(offset / F.lit(width)).cast("bigint"))
    parts = min(MAX_BUCKETS, max(1, -(-span.rows // min_rows)))
    spread = df.repartitionByRange(parts, order_by).withColumn(
        "_bucket", F.spark_partition_id().cast("bigint")
    )
    return (workspace or Workspace(df.sparkSession)).stage(spread, "ordered")


def with_previous(
    df: DataFrame,
    order_by: str,
    value: str,
    *,
    span: Span | None = None,
    min_bucket_rows: int = MIN_BUCKET_ROWS,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``order_by, value, previous`` for every row whose value is set.

    ``previous`` is the value of the nearest earlier row that has one. Pass ``span`` to save the small
    job that measures it; it must cover every row.
    """
    filled = df.select(order_by, value).filter(F.col(value).isNotNull())
    buckets = _bucketed(
        filled, order_by, span or measure_span(filled, order_by), min_bucket_rows, workspace
    )
    edges = (
        buckets.groupBy("_bucket")
        .agg(F.max_by(value, order_by).alias("_last"))
        # One row per bucket, at most MAX_BUCKETS: the only ordering that spans the table.
        .select("_bucket", F.lag("_last").over(Window.orderBy("_bucket")).alias("_edge"))
        .filter(F.col("_edge").isNotNull())
    )
    inside = Window.partitionBy("_bucket").orderBy(order_by)
    return (
        buckets.withColumn("_lag", F.lag(value).over(inside))
        .join(F.broadcast(edges), "_bucket", "left")
        .select(order_by, value, F.coalesce("_lag", "_edge").alias("previous"))
    )


def timestamp_gaps(df: DataFrame, order_by: str, micros: str, **how) -> DataFrame:
    """``order_by, micros, previous, gap_us`` between consecutive stamped rows in source order."""
    return with_previous(df, order_by, micros, **how).filter(F.col("previous").isNotNull()).withColumn(
        "gap_us", F.col(micros) - F.col("previous")
    )


def _backward(gaps: DataFrame, tolerance_s: float) -> Column:
    return -gaps["gap_us"] > F.lit(round(tolerance_s * SECOND)).cast("bigint")


def backward_jumps(gaps: DataFrame, order_by: str, tolerance_s: float = BACKWARD_TOLERANCE_S) -> DataFrame:
    """``order_by, backward_us`` wherever time runs back by more than the tolerance."""
    return gaps.filter(_backward(gaps, tolerance_s)).select(
        order_by, (-F.col("gap_us")).alias("backward_us")
    )


def time_figures(gaps: DataFrame, order_by: str, tolerance_s: float = BACKWARD_TOLERANCE_S) -> DataFrame:
    """One row with everything the two time gates ask of the gaps, from a single pass:

    ``n_breaks, first_break, first_backward_us`` (nulls when time never runs back), ``n_gaps, min_gap_us,
    max_gap_us`` and ``fabricated``, true when the spacing is too even to be observed. Fewer than two gaps
    never count as fabricated.
    """
    gap = F.col("gap_us")
    late_at = F.when(_backward(gaps, tolerance_s), F.col(order_by))
    figures = gaps.agg(
        F.count(late_at).alias("n_breaks"),
        F.min(late_at).alias("first_break"),
        F.min(F.when(late_at.isNotNull(), F.struct(late_at, -gap)))["col2"].alias("first_backward_us"),
        F.count("*").alias("n_gaps"),
        F.min(gap).alias("min_gap_us"),
        F.max(gap).alias("max_gap_us"),
        F.avg(gap).alias("_mean"),
        F.stddev_pop(gap).alias("_spread"),
    )
    even = F.col("min_gap_us") == F.col("max_gap_us")
    tight = (F.col("_mean") > 0) & (F.col("_spread") / F.nullif(F.col("_mean"), F.lit(0.0)) < 1e-9)
    return figures.withColumn(
        "fabricated", (F.col("n_gaps") >= 2) & F.coalesce(even | tight, F.lit(False))
    ).drop("_mean", "_spread")


def ordering_breaks(gaps: DataFrame, order_by: str, tolerance_s: float = BACKWARD_TOLERANCE_S) -> DataFrame:
    """The ordering part of ``time_figures``."""
    return time_figures(gaps, order_by, tolerance_s).select("n_breaks", "first_break", "first_backward_us")


def fabrication_check(gaps: DataFrame, order_by: str) -> DataFrame:
    """The spacing part of ``time_figures``."""
    return time_figures(gaps, order_by).select("n_gaps", "min_gap_us", "max_gap_us", "fabricated")


def trailing_disorder(
    df: DataFrame,
    order_by: str,
    micros: str,
    *,
    tolerance_s: float = BACKWARD_TOLERANCE_S,
    max_rows: int = TRAILING_MAX_ROWS,
    max_ratio: float = TRAILING_MAX_RATIO,
    **how,
) -> DataFrame:
    """One row on the run after the last backward jump: where it starts and whether to quarantine it.

    ``cut`` is null unless the run reaches the end of the capture with every row stamped, has at most
    ``max_rows`` rows and at most ``max_ratio`` of them all. A longer run is left for the ordering gate.
    The last jump is looked up by a job of its own; the row itself is lazy.
    """
    gaps = timestamp_gaps(df, order_by, micros, **how)
    start = gaps.filter(_backward(gaps, tolerance_s)).agg(F.max(order_by)).first()[0]
    tail = F.col(order_by) >= F.lit(start).cast(df.schema[order_by].dataType)
    figures = df.agg(
        F.count("*").alias("total_rows"),
        F.count_if(tail).alias("run_rows"),
        F.count_if(tail & F.col(micros).isNull()).alias("unstamped"),
        F.min(F.when(tail, F.col(order_by))).alias("run_start"),
    )
    small = (F.col("run_rows") <= max_rows) & (F.col("run_rows") / F.col("total_rows") <= max_ratio)
    return figures.withColumn(
        "cut",
        F.when((F.col("run_rows") > 0) & (F.col("unstamped") == 0) & small, F.col("run_start")),
    )


def split_tail(df: DataFrame, order_by: str, cut: int | None) -> tuple[DataFrame, DataFrame]:
    """``(kept, quarantined)`` rows for the ``cut`` that ``trailing_disorder`` found."""
    if cut is None:
        return df, df.filter(F.lit(False))
    return df.filter(F.col(order_by) < cut), df.filter(F.col(order_by) >= cut)
