"""Sharding by proportional stratified interleaving, with DataFrame functions only.

Rows of each source are shuffled by a seeded hash and ranked; row r of a source of n rows gets the fractional rank
(2r + 1) / 2n. Sorted by it, the sources interleave in proportion everywhere, so cutting the order into equal runs
gives shards whose mixture is that of the whole. Shard sizes in rows are at most one apart (law ``rows``).

No rank is taken over a whole source or the whole table: rows are dealt to buckets of the seeded hash (of the
fractional rank), counts of lower buckets are summed, and a window ranks only the rows of one bucket. A source that
holds a third of all rows is spread over as many buckets as its size asks for.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import stratum_key, text_or_empty

#: Rows that one ranking window holds on average, at most.
ROWS_PER_BUCKET = 1 << 14
SEED = 20_241

_HASH_BITS = 62


def _below(counts: DataFrame, within: list[str], bucket: str, name: str) -> DataFrame:
    """Rows in lower buckets, by bucket."""
    window = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(0))
    before = window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn(name, F.coalesce(F.sum("_n").over(before), F.lit(0)))


def interleaved(
    docs: DataFrame,
    n_shards: int = 8,
    seed: int = SEED,
    rows_per_bucket: int = ROWS_PER_BUCKET,
    strata: tuple[str, ...] = ("source",),
) -> DataFrame:
    """Each row's place: ``doc_id, size, text_crc32, rank`` (over all rows), ``law, shard, slot, grown_shard``.

    ``size`` is the UTF-8 length of the text plus one. A null stratum value is a stratum of its own, a null text is
    empty, a null ``doc_id`` is hashed as a value of its own. Rows with equal ids are ordered by size and checksum;
    rows equal in all of these are interchangeable. An empty table gives an empty result.
    """
    text = text_or_empty()
    slim = docs.select(
        F.col("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        stratum_key(*strata).alias("_s"),
        F.shiftrightunsigned(
            F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 64 - _HASH_BITS
        ).alias("_h"),
    )
    total = docs.count()
    buckets = max(1, -(-total // rows_per_bucket))
    # The bucket is a range of the hash, so that bucket order is hash order.
    width = -(-(1 << _HASH_BITS) // buckets)
    slim = slim.withColumn("_b", F.expr(f"_h div {width}L"))

    counts = slim.groupBy("_s", "_b").agg(F.count("*").alias("_n"))
    sized = _below(counts, ["_s"], "_b", "_below").withColumn(
        "_total", F.sum("_n").over(Window.partitionBy("_s"))
    )
    in_bucket = Window.partitionBy("_s", "_b").orderBy("_h", "doc_id", "size", "text_crc32")
    ranked = (
        slim.join(sized.drop("_n"), ["_s", "_b"])
        .withColumn("_r", F.col("_below") + F.row_number().over(in_bucket) - 1)
        .withColumn("_fraction", (2 * F.col("_r") + 1) / (2 * F.col("_total")))
        .withColumn("_f", F.least(F.floor(F.col("_fraction") * buckets), F.lit(buckets - 1)).cast("long"))
        .select("doc_id", "size", "text_crc32", "_s", "_r", "_fraction", "_f")
    )
    by_fraction = _below(ranked.groupBy("_f").agg(F.count("*").alias("_n")), [], "_f", "_before")
    in_order = Window.partitionBy("_f").orderBy("_fraction", "_s", "_r")
    placed = ranked.join(by_fraction.drop("_n"), "_f").withColumn(
        "rank", F.col("_before") + F.row_number().over(in_order) - 1
    )
    shard = F.expr(f"cast((rank * {n_shards}) div {max(1, total)} as int)")
    first = F.expr(f"(cast(_shard as bigint) * {max(1, total)} + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("_shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        "rank",
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
