"""Token files: ids of documents in ascending ``doc_id`` order, as independent rANS blocks with shared frequencies.

A token file is a folder with two Parquet tables. ``table`` has one row, the shared frequency table (its size is bounded
by the vocabulary). ``blocks`` has one row per block of whole documents: ``shard`` and ``block`` give the order, the
``doc_ids`` and ``lengths`` its documents, and the payload is as in :mod:`plumbline.llm.rans`. Blocks decode in any order
and in parallel; Parquet gives splits, retries and atomic commits on whatever storage the session uses.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from plumbline.llm import rans
from plumbline.llm.common import column_of, give_back, packed, pieces, scratch
from plumbline.llm.encoding import encoder
from plumbline.sources import storage

#: Tokens at which a block is closed, blocks that are coded side by side, and tokens of a shard (one task's sort).
BLOCK_TOKENS = 1 << 16
SIDE_BY_SIDE = 64
SHARD_TOKENS = 1 << 24

BLOCKS = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("block", T.IntegerType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(T.LongType())),
        T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("lanes", T.IntegerType()),
        T.StructField("states", T.BinaryType()),
        T.StructField("offsets", T.BinaryType()),
        T.StructField("words", T.BinaryType()),
        T.StructField("crc32", T.LongType()),
    ]
)


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """``doc_id, n_tokens, width, ids, counts``: the ids of each text and ``end_id``, in ``width`` bytes each.

    The last row of each task has the number of times it saw each id as ``counts``, and nulls else; other rows have no counts.
    """

    def encode(batches):
        tokens = encoder(tokenizer)
        total = np.zeros(0, dtype=np.int64)
        try:
            for piece in pieces(batches):
                ids, n = tokens.ids_of(column_of(piece, "text"))
                ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
                found = np.bincount(ids)
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
                width = pa.array(np.full(len(n), tokens.dtype.itemsize, np.int32))
                arrays = [column_of(piece, "doc_id"), pa.array(n), width, packed(ids, n), pa.nulls(len(n), pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=names)
            if len(total):
                last = [pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.binary())]
                yield pa.RecordBatch.from_arrays([*last, pa.array([total.astype("<i8").tobytes()])], names=names)
        finally:
            tokens.rest()
            give_back()

    names = ["doc_id", "n_tokens", "width", "ids", "counts"]
    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(encode, "doc_id long, n_tokens long, width int, ids binary, counts binary")


def _arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    widths = column_of(batch, "width").to_pylist()
    values = column_of(batch, "ids").to_pylist()
    return [np.frombuffer(v, dtype=f"<u{w}") for v, w in zip(values, widths, strict=True)]


def token_counts(ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows of ``encoded`` and how often each occurs: one row of the vocabulary's size per task is merged."""

    def merge(batches):
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            for value in column_of(batch, "counts").to_pylist():
                found = np.frombuffer(value, "<i8").copy()
                if len(found) > len(total):
                    found, total = total, found
                total[: len(found)] += found
        token = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(token), pa.array(total[token])], names=["token", "n"])

    merged = ids.filter("counts IS NOT NULL").select("counts").mapInArrow(merge, "token long, n long")
    counts = merged.groupBy("token").agg(F.sum("n").alias("n")).toPandas()
    return counts["token"].to_numpy(), counts["n"].to_numpy()


def _block_rows(
    rows: list[tuple[list[int | None], list[int], np.ndarray]], table: rans.Table, shard: int, first: int
) -> Iterator[pa.RecordBatch]:
    coded = rans.encode([ids for _, _, ids in rows], table)
    columns = {
        "shard": [shard] * len(rows),
        "block": list(range(first, first + len(rows))),
        "n_tokens": [b.n_tokens for b in coded],
        "doc_ids": [d for d, _, _ in rows],
        "lengths": [n for _, n, _ in rows],
        "lanes": [b.lanes for b in coded],
        "states": [b.states.astype("<u8").tobytes() for b in coded],
        "offsets": [b.offsets.astype("<i8").tobytes() for b in coded],
        "words": [b.words.astype("<u4").tobytes() for b in coded],
        "crc32": [b.crc32 for b in coded],
    }
    types = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()]
    types += [pa.binary(), pa.binary(), pa.binary(), pa.int64()]
    arrays = [pa.array(v, t) for v, t in zip(columns.values(), types, strict=True)]
    yield pa.RecordBatch.from_arrays(arrays, names=list(columns))


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int = 1, shard_tokens: int = SHARD_TOKENS
) -> None:
    """Encode every whole text and write the token file.

    A null text is empty and so has the end id alone; rows with a null ``doc_id`` come first; rows with equal ids are
    ordered by a hash of their token ids, so that any number of them spreads over shards. An empty table gives a file without blocks. Other columns are ignored.
    """
    spark = docs.sparkSession
    work = scratch(spark)
    target = work.path("ids")
    encoded(docs, tokenizer, end_id).write.option("compression", "zstd").parquet(target)
    ids = spark.read.parquet(target)
    tokens, counts = token_counts(ids)
    table = rans.Table.of_counts(tokens, counts)
    row = (table.scale, bytearray(table.symbols.astype("<u4").tobytes()), bytearray(table.freqs.astype("<i8").tobytes()))
    spark.createDataFrame([row], "scale int, symbols binary, freqs binary").coalesce(1).write.parquet(
        storage.join(folder, "table")
    )
    shared = spark.sparkContext.broadcast(table)

    def write(batches):
        shard, block = TaskContext.get().partitionId(), 0
        ready: list[tuple[list[int | None], list[int], np.ndarray]] = []
        names: list[int | None] = []
        parts: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for doc_id, array in zip(column_of(batch, "doc_id").to_pylist(), _arrays(batch), strict=True):
                if size and size + len(array) > 2 * BLOCK_TOKENS:
                    ready.append((names, [len(p) for p in parts], np.concatenate(parts)))
                    names, parts, size = [], [], 0
                names.append(doc_id)
                parts.append(array)
                size += len(array)
                if size >= BLOCK_TOKENS:
                    ready.append((names, [len(p) for p in parts], np.concatenate(parts)))
                    names, parts, size = [], [], 0
                # A block of one very long document is coded by itself, since blocks side by side take the longest's room.
                alone = ready and len(ready[-1][2]) > 2 * BLOCK_TOKENS
                if len(ready) >= SIDE_BY_SIDE or alone:
                    held = [ready[:-1], ready[-1:]] if alone else [ready]
                    for some in filter(None, held):
                        yield from _block_rows(some, shared.value, shard, block)
                        block += len(some)
                    ready = []
        if parts:
            ready.append((names, [len(p) for p in parts], np.concatenate(parts)))
        if ready:
            yield from _block_rows(ready, shared.value, shard, block)

    shards = max(1, -(-int(counts.sum()) // shard_tokens))
    # Rows without ids, or with equal ones, are spread by what they hold, and equal rows by their place.
    order = ["doc_id", F.xxhash64("ids"), F.monotonically_increasing_id()]
    rows = ids.filter("counts IS NULL").select("doc_id", "width", "ids", *[c.alias(f"_{i}") for i, c in enumerate(order[1:])])
    keys = ["doc_id", "_0", "_1"]
    in_order = rows.repartitionByRange(shards, *keys).sortWithinPartitions(*keys).select("doc_id", "width", "ids")
    in_order.mapInArrow(write, BLOCKS).write.parquet(storage.join(folder, "blocks"))
    storage.remove(spark, work.root)


def _frequencies(spark: SparkSession, folder: str) -> rans.Table:
    row = spark.read.parquet(storage.join(folder, "table")).first()
    return rans.Table(
        row["scale"],
        np.frombuffer(row["symbols"], dtype="<u4").astype(np.int64),
        np.frombuffer(row["freqs"], dtype="<i8"),
    )


def read_tokens(spark: SparkSession, folder: str, digest_only: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` and ``ids`` (unsigned 32-bit, little-endian) of each document of a file.

    ``start`` counts the ids of all documents before it. With ``digest_only`` the ids are decoded and checked but not
    handed on.
    """
    shared = spark.sparkContext.broadcast(_frequencies(spark, folder))
    blocks = spark.read.schema(BLOCKS).parquet(storage.join(folder, "blocks"))
    schema = "shard int, block int, before long, doc_id long, n_tokens long, ids_crc32 long"

    def read(batches):
        table = shared.value
        places = table.places()
        for batch in batches:
            for some in pieces([batch], "words"):
                rows = some.to_pylist()
                coded = [
                    rans.Block(
                        r["n_tokens"],
                        r["lanes"],
                        np.frombuffer(r["states"], "<u8").reshape(-1, r["lanes"]),
                        np.frombuffer(r["offsets"], "<i8"),
                        np.frombuffer(r["words"], "<u4"),
                        r["crc32"],
                    )
                    for r in rows
                ]
                out: dict[str, list] = {c.split()[0]: [] for c in schema.split(", ")}
                values = []
                for r, ids in zip(rows, rans.decode(coded, table, places), strict=True):
                    at = 0
                    if sum(r["lengths"]) != r["n_tokens"] or min(r["lengths"], default=0) < 0:
                        raise ValueError("the lengths of a block's documents do not add up to its tokens")
                    raw = ids.tobytes()
                    for doc_id, n in zip(r["doc_ids"], r["lengths"], strict=True):
                        own = raw[4 * at : 4 * (at + n)]
                        row = (r["shard"], r["block"], at, doc_id, n, zlib.crc32(own))
                        for k, v in zip(out, row, strict=True):
                            out[k].append(v)
                        if not digest_only:
                            values.append(own)
                        at += n
                types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
                arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
                names = list(out)
                if not digest_only:
                    arrays.append(pa.array(values, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    decoded = blocks.mapInArrow(read, schema if digest_only else schema + ", ids binary")
    # Tokens before each block: within its shard, and in the shards before it (one row per shard).
    lengths = blocks.select("shard", "block", "n_tokens")
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    over_shards = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = lengths.groupBy("shard").agg(F.sum("n_tokens").alias("_n"))
    shards = shards.select("shard", F.coalesce(F.sum("_n").over(over_shards), F.lit(0)).alias("_shards"))
    begins = lengths.withColumn("_blocks", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0))).join(shards, "shard")
    begins = begins.select("shard", "block", (F.col("_blocks") + F.col("_shards")).alias("_begin"))
    columns = ["doc_id", (F.col("before") + F.col("_begin")).alias("start"), "n_tokens", "ids_crc32"]
    return decoded.join(begins, ["shard", "block"]).select(*columns, *([] if digest_only else ["ids"]))
