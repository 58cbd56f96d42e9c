"""Helpers the operators share: scratch tables, word splitting, Arrow batches, groups of sorted rows.

Rules that hold for every operator of this subpackage: the input frame needs the columns an operator names
(``doc_id``, ``text``, ...) and may have any others; a null text is an empty text; rows are never dropped
because of a null key; helper columns start with an underscore and two of them never meet a caller's names
because callers' frames are projected to the needed columns first.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from plumbline.sources.workspace import Workspace

#: Rows are handed on in pieces of at most so many bytes of text, whatever size Spark's batches have.
PIECE_BYTES = 2_000_000

#: ASCII white space, as bytes.split() has it: the words of the text operators.
SPACE_CLASS = "\\x20\\x09-\\x0D"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def scratch(spark: SparkSession) -> Workspace:
    """Tables under the shared folder of the session; a result that reads them needs them after the call."""
    return Workspace(spark)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_and(docs: DataFrame, *needed: Column | str, without: tuple[str, ...] = ()) -> DataFrame:
    """The columns of ``docs`` packed as ``_row`` beside the columns an operator needs, so that no names can clash."""
    packed_columns = [F.col(f"`{c}`") for c in docs.columns if c not in without]
    return docs.select(F.struct(*packed_columns).alias("_row"), *needed)


def stratum_key(*columns: str) -> Column:
    """One string for a combination of values in which null differs from every value."""
    return F.to_json(F.struct(*[F.col(c).cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))


def give_back() -> None:
    """Workers serve many tasks: what Arrow and the allocator no longer use goes back to the system when one ends."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def pieces(
    batches: Iterable[pa.RecordBatch], column: str = "text", size_limit: int = PIECE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut so that the texts of each piece stay within ``size_limit``; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = np.asarray(pc.fill_null(pc.binary_length(texts), 0)).astype(np.int64)
        if sizes.sum() <= size_limit:
            yield batch
            continue
        total, start = 0, 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > size_limit:
                yield batch.slice(start, i - start)
                total, start = 0, i
            total += size
        yield batch.slice(start)
    give_back()


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text; null becomes empty."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b"" if v is None else v for v in values.to_pylist()]


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys of a partition sorted by them; only one run is held at a time.

    A null key equals a null key. Callers bound the size of a run before they deal the rows out.
    """
    held: list[pa.RecordBatch] = []
    last = None

    def value(batch, row):
        return tuple(column_of(batch, k)[row].as_py() for k in keys)

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        change = np.zeros(n, dtype=bool)
        for k in keys:
            column = column_of(batch, k)
            if n > 1:
                same = pc.equal(column.slice(1), column.slice(0, n - 1))
                both = pc.and_(column.slice(1).is_null(), column.slice(0, n - 1).is_null())
                change[1:] |= ~np.asarray(pc.if_else(both, True, pc.fill_null(same, False)))
        cuts = [0, *np.flatnonzero(change).tolist(), n]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if a == b:
                continue
            key = value(batch, a)
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _sliced(batches: Iterable[pa.RecordBatch], size_bytes: int) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``size_bytes``."""
    for batch in batches:
        rows = max(1, batch.num_rows * size_bytes // max(1, batch.nbytes))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def whole_groups(
    batches: Iterable[pa.RecordBatch], key: str, rows: int = 20_000, size_bytes: int | None = None
) -> Iterator[pa.Table]:
    """Tables of about ``rows`` rows or ``size_bytes`` of a partition sorted by ``key`` (an integer), or more, none of which
    cuts a group."""
    held: list[pa.RecordBatch] = []
    size = 0
    if size_bytes is not None:
        batches = _sliced(batches, size_bytes)
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size < rows and (size_bytes is None or sum(x.nbytes for x in held) < size_bytes):
            continue
        table = pa.Table.from_batches(held)
        values = table.column(key).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if cut:
            yield table.slice(0, cut)
            held = table.slice(cut).combine_chunks().to_batches()
            size -= cut
    if held:
        yield pa.Table.from_batches(held)


def ranked(df: DataFrame, key: str, order: list[str], work) -> DataFrame:
    """``df`` with ``_k``, the row's place from 0 on among the rows of its ``key`` in ``order`` (nulls first, null keys equal).

    Rows are range-partitioned by key and order, so that a key with most of the rows spreads over tasks like any other.
    Each task numbers the runs it holds; what the run at its beginning has in earlier tasks is added from a table
    of one row per task.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("_part", T.IntegerType()), T.StructField("_k", T.LongType())])

    def number(batches):
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            column = column_of(batch, key)
            null = np.asarray(column.is_null())
            ids = pc.fill_null(column, 0).to_numpy(zero_copy_only=False)
            starts = np.zeros(n, dtype=np.int64)
            change = np.flatnonzero((ids[1:] != ids[:-1]) | (null[1:] != null[:-1])) + 1
            starts[change] = change
            places = np.arange(n) - np.maximum.accumulate(starts)
            if (ids[0], null[0]) == last:
                places[: change[0] if len(change) else n] += seen
            last, seen = (ids[-1], null[-1]), int(places[-1]) + 1
            arrays = [*batch.columns, pa.array(np.full(n, part, np.int32)), pa.array(places)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    in_order = df.repartitionByRange(key, *order).sortWithinPartitions(key, *order)
    rows = work.stage(in_order.mapInArrow(number, schema), "ranked")
    named = [F.col(key).isNotNull().alias("has"), F.col(key).alias("id")]
    edges = rows.groupBy("_part").agg(
        F.min(F.struct(*named)).alias("first"), F.max(F.struct(*named, F.col("_k").alias("k"))).alias("last")
    )
    before, last, seen = [], None, 0
    for r in sorted(edges.collect(), key=lambda r: r["_part"]):
        first, end = tuple(r["first"]), (r["last"]["has"], r["last"]["id"])
        more = seen if first == last else 0
        if more:
            before.append((r["_part"], *first, more))
        seen = r["last"]["k"] + 1 + (more if first == end else 0)
        last = end
    if not before:
        return rows.drop("_part")
    table = df.sparkSession.createDataFrame(before, "_part int, _has boolean, _id long, _more long")
    own = (F.col(key).isNotNull() == F.col("_has")) & F.col(key).eqNullSafe(F.col("_id"))
    place = F.col("_k") + F.when(own, F.col("_more")).otherwise(0)
    # One row per task at most.
    return rows.join(F.broadcast(table), "_part", "left").withColumn("_k", place).select(*df.columns, "_k")


def packed(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Binary values: the bytes of ``data`` cut into pieces of ``lengths`` items."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * data.itemsize
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(pa.binary(), len(lengths), buffers)


def unpacked(column: pa.Array | pa.ChunkedArray, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """What ``packed`` has packed: all items, and the number of each piece."""
    values = column.to_pylist()
    lengths = np.fromiter(map(len, values), np.int64, len(values)) // np.dtype(dtype).itemsize
    return np.frombuffer(b"".join(values), dtype), lengths


def mix64(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Remembered(dict):
    """A map filled by a function, in two generations so that its size stays bounded and frequent keys stay."""

    def __init__(self, function, limit: int = 400_000):
        super().__init__()
        self.function, self.limit, self.older = function, limit, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.function(key)
        self[key] = value
        return value

    def trim(self) -> None:
        """Called between pieces: the younger generation becomes the older one when it is full."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


def word_hasher(limit: int = 400_000) -> Remembered:
    """64-bit hashes of words given as bytes."""
    import xxhash

    return Remembered(xxhash.xxh3_64_intdigest, limit)


def hashed_words(words: list[bytes], hashes: Remembered) -> np.ndarray:
    return np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
