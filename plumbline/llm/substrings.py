"""Substring deduplication with a count-min prefilter.

A window is ``width`` consecutive words of one text. Words covered by a window that also starts in a document with a
smaller ``doc_id`` are removed.

1. Sketch. Each window is counted under its anchor, the smallest hash of the ANCHOR-word runs inside it: equal windows
   have equal anchors, and neighbouring windows mostly share theirs, so a text has about twenty times fewer anchors than
   windows. A document counts an anchor once. Every task counts what it reads; the partial counts of the cells are
   merged by sums. A cell that holds several anchors only overestimates, so no repeated window is lost.
2. Cells with a count of two or more are kept. If they fit SKETCH_BYTES as a bitmap, it is broadcast and windows whose
   anchor has such a cell in every row of the sketch are emitted; if they don't, anchors find their cells by joins.
3. Emitted windows are grouped exactly, by the 64 bits of their anchor and 64 bits of hash over all their words.
   Neighbouring windows with one anchor travel as one row. Tasks reduce what they read to the smallest ``doc_id`` of each
   window before anything is shuffled, so a window that a third of all documents share costs one entry per task; the
   windows that start in a larger ``doc_id`` are then found by a join whose rows of one key Spark may split.
4. An anchor of many different windows (a short line between other words each time) is split by the high bits of the
   window hash into keys of about PART_WINDOWS different windows, so that neither a group nor a joined list grows with it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import (
    column_of,
    hashed_words,
    mix64,
    packed,
    pieces,
    scratch,
    sorted_groups,
    texts_of,
    unpacked,
    whole_groups,
    word_hasher,
)

WIDTH = 50
ANCHOR = 8

#: Rows of the sketch, cells per anchor in each of them, and the largest bitmap that is broadcast.
DEPTH = 2
CELLS_PER_ANCHOR = 4
SKETCH_BYTES = 128 << 20
#: Cells of a row that one task packs for the broadcast.
BLOCK_CELLS = 1 << 20
#: Different windows under one key, about; the share of windows by which they are estimated; anchors split at most.
PART_WINDOWS = 512
SHARE = 32
SPLIT_ANCHORS = 1 << 21
#: Partial reductions that a task merges together, about.
GROUP_BYTES = 16 << 20

_SEEDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)
#: Odd multipliers of the rolling sums, with their inverses modulo 2^64.
_BASES = [6364136223846793005, 2862933555777941757]
_INVERSES = [pow(b, -1, 1 << 64) for b in _BASES]
_powers: dict[tuple[int, int], np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of ``base`` modulo 2^64, kept while a worker lives."""
    have = _powers.get((base, 0))
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, np.uint64(base % (1 << 64)))
        have[0] = 1
        have = np.multiply.accumulate(have)
        _powers[base, 0] = have
    return have[:n]


def rolling(hashes: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``width`` consecutive word hashes."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, dtype=np.uint64)
    up, down = _power(_BASES[which], n), _power(_INVERSES[which], n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(hashes + _SEEDS[which]) * up)])
    return mix64((sums[width:] - sums[:-width]) * down[: n - width + 1])


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    span, out = 1, values
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, width: int, anchor: int) -> np.ndarray:
    """The anchor of every window of a text."""
    anchor = min(anchor, width)
    if len(hashes) < width:
        return np.zeros(0, dtype=np.uint64)
    return _smallest(rolling(hashes, anchor), width - anchor + 1)


def cells(keys: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    """The cell of each anchor in a row of the sketch."""
    return (mix64(keys ^ _SEEDS[row]) & np.uint64(n_cells - 1)).astype(np.int64)


def _hashed_texts(piece: pa.RecordBatch, hashes):
    """Word hashes of each text of a piece."""
    hashes.trim()
    for text in texts_of(piece):
        yield hashed_words(text.split(), hashes)


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id`` and text; rows without an id neither remove anything nor lose anything, nor are they counted."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def sketch_cells(docs: DataFrame, width: int, anchor: int, depth: int, n_cells: int) -> DataFrame:
    """``row, cell`` of the merged sketch's cells with a count of two or more.

    Tasks send their own sums per cell; an anchor that one document has many times counts once.
    """

    def partial(batches):
        hashes = word_hasher()
        held: list[np.ndarray] = []
        size = 0

        def emit():
            keys = np.concatenate(held)
            for row in range(depth):
                cell, n = np.unique(cells(keys, row, n_cells), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(cell), row, np.int32)), pa.array(cell), pa.array(n.astype(np.int64))],
                    names=["row", "cell", "n"],
                )

        for piece in pieces(batches):
            for words in _hashed_texts(piece, hashes):
                keys = np.unique(anchors(words, width, anchor))
                if len(keys):
                    held.append(keys)
                    size += len(keys)
            if size > 4_000_000:
                yield from emit()
                held, size = [], 0
        if held:
            yield from emit()

    partial_sums = _keyed(docs).filter("doc_id is not null").mapInArrow(partial, "row int, cell long, n long")
    return partial_sums.groupBy("row", "cell").agg(F.sum("n").alias("n")).filter("n > 1").select("row", "cell")


def _bitmaps(repeated: DataFrame, depth: int, n_cells: int) -> np.ndarray:
    """The cells as packed bits, gathered in blocks of BLOCK_CELLS; the caller has checked their size."""
    bits = np.zeros((depth, max(1, n_cells >> 5)), dtype=np.uint32)
    block_cells = min(BLOCK_CELLS, n_cells)

    def pack(batches):
        for rows in sorted_groups(batches, ["row", "block"]):
            flags = np.zeros(block_cells, dtype=bool)
            flags[rows.column("cell").to_numpy() % block_cells] = True
            packed_bits = np.packbits(flags, bitorder="little").tobytes()
            own = [pa.array([rows.column(k)[0].as_py()], t) for k, t in (("row", pa.int32()), ("block", pa.int64()))]
            yield pa.RecordBatch.from_arrays([*own, pa.array([packed_bits], pa.binary())], names=["row", "block", "bits"])

    block = F.call_function("div", F.col("cell"), F.lit(block_cells)).alias("block")
    dealt = repeated.select("row", block, "cell").repartition("row", "block").sortWithinPartitions("row", "block")
    words = block_cells >> 5
    for batch in dealt.mapInArrow(pack, "row int, block long, bits binary").toArrow().to_batches():
        for row, at, own in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            bits[row, at * words : (at + 1) * words] = np.frombuffer(own, "<u4")
    return bits


_RUNS = "anchor long, doc_id long, at int, hashes binary"


def _bitmap_test(spark, bits: np.ndarray, n_cells: int):
    """Tells of anchors whether every row of the broadcast sketch has a count of two or more."""
    shared = spark.sparkContext.broadcast(bits)

    def repeated(keys: np.ndarray) -> np.ndarray:
        ok = np.ones(len(keys), dtype=bool)
        for row, words in enumerate(shared.value):
            cell = cells(keys, row, n_cells)
            ok &= (words[cell >> 5] >> (cell & 31).astype(np.uint32)) & np.uint32(1) == 1
        return ok

    return repeated


def _runs(docs: DataFrame, width: int, anchor: int, repeated=None) -> DataFrame:
    """``anchor, doc_id, at, hashes``: runs of windows with one anchor, from word ``at`` on; those ``repeated``, if given."""

    def emit(batches):
        hashes = word_hasher()
        for piece in pieces(batches):
            out: list[tuple] = []
            ids = column_of(piece, "doc_id").to_pylist()
            for doc_id, words in zip(ids, _hashed_texts(piece, hashes), strict=True):
                keys = anchors(words, width, anchor)
                if not len(keys):
                    continue
                starts = np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1])
                own = keys[starts]
                lengths = np.diff(np.append(starts, len(keys)))
                ok = np.ones(len(own), dtype=bool) if repeated is None else repeated(own)
                if ok.any():
                    windows = rolling(words, width)[np.repeat(ok, lengths)]
                    out.append((own[ok], np.full(int(ok.sum()), doc_id), starts[ok], lengths[ok], windows))
            if out:
                own, doc, at, lengths, windows = (np.concatenate(x) for x in zip(*out, strict=True))
                arrays = [pa.array(own.view(np.int64)), pa.array(doc.astype(np.int64)), pa.array(at.astype(np.int32))]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, packed(windows, lengths)], names=["anchor", "doc_id", "at", "hashes"]
                )

    return _keyed(docs).filter("doc_id is not null").mapInArrow(emit, _RUNS)


def _runs_by_join(docs: DataFrame, repeated: DataFrame, width: int, anchor: int, depth: int, n_cells: int) -> DataFrame:
    """The same rows when the sketch is too large to be sent everywhere: each run finds its cells by a join."""

    def find(batches):
        for batch in batches:
            keys = np.asarray(column_of(batch, "anchor")).view(np.uint64)
            found = [pa.array(cells(keys, row, n_cells)) for row in range(depth)]
            names = [*batch.schema.names, *[f"c{row}" for row in range(depth)]]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=names)

    schema = _RUNS + "".join(f", c{row} long" for row in range(depth))
    rows = _runs(docs, width, anchor).mapInArrow(find, schema)
    for row in range(depth):
        hot = repeated.filter(F.col("row") == row).select(F.col("cell").alias(f"c{row}"))
        rows = rows.join(hot, f"c{row}", "left_semi")
    return rows.select("anchor", "doc_id", "at", "hashes")


def _split_anchors(runs: DataFrame, work, part_windows: int) -> tuple[np.ndarray, np.ndarray] | None:
    """The anchors of more than ``part_windows`` different windows, sorted, and the bits by which each is split.

    Different windows are counted exactly among those with one in SHARE of the hashes. If more than SPLIT_ANCHORS would be
    split, those with the fewest bits stay whole.
    """

    def sample(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            windows, lengths = unpacked(column_of(batch, "hashes"), "<u8")
            ok = windows % np.uint64(SHARE) == 0
            own = np.repeat(np.asarray(column_of(batch, "anchor")), lengths)[ok]
            arrays = [pa.array(own), pa.array(windows[ok].view(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "window"])

    sampled = runs.select("anchor", "hashes").mapInArrow(sample, "anchor long, window long").distinct()
    many = sampled.groupBy("anchor").agg((F.count("*") * SHARE).alias("n")).filter(F.col("n") > part_windows)
    many = work.stage(many.select("anchor", F.ceil(F.log2(F.col("n") / part_windows)).cast("int").alias("bits")), "many")
    least, total = 1, 0
    for bits, n in sorted(((r["bits"], r["count"]) for r in many.groupBy("bits").count().collect()), reverse=True):
        total += n
        if total > SPLIT_ANCHORS:
            least = bits + 1
            break
    table = many.filter(F.col("bits") >= least).toArrow()
    if not table.num_rows:
        return None
    keys, bits = table.column("anchor").to_numpy().view(np.uint64), table.column("bits").to_numpy().astype(np.uint64)
    order = np.argsort(keys)
    return keys[order], bits[order]


def _spread(runs: DataFrame, split: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """The runs with ``steps``; those of an anchor that is split under a key for each part, which takes its place.

    ``steps`` are the windows' distances from ``at``, empty if they are consecutive. A key is the anchor and the part
    mixed, so key and hash still tell windows apart by 128 bits.
    """
    if split is None:
        return runs.withColumn("steps", F.lit(b""))
    shared = runs.sparkSession.sparkContext.broadcast(split)

    def emit(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            known, known_bits = shared.value
            windows, lengths = unpacked(column_of(batch, "hashes"), "<u8")
            anchor = np.asarray(column_of(batch, "anchor")).view(np.uint64)
            place = np.minimum(np.searchsorted(known, anchor), len(known) - 1)
            bits = np.repeat(np.where(known[place] == anchor, known_bits[place], np.uint64(0)), lengths)
            # A shift by 64 is undefined, so bits of 0 are shifted in two steps.
            part = (windows >> np.uint64(1)) >> (np.uint64(63) - bits)
            key = np.repeat(anchor, lengths) ^ mix64(part)
            run = np.repeat(np.arange(len(lengths)), lengths)
            step = np.arange(len(windows)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            order = np.lexsort((step, part, run))
            windows, key, run, step = windows[order], key[order], run[order], step[order]
            new = np.ones(len(order), dtype=bool)
            new[1:] = (run[1:] != run[:-1]) | (key[1:] != key[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(np.append(starts, len(order)))
            first = step[starts]
            gaps = step[starts + sizes - 1] - first != sizes - 1
            kept = (step - np.repeat(first, sizes))[np.repeat(gaps, sizes)].astype(np.int32)
            doc, at = (np.asarray(column_of(batch, c))[run[starts]] for c in ("doc_id", "at"))
            arrays = [pa.array(key[starts].view(np.int64)), pa.array(doc), pa.array((at + first).astype(np.int32))]
            arrays += [packed(windows, sizes), packed(kept, np.where(gaps, sizes, 0))]
            yield pa.RecordBatch.from_arrays(arrays, names=["anchor", "doc_id", "at", "hashes", "steps"])

    return runs.select("anchor", "doc_id", "at", "hashes").mapInArrow(emit, _RUNS + ", steps binary")


def _reduced(anchor: np.ndarray, window: np.ndarray, first: np.ndarray, twice: np.ndarray):
    """One entry for each window: its smallest document, and whether more than one has it; sorted by anchor and window."""
    order = np.lexsort((first, window, anchor))
    anchor, window, first, twice = anchor[order], window[order], first[order], twice[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (window[1:] != window[:-1])
    at = np.flatnonzero(new)
    more = np.zeros(len(order), dtype=bool)
    more[1:] = ~new[1:] & (first[1:] != first[:-1])
    return anchor[at], window[at], first[at], np.logical_or.reduceat(twice | more, at)


def _as_rows(anchor: np.ndarray, window: np.ndarray, first: np.ndarray, twice: np.ndarray | None) -> pa.RecordBatch:
    """A row for each anchor."""
    starts = np.concatenate([[0], np.flatnonzero(anchor[1:] != anchor[:-1]) + 1])
    lengths = np.diff(np.append(starts, len(anchor)))
    arrays = [pa.array(anchor[starts].view(np.int64)), packed(window, lengths), packed(first, lengths)]
    names = ["anchor", "windows", "firsts"]
    if twice is not None:
        arrays.append(packed(twice.astype(np.uint8), lengths))
        names.append("twice")
    return pa.RecordBatch.from_arrays(arrays, names=names)


def first_documents(runs: DataFrame) -> DataFrame:
    """``anchor, windows, firsts``: of each anchor, the windows that start in two documents or more, sorted, with the
    smallest of these documents."""

    def reduce_task(batches):
        held: list[tuple] = []
        size = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            windows, lengths = unpacked(column_of(batch, "hashes"), "<u8")
            own = np.repeat(np.asarray(column_of(batch, "anchor")).view(np.uint64), lengths)
            doc = np.repeat(np.asarray(column_of(batch, "doc_id")), lengths)
            held.append((own, windows, doc, np.zeros(len(own), dtype=bool)))
            size += len(own)
            if size > 1_500_000:
                yield _as_rows(*_reduced(*(np.concatenate(x) for x in zip(*held, strict=True))))
                held, size = [], 0
        if held:
            yield _as_rows(*_reduced(*(np.concatenate(x) for x in zip(*held, strict=True))))

    def merge(batches):
        for rows in whole_groups(batches, "anchor", size_bytes=GROUP_BYTES):
            windows, lengths = unpacked(rows.column("windows"), "<u8")
            firsts, _ = unpacked(rows.column("firsts"), "<i8")
            twice, _ = unpacked(rows.column("twice"), "u1")
            own = np.repeat(rows.column("anchor").to_numpy().view(np.uint64), lengths)
            own, windows, firsts, twice = _reduced(own, windows, firsts, twice.astype(bool))
            if twice.any():
                yield _as_rows(own[twice], windows[twice], firsts[twice], None)

    partial = runs.mapInArrow(reduce_task, "anchor long, windows binary, firsts binary, twice binary")
    dealt = partial.repartition("anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(merge, "anchor long, windows binary, firsts binary")


def repeated_spans(
    docs: DataFrame,
    work,
    width: int = WIDTH,
    anchor: int = ANCHOR,
    depth: int = DEPTH,
    sketch_bytes: int = SKETCH_BYTES,
    part_windows: int = PART_WINDOWS,
) -> DataFrame:
    """``doc_id, a, b``: spans of words under windows that also start in a document with a smaller id."""
    # One anchor in about (width - anchor + 2) / 2 windows, and a word has about six bytes.
    text_bytes = docs.agg(F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()[0]
    expected = max(1024, text_bytes // 6 * 2 // (width - min(anchor, width) + 2))
    n_cells = 1 << (expected * CELLS_PER_ANCHOR - 1).bit_length()
    repeated = sketch_cells(docs, width, anchor, depth, n_cells)
    if depth * n_cells // 8 <= sketch_bytes:
        runs = _runs(docs, width, anchor, _bitmap_test(docs.sparkSession, _bitmaps(repeated, depth, n_cells), n_cells))
    else:
        runs = _runs_by_join(docs, work.stage(repeated, "cells"), width, anchor, depth, n_cells)
    runs = work.stage(runs, "runs")
    runs = _spread(runs, _split_anchors(runs, work, part_windows))

    def spans(batches):
        for batch in batches:
            rows = (column_of(batch, c).to_pylist() for c in ("doc_id", "at", "hashes", "steps", "windows", "firsts"))
            doc, start, end = [], [], []
            for doc_id, at, hashes, steps, windows, firsts in zip(*rows, strict=True):
                own, known = np.frombuffer(hashes, "<u8"), np.frombuffer(windows, "<u8")
                place = np.minimum(np.searchsorted(known, own), len(known) - 1)
                hit = (known[place] == own) & (np.frombuffer(firsts, "<i8")[place] < doc_id)
                if steps:
                    for a in (np.frombuffer(steps, "<i4")[hit] + at).tolist():
                        doc.append(doc_id)
                        start.append(a)
                        end.append(a + width)
                    continue
                edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
                for a, b in zip((edges[::2] + at).tolist(), (edges[1::2] + at + width - 1).tolist(), strict=True):
                    doc.append(doc_id)
                    start.append(a)
                    end.append(b)
            arrays = [pa.array(doc, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "a", "b"])

    joined = runs.join(work.stage(first_documents(runs), "firsts"), "anchor")
    return joined.mapInArrow(spans, "doc_id long, a int, b int")


def merged_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching spans as one."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def without_repeats(
    docs: DataFrame,
    width: int = WIDTH,
    anchor: int = ANCHOR,
    depth: int = DEPTH,
    sketch_bytes: int = SKETCH_BYTES,
    digest_only: bool = False,
) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and ``kept_text`` (kept words joined by a blank) of every row.

    A null text has no words. A null ``doc_id`` is neither smaller nor larger than any: such a row keeps all its words
    and removes none. Rows that share an id are each judged against smaller ids only; windows found in any of them are
    held against all of them by position, so they should not differ. Texts shorter than a window stay as they are.
    """
    work = scratch(docs.sparkSession)
    spans = repeated_spans(docs, work, width, anchor, depth, sketch_bytes)
    # A document's spans are at most as many as its words.
    marks = work.stage(spans.groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("_spans")), "marks")
    work.drop("runs", "firsts", "cells", "many")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"

    def remove(batches):
        for piece in pieces(batches):
            out: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "kept_text": []}
            for text, spans in zip(texts_of(piece), column_of(piece, "_spans").to_pylist(), strict=True):
                words = text.split()
                kept, last = words, 0
                if spans:
                    kept = []
                    for a, b in merged_spans([(x["a"], x["b"]) for x in spans]):
                        kept += words[last:a]
                        last = b
                    kept += words[last:]
                joined = b" ".join(kept)
                values = (len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode())
                for k, v in zip(out, values, strict=True):
                    out[k].append(v)
            arrays = [column_of(piece, "doc_id"), *map(pa.array, (out["n_words"], out["n_removed"]))]
            arrays += [pa.array(out["kept_sha256"], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if not digest_only:
                arrays.append(pa.array(out["kept_text"], pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    joined = _keyed(docs).join(marks, "doc_id", "left")
    return joined.mapInArrow(remove, schema if digest_only else schema + ", kept_text string")
