"""Language-model scores of documents from a log-frequency Bloom filter of word and word-pair counts.

Every document outside a held-out tenth is counted: tasks sum the hashes of words and word pairs they read, cut the sums
into slices of the hash, and each slice is merged and built into its part of the filter, with the exact word counts that
the base score needs. The number of slices grows with the corpus, the size of one does not.

Slices are broadcast as far as BROADCAST_BYTES allow. If the model is larger, documents pass it in rounds: each round
broadcasts some slices and fills in what the words and pairs of these slices have, in tables written in between; the last
step computes the scores. For the same slices the scores are the same, whatever the rounds.

p(w | v) = a q(v w) / c(v) + (1 - a) (c(w) + 0.1) / (N + 0.1 (V + 1)) with a = c(v) / (c(v) + CONTEXT). q is the quantised
count of the pair, read by repeated membership probes, and at most the count of either word; c are the counts of words,
which the base score needs exactly. Pairs of a context add up to its count, so p(. | v) is a distribution as far as the
levels' middles are right and no probe hits by chance. At the start of a text v is the end token.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm import logbloom
from plumbline.llm.common import (
    column_of,
    hashed_words,
    mix64,
    pieces,
    scratch,
    sorted_groups,
    texts_of,
    word_hasher,
)

HELD_OUT_OF = 10
SMOOTHING = 0.1
#: Pseudo-count of a context, against its quantised count.
CONTEXT = 5.0
#: Words and pairs that a task sums at a time, and tokens for each slice.
CHUNK = 1_500_000
TOKENS_PER_SLICE = 3_000_000
BROADCAST_BYTES = 256 << 20
#: Text that a task looks up at a time, and hashes of words that it remembers.
PIECE = 3_000_000
REMEMBERED = 150_000

LARGE = 255
_END = np.uint64(0x5851F42D4C957F2D)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def held_out() -> object:
    """A tenth of the documents by the checksum of the id; a row without an id counts as id ''."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % HELD_OUT_OF == 0


def token_hashes(texts: list[bytes], hashes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, an end token after each text; and the number of tokens of each."""
    hashes.trim()
    arrays, sizes = [], []
    end = np.array([_END])
    for text in texts:
        words = text.translate(_LOWER).split()
        arrays += [hashed_words(words, hashes), end]
        sizes.append(len(words) + 1)
    return np.concatenate(arrays), np.asarray(sizes, dtype=np.int64)


def pair_hashes(tokens: np.ndarray) -> np.ndarray:
    """A hash of each token and the one before it; a text's first token follows the end token of the text before."""
    before = np.concatenate([np.array([_END]), tokens[:-1]])
    return mix64(before * _PAIR + tokens)


def _word_grams(tokens: np.ndarray) -> np.ndarray:
    return mix64(tokens ^ _PAIR)


def model_slices(docs: DataFrame, work, n_slices: int, bits_per_entry: int = logbloom.BITS_PER_ENTRY) -> DataFrame:
    """``slice, n_tokens, n_words, filter, words, counts, large``: one row per slice of the counted documents.

    ``counts`` has a byte per word; a word with LARGE there has its count in ``large``.
    """

    def count(batches):
        hashes = word_hasher(REMEMBERED)
        held: list[np.ndarray] = []
        size = 0

        def emit():
            tokens = np.concatenate(held)
            for order, grams in ((1, _word_grams(tokens)), (2, np.concatenate([pair_hashes(t) for t in held]))):
                keys, n = np.unique(grams, return_counts=True)
                cuts = np.searchsorted(logbloom.slice_of(keys, n_slices), np.arange(n_slices + 1))
                rows = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
                n = n.astype("<u4")
                for at in range(0, len(rows), 64):
                    some = rows[at : at + 64]
                    arrays = [
                        pa.array([k for k, _, _ in some], pa.int32()),
                        pa.array([order] * len(some), pa.int32()),
                        pa.array([keys[a:b].tobytes() for _, a, b in some], pa.binary()),
                        pa.array([n[a:b].tobytes() for _, a, b in some], pa.binary()),
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=["slice", "order", "keys", "n"])

        for piece in pieces(batches, size_limit=PIECE):
            tokens, _ = token_hashes(texts_of(piece), hashes)
            held.append(tokens)
            size += len(tokens)
            if size >= CHUNK:
                yield from emit()
                held, size = [], 0
        if held:
            yield from emit()

    def build(batches):
        for rows in sorted_groups(batches, ["slice"]):
            sums: dict[int, tuple[np.ndarray, np.ndarray]] = {}
            orders = rows.column("order").to_pylist()
            for order in (1, 2):
                keys = [k for k, o in zip(rows.column("keys").to_pylist(), orders, strict=True) if o == order]
                counts = [k for k, o in zip(rows.column("n").to_pylist(), orders, strict=True) if o == order]
                all_keys = np.frombuffer(b"".join(keys), "<u8")
                all_counts = np.frombuffer(b"".join(counts), "<u4").astype(np.int64)
                unique, inverse = np.unique(all_keys, return_inverse=True)
                sums[order] = unique, np.bincount(inverse, weights=all_counts, minlength=len(unique)).astype(np.int64)
            packed = logbloom.build(*sums[2], bits_per_entry)
            values = (
                rows.column("slice")[0].as_py(),
                int(sums[1][1].sum()),
                len(sums[1][0]),
                packed.tobytes(),
                sums[1][0].astype("<u8").tobytes(),
                np.minimum(sums[1][1], LARGE).astype(np.uint8).tobytes(),
                sums[1][1][sums[1][1] >= LARGE].astype("<i8").tobytes(),
            )
            types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.binary()]
            names = ["slice", "n_tokens", "n_words", "filter", "words", "counts", "large"]
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=names)

    counted = docs.filter(~held_out()).select(F.col("text").cast("string").alias("text"))
    sums = counted.mapInArrow(count, "slice int, order int, keys binary, n binary")
    dealt = sums.repartition(n_slices, "slice").sortWithinPartitions("slice", "order")
    schema = "slice int, n_tokens long, n_words long, filter binary, words binary, counts binary, large binary"
    return work.stage(dealt.mapInArrow(build, schema), "model")


class Part:
    """Some slices of the model: the filter, and exact word counts by word hash."""

    def __init__(self, rows, sizes: list, n_slices: int):
        """``rows`` are read one after the other, in any order; ``sizes`` has how many words each holds, by slice."""
        ends = np.cumsum([r["n_words"] for r in sizes], dtype=np.int64)
        ends_of = {r["slice"]: int(end) for r, end in zip(sizes, ends, strict=True)}
        words = int(ends[-1]) if len(ends) else 0
        self.words, self.counts = np.zeros(words, np.uint64), np.zeros(words, np.uint8)
        packed: dict[int, np.ndarray] = {}
        large: dict[int, np.ndarray] = {}
        for r in rows:
            # Slices are ranges of the hash and sorted inside, so all words are sorted.
            own = slice(ends_of[r["slice"]] - r["n_words"], ends_of[r["slice"]])
            self.words[own] = np.frombuffer(r["words"], "<u8")
            self.counts[own] = np.frombuffer(r["counts"], np.uint8)
            packed[r["slice"]] = np.frombuffer(r["filter"], np.uint8)
            large[r["slice"]] = np.frombuffer(r["large"], "<i8")
        self.filter = logbloom.Filter(n_slices, packed)
        self.large = np.concatenate([np.zeros(0, np.int64), *(large[k] for k in sorted(large))])
        self.large_at = np.flatnonzero(self.counts == LARGE)

    def exact(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(grams), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, grams), len(self.words) - 1)
        out = np.where(self.words[at] == grams, self.counts[at], 0).astype(np.int64)
        many = np.flatnonzero(out == LARGE)
        out[many] = self.large[np.searchsorted(self.large_at, at[many])]
        return out

    def look_up(self, tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts of all tokens and levels of their pairs; 0 for what other slices have."""
        distinct, inverse = np.unique(_word_grams(tokens), return_inverse=True)
        return self.exact(distinct)[inverse], self.filter.levels(pair_hashes(tokens))


def _scores(
    tokens: np.ndarray, sizes: np.ndarray, found: tuple[np.ndarray, np.ndarray], n: int, v: int, end_count: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Known tokens, base score and model score of each text."""
    counts, pairs = found
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    below = n + SMOOTHING * (v + 1)
    share = (counts + SMOOTHING) / below
    before = np.concatenate([[0], counts[:-1]]).astype(np.float64)
    before[first] = end_count
    seen = np.minimum(logbloom.count_of(pairs), np.minimum(before, counts))
    trust = before / (before + CONTEXT)
    ratio = np.divide(seen, before, out=np.zeros_like(before), where=before > 0)
    model = np.log10(trust * ratio + (1 - trust) * share)
    add = np.add.reduceat
    return add((counts > 0).astype(np.int64), first), add(np.log10(share), first), add(model, first)


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
_FOUND = "_exact binary, _pairs binary"


def scored(
    docs: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    tokens_per_slice: int = TOKENS_PER_SLICE,
    bits_per_entry: int = logbloom.BITS_PER_ENTRY,
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    A null text is empty: its one token is the end token. A row without an id is held out or counted like id ''. Equal
    rows are counted and scored each. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    work = scratch(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n_slices = max(1, -(-(size // 6) // tokens_per_slice))
    model = model_slices(rows, work, n_slices, bits_per_entry)
    bytes_of = sum((F.octet_length(c) for c in ("filter", "words", "counts", "large")), F.lit(0))
    sizes = model.select("slice", "n_tokens", "n_words", bytes_of.alias("size")).collect()  # a few numbers per slice
    sizes.sort(key=lambda r: r["slice"])
    n, v = sum(r["n_tokens"] for r in sizes), sum(r["n_words"] for r in sizes)
    rounds: list[list[int]] = [[]]
    held = 0
    for r in sizes:
        if rounds[-1] and held + r["size"] > broadcast_bytes:
            rounds.append([])
            held = 0
        rounds[-1].append(r["slice"])
        held += r["size"]

    def part(slices: list[int]) -> Part:
        if not slices:
            return Part([], [], n_slices)
        rows = model.filter(F.col("slice").between(slices[0], slices[-1]))
        return Part(rows.toLocalIterator(), [r for r in sizes if slices[0] <= r["slice"] <= slices[-1]], n_slices)

    end = _word_grams(np.array([_END]))

    def fill(shared, last: bool, first: bool, end_count: int):
        def run(batches):
            hashes = word_hasher(REMEMBERED)
            here = shared.value
            for piece in pieces(batches, size_limit=PIECE):
                tokens, sizes = token_hashes(texts_of(piece), hashes)
                found = here.look_up(tokens)
                if not first:
                    kinds = zip(("_exact", "_pairs"), ("<i8", np.uint8), found, strict=True)
                    found = tuple(
                        np.maximum(np.frombuffer(b"".join(column_of(piece, c).to_pylist()), t), x) for c, t, x in kinds
                    )
                if last:
                    known, base, score = _scores(tokens, sizes, found, n, v, end_count)
                    more = [pa.array(sizes), pa.array(known), pa.array(np.full(len(sizes), n, np.int64)), pa.array(base)]
                    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
                    more.append(pa.array(score))
                    kept = ["doc_id", "held_out"]
                else:
                    cuts = np.cumsum(sizes)[:-1]
                    more = [pa.array([x.tobytes() for x in np.split(f, cuts)], pa.binary()) for f in found]
                    names, kept = ["_exact", "_pairs"], ["doc_id", "held_out", "text"]
                yield pa.RecordBatch.from_arrays([*(column_of(piece, k) for k in kept), *more], names=[*kept, *names])

        return run

    table = rows.select("doc_id", held_out().alias("held_out"), "text")
    end_count = 0
    for i, slices in enumerate(rounds):
        own = part(slices)
        end_count = max(end_count, int(own.exact(end)[0]))
        shared = spark.sparkContext.broadcast(own)
        del own
        last = i == len(rounds) - 1
        run = fill(shared, last, i == 0, end_count)
        if last:
            return table.mapInArrow(run, _RESULT)
        table = work.stage(table.mapInArrow(run, f"doc_id long, held_out boolean, text string, {_FOUND}"), "found")
    return table
