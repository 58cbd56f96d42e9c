"""N-gram Jaccard join by chosen paths.

Texts become sets of word shingles; equal sets are one node. Nodes carry a signature of COORDINATES min-hashes, in which
two nodes agree at a coordinate with the probability of their similarity. One run samples coordinates and splits the nodes
by their values there, and again by freshly sampled coordinates; then every bucket that is still large is split further:
a pair at the threshold is expected in one bucket on every level. Small buckets are compared by brute force. Runs are repeated until
the recall at the threshold reaches the target.

What buckets yield is connections of likely pairs. The nodes of a connected family meet once more with their whole sets,
in blocks of bounded size, and every pair of a family is decided exactly. Only each node's number of links, and edges that
span its part of a block, leave a block: never the pairs.

Recall: with threshold L, paths survive ``d`` levels with probability q(d) = 1 - exp(-q(d - 1)), q(0) = 1; ``runs`` is the
smallest R with 1 - (1 - q(MAX_DEPTH))^R at or above the target. Pairs above the threshold, pairs in small buckets and
pairs of one family are found more often than that.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import column_of, hashed_words, mix64, pieces, scratch, sorted_groups, texts_of, word_hasher
from plumbline.llm.components import connected_components
from plumbline.llm.decontamination import folded_words
from plumbline.llm.substrings import rolling

SHINGLE = 5
THRESHOLD = 0.8
COORDINATES = 128
TARGET_RECALL = 0.999
MAX_DEPTH = 4
#: Buckets of at most so many nodes are compared; larger ones are split, and at the last level compared in blocks.
SMALL = 256
BLOCK = 1024
#: A bucket with this share of the nodes of the bucket above it is not split further.
KEPT = 0.75
#: Members of a block of a family, of which two meet.
FAMILY_BLOCK = 256
#: A pair is likely if its signatures agree within so many standard deviations of the threshold.
DEVIATIONS = 4.0

_random = np.random.default_rng(977)
_XOR = _random.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32)
_ODD = _random.integers(0, 1 << 32, COORDINATES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_EDGE = "a long, b long"


def runs_for(recall: float, depth: int = MAX_DEPTH) -> int:
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def shingle_set(words: list[bytes], hashes) -> np.ndarray:
    """Sorted 64-bit hashes of the word shingles; the words of a shorter text are one shingle, no words are none."""
    if not words:
        return np.zeros(0, np.uint64)
    coded = hashed_words(words, hashes)
    return np.unique(rolling(coded, min(SHINGLE, len(words))))


def node_of(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    value = xxhash.xxh3_64_intdigest(shingles.tobytes())
    return value - (1 << 64) if value >= 1 << 63 else value


def signature(shingles: np.ndarray) -> np.ndarray:
    best = np.full(COORDINATES, 0xFFFFFFFF, dtype=np.uint32)
    folded = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(folded), 8192):
        part = folded[at : at + 8192]
        np.minimum(best, ((part[None, :] ^ _XOR[:, None]) * _ODD[:, None]).min(axis=1), out=best)
    return best


def _signed(docs: DataFrame) -> DataFrame:
    """``doc_id, node, signature`` of each text that has words."""

    def sign(batches):
        hashes = word_hasher()
        for piece in pieces(batches):
            hashes.trim()
            rows = []
            for doc_id, text in zip(column_of(piece, "doc_id").to_pylist(), texts_of(piece), strict=True):
                shingles = shingle_set(folded_words(text), hashes)
                if len(shingles):
                    rows.append((doc_id, node_of(shingles), signature(shingles).tobytes()))
            if rows:
                doc, node, sig = zip(*rows, strict=True)
                arrays = [pa.array(doc, pa.int64()), pa.array(node, pa.int64()), pa.array(sig, pa.binary())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "node", "signature"])

    return docs.mapInArrow(sign, "doc_id long, node long, signature binary")


def _chosen(buckets: np.ndarray, share: float) -> np.ndarray:
    """Which coordinates each bucket samples."""
    drawn = mix64(buckets[:, None] + np.arange(1, COORDINATES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (drawn >> np.uint64(11)).astype(np.float64) < share * float(1 << 53)


def _split(buckets: np.ndarray, row: np.ndarray, values: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The buckets one level below, and the row of ``values`` that is in each."""
    at, coordinate = np.nonzero(_chosen(buckets, share))
    below = mix64(buckets[at] + coordinate.astype(np.uint64))
    return mix64(below ^ values[row[at], coordinate]), row[at]


def _children(rows: DataFrame, threshold: float, roots: int = 0) -> DataFrame:
    """``bucket, node, above`` one level below, ``above`` being the size of the bucket it came from; with ``roots`` the
    rows have no bucket and enter so many runs.

    A run begins with two levels at once: after one, texts that merely share a passage still meet in large buckets.
    """
    share = 1 / (threshold * COORDINATES)

    def split(batches):
        first = mix64(np.arange(1, roots + 1, dtype=np.uint64))
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                nodes = np.asarray(column_of(batch, "node"))
                values = np.frombuffer(b"".join(column_of(batch, "signature").to_pylist()), np.uint32)
                values = values.reshape(-1, COORDINATES).astype(np.uint64)
                row = np.arange(len(nodes))
                if roots:
                    buckets, row = _split(np.tile(first, len(nodes)), np.repeat(row, roots), values, share)
                    sizes = np.full(len(nodes), np.iinfo(np.int64).max)
                else:
                    buckets = np.asarray(column_of(batch, "bucket")).view(np.uint64)
                    sizes = np.asarray(column_of(batch, "n"))
                child, row = _split(buckets, row, values, share)
                arrays = [pa.array(child.view(np.int64)), pa.array(nodes[row]), pa.array(sizes[row])]
                yield pa.RecordBatch.from_arrays(arrays, names=["bucket", "node", "above"])

    return rows.mapInArrow(split, "bucket long, node long, above long")


def likely(signatures: np.ndarray, least: int) -> np.ndarray:
    """Which pairs agree at ``least`` coordinates."""
    agree = np.zeros((len(signatures), len(signatures)), dtype=np.uint8)
    for c in range(signatures.shape[1]):
        column = signatures[:, c]
        agree += column[:, None] == column[None, :]
    return agree >= least


def labels_of(adjacent: np.ndarray) -> np.ndarray:
    """The smallest index of each member's component."""
    n = len(adjacent)
    label = np.arange(n)
    while True:
        new = np.minimum(label, np.where(adjacent, label[None, :], n).min(axis=1))
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _in_blocks(rows: DataFrame, key: str, count: str, member: str, small: int, block: int) -> DataFrame:
    """Rows with ``_i, _j``: members of a key with more than ``small`` rows are dealt to blocks, and every two blocks meet."""
    blocks = F.when(F.col(count) <= small, 1).otherwise(F.ceil(F.col(count) / block)).cast("int")
    dealt = rows.withColumn("_n", blocks).withColumn("_own", F.pmod(F.xxhash64(member, key), F.col("_n")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("_n") - 1))
    met = dealt.withColumn("_other", other)
    return met.withColumns({"_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other")}).drop("_n", "_other")


def _likely_edges(leaves: DataFrame, threshold: float) -> DataFrame:
    """Edges that span the likely connections of each bucket (or pair of its blocks)."""
    spread = math.sqrt(threshold * (1 - threshold) / COORDINATES)
    least = math.ceil(COORDINATES * (threshold - DEVIATIONS * spread))

    def compare(batches):
        for rows in sorted_groups(batches, ["bucket", "_i", "_j"]):
            if rows.num_rows < 2:
                continue
            nodes = np.asarray(rows.column("node"))
            values = np.frombuffer(b"".join(rows.column("signature").to_pylist()), np.uint32).reshape(-1, COORDINATES)
            label = labels_of(likely(values, least))
            tied = np.flatnonzero(label != np.arange(len(label)))
            if len(tied):
                arrays = [pa.array(nodes[tied]), pa.array(nodes[label[tied]])]
                yield pa.RecordBatch.from_arrays(arrays, names=["a", "b"])

    met = _in_blocks(leaves, "bucket", "n", "node", SMALL, BLOCK)
    keys = ["bucket", "_i", "_j"]
    dealt = met.select(*keys, "node", "signature").repartition(*keys).sortWithinPartitions(*keys)
    return dealt.mapInArrow(compare, _EDGE)


def candidate_edges(nodes: DataFrame, work, threshold: float, runs: int) -> DataFrame:
    """Spanning edges of likely pairs, from all runs; ``nodes`` has ``node, signature``.

    A bucket that keeps most of the one above it holds near copies, which no further split would part: it is compared in
    blocks as it is.
    """
    found = None
    items = _children(nodes.select("node", "signature"), threshold, roots=runs)
    for depth in range(2, MAX_DEPTH + 1):
        items = work.stage(items, "items")
        print_of = F.xxhash64("node")
        sizes = items.groupBy("bucket").agg(
            F.count("*").alias("n"),
            F.bit_xor(print_of).alias("_x"),
            F.sum(F.shiftright(print_of, 20)).alias("_y"),
            F.max("above").alias("_above"),
        )
        small = (F.col("n") <= SMALL) | (F.col("n") >= KEPT * F.col("_above")) | F.lit(depth == MAX_DEPTH)
        # Buckets with the same nodes are one bucket.
        sizes = sizes.filter("n > 1").groupBy("n", "_x", "_y").agg(F.min("bucket").alias("bucket"), F.max(small).alias("leaf"))
        sized = work.stage(items.drop("above").join(sizes.select("bucket", "n", "leaf"), "bucket"), "sized")
        edges = _likely_edges(sized.filter("leaf").join(nodes.select("node", "signature"), "node"), threshold)
        found = edges if found is None else found.union(edges)
        large = sized.filter("NOT leaf")
        if depth == MAX_DEPTH or large.isEmpty():
            break
        items = _children(large.select("bucket", "node", "n").join(nodes.select("node", "signature"), "node"), threshold)
    return work.stage(found.distinct(), "candidates")


def verified(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of a member of ``left`` and one of ``right`` (masks) reach the threshold, exactly."""
    n = len(sets)
    member = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count[column] > 1
    member, column = member[shared], column[shared]
    common = np.zeros((n, n), dtype=np.float64)
    if len(column):
        order = np.argsort(column, kind="stable")
        member, column = member[order], column[order]
        _, column = np.unique(column, return_inverse=True)
        width = max(256, min(8192, 4_000_000 // n))
        cuts = np.searchsorted(column, np.arange(0, column[-1] + 1 + width, width))
        for at, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
            has = np.zeros((n, width), dtype=np.float32)
            has[member[a:b], column[a:b] - at * width] = 1
            common += has @ has.T
    sizes = np.asarray([len(s) for s in sets], dtype=np.float64)
    ok = common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9
    np.fill_diagonal(ok, False)
    return ok & ((left[:, None] & right[None, :]) | (right[:, None] & left[None, :]))


def _links(docs: DataFrame, active: DataFrame, threshold: float) -> DataFrame:
    """``node, label, n_links, n_linked`` of each node in each pair of blocks of its family."""

    def sets(batches):
        hashes = word_hasher()
        kept = ["family", "_i", "_j", "_own", "node", "n_docs"]
        for piece in pieces(batches):
            hashes.trim()
            nodes = column_of(piece, "node").to_pylist()
            at, values = [], []
            for i, (node, text) in enumerate(zip(nodes, texts_of(piece), strict=True)):
                shingles = shingle_set(folded_words(text), hashes)
                # Another text of the same id is not this node.
                if node_of(shingles) == node:
                    at.append(i)
                    values.append(shingles.tobytes())
            rows = piece.take(pa.array(at, pa.int64()))
            arrays = [*(column_of(rows, k) for k in kept), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "shingles"])

    def decide(batches):
        for rows in sorted_groups(batches, ["family", "_i", "_j"]):
            nodes, first = np.unique(np.asarray(rows.column("node")), return_index=True)
            rows = rows.take(pa.array(first))
            own = np.asarray(rows.column("_own"))
            i, j = rows.column("_i")[0].as_py(), rows.column("_j")[0].as_py()
            values = [np.frombuffer(s, np.uint64) for s in rows.column("shingles").to_pylist()]
            linked = verified(values, own == i, own == j, threshold)
            n_docs = np.asarray(rows.column("n_docs"))
            label = nodes[labels_of(linked)]
            arrays = [nodes, label, linked.sum(axis=1).astype(np.int64), (linked @ n_docs).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["node", "label", "n_links", "n_linked"])

    # Families grow with the corpus, so their members are not sent to every task, even where they are few.
    wanted = docs.select("doc_id", "text").join(active.hint("merge"), "doc_id").drop("doc_id")
    schema = "family long, _i int, _j int, _own int, node long, n_docs long, shingles binary"
    keys = ["family", "_i", "_j"]
    met = wanted.mapInArrow(sets, schema).repartition(*keys).sortWithinPartitions(*keys)
    return met.mapInArrow(decide, "node long, label long, n_links long, n_linked long")


def similar_documents(
    docs: DataFrame, threshold: float = THRESHOLD, target_recall: float = TARGET_RECALL
) -> DataFrame:
    """``doc_id, class_id, copy_of, n_links, n_linked_docs`` of every row.

    ``class_id`` is the smallest ``doc_id`` of the rows connected by links of at least ``threshold``; ``copy_of`` the
    smallest of the rows with an equal set of shingles; ``n_links`` counts the different other sets that are linked, and
    ``n_linked_docs`` all other rows that are linked, those with an equal set included.

    A null or empty text has no shingles, so it is a class of its own without links; so is a row with a null ``doc_id``,
    whose class is null. Rows that share an id are judged by their own texts. Sets are named by 64 bits of hash.
    """
    work = scratch(docs.sparkSession)
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = known.filter("doc_id is not null")
    signed = work.stage(_signed(texts), "signed")
    nodes = work.stage(
        signed.groupBy("node").agg(
            F.min("doc_id").alias("doc_id"), F.count("*").alias("n_docs"), F.first("signature").alias("signature")
        ),
        "nodes",
    )
    families = connected_components(candidate_edges(nodes, work, threshold, runs_for(target_recall)), work)
    sized = families.join(families.groupBy("root").agg(F.count("*").alias("_size")), "root")
    active = sized.join(nodes.select("node", "doc_id", "n_docs"), "node").withColumnRenamed("root", "family")
    active = _in_blocks(active, "family", "_size", "node", FAMILY_BLOCK, FAMILY_BLOCK)
    active = active.select("doc_id", "family", "_i", "_j", "_own", "node", "n_docs")
    links = work.stage(_links(texts, work.stage(active, "active"), threshold), "links")
    classes = connected_components(links.select(F.col("node").alias("a"), F.col("label").alias("b")), work)
    per_node = links.groupBy("node").agg(F.sum("n_links").alias("n_links"), F.sum("n_linked").alias("n_linked"))
    named = nodes.select("node", F.col("doc_id").alias("copy_of"), "n_docs").join(classes, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node")).join(per_node, "node", "left")
    smallest = named.groupBy("root").agg(F.min("copy_of").alias("class_id"))
    named = work.stage(named.join(smallest, "root"), "classes")
    members = signed.select("doc_id", "node").join(named, "node").select(
        "doc_id",
        "class_id",
        "copy_of",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.coalesce("n_linked", F.lit(0)) + F.col("n_docs") - 1).alias("n_linked_docs"),
    )
    # A text has words if one of its characters is a digit, a letter or not ASCII.
    has_words = F.coalesce(F.col("text").rlike("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]"), F.lit(False))
    rest = known.filter(F.col("doc_id").isNull() | ~has_words)
    zero = F.lit(0).cast("long")
    alone = rest.select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_of"),
        zero.alias("n_links"), zero.alias("n_linked_docs"),
    )
    return members.union(alone)
