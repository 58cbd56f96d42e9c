"""Prefix trie of conversations as balanced parentheses per shard: members, leaves and savings of every shared prefix.

1. Turns are numbered in their conversations and conversations rebuilt (:func:`rebuilt`); texts stay behind, what goes on is a
   128-bit hash and the number of words of each turn.
2. A conversation's turns are cut into segments of SEGMENT turns. A chained hash names each prefix, so a node of the trie has
   the same 16 bytes wherever it is met. A segment is the node it starts from and the path of nodes below.
3. Segments are range-partitioned in the order of start, path and conversation: a shard is a run of the depth-first order, and
   copies of one path, however many, spread over shards. Of its run a shard builds the parentheses. ``findclose``
   delimits subtrees, rank counts leaf pairs in them, and differences of cumulative arrays give members and savings.
4. Nodes on the first and the last path of a shard, its spines, may go on in other shards. They are emitted as partial
   sums, merged, and what they themselves save or count as leaves is added to their ancestors, which are spines too. All other
   nodes are final.
5. Where conversations have more than SEGMENT turns, the trees below segment ends are summed over the tree of segment starts by
   doubling its pointers, in a number of rounds that grows with the logarithm of the longest conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import SPACE_CLASS, column_of, ranked, scratch
from plumbline.llm.parentheses import Parentheses

SEGMENT = 64
#: Turns of a shard, about, and members that a piece of a member list names.
SHARD_TURNS = 200_000
PIECE_MEMBERS = 1_000
#: Conversations in a row that share their first turns with the first of them.
FAMILY = 20
HEADS = 4

ROOT = bytes(16)
_NO_MEMBERS = hashlib.sha256(b"").hexdigest()
_MANY = np.iinfo(np.int64).max


def rebuilt(conversations: DataFrame, work) -> tuple[DataFrame, DataFrame]:
    """``conv_id, length`` of every rebuilt conversation, and ``conv_id, d, h1, h2, words`` of its turns, ``d`` from 0 on.

    Conversation c has the first h = crc32(c) mod HEADS turns of conversation c - c mod FAMILY, all if it has fewer, and then
    its own after its first h.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text")
    )
    numbered = ranked(rows, "conv_id", ["turn", "role", "text"], work)
    turns = numbered.select(
        "conv_id",
        "_k",
        F.xxhash64(F.lit(1), "role", "text").alias("h1"),
        F.xxhash64("text", F.lit(2), "role").alias("h2"),
        F.regexp_count("text", F.lit(f"[^{SPACE_CLASS}]+")).cast("long").alias("words"),
    )
    turns = work.stage(turns, "turns")
    heads = F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS
    each = turns.groupBy("conv_id").agg((F.max("_k") + 1).alias("n")).select(
        "conv_id", "n", heads.alias("h"), (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("base")
    )
    bases = each.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    each = each.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0))))
    each = work.stage(each.select("conv_id", "n", "h", "base", "taken"), "conversations")
    first = turns.filter(F.col("_k") < HEADS - 1).withColumnRenamed("conv_id", "base")
    given = each.join(first, "base").filter("_k < taken").select("conv_id", F.col("_k").alias("d"), "h1", "h2", "words")
    own = turns.join(each.select("conv_id", "h", "taken"), "conv_id").filter("_k >= h")
    own = own.select("conv_id", (F.col("_k") - F.col("h") + F.col("taken")).alias("d"), "h1", "h2", "words")
    length = F.col("taken") + F.greatest(F.lit(0), F.col("n") - F.col("h"))
    return each.select("conv_id", length.cast("long").alias("length")), given.union(own)


def segments(turns: DataFrame, size: int) -> DataFrame:
    """``start, path, conv_id, depth, words, more, up``: the segments of all conversations.

    ``up`` is the start of the segment before, ``depth`` that of ``start``, ``more`` tells that another segment follows.
    """
    import xxhash

    turn = F.struct("d", "h1", "h2", "words")
    cut = turns.groupBy("conv_id", F.floor(F.col("d") / size).cast("long").alias("_seg")).agg(
        F.sort_array(F.collect_list(turn)).alias("_turns")
    )
    cut = cut.select("conv_id", "_seg", *[F.col(f"_turns.{c}").alias(c) for c in ("h1", "h2", "words")])

    def chain(batches):
        last, state, up = None, ROOT, ROOT
        held = None
        for batch in batches:
            rows = []
            columns = [column_of(batch, c).to_pylist() for c in ("conv_id", "_seg", "h1", "h2", "words")]
            for conv_id, seg, h1, h2, words in zip(*columns, strict=True):
                if held is not None:
                    held[5] = conv_id == last
                    rows.append(held)
                if conv_id != last:
                    last, state, up = conv_id, ROOT, ROOT
                start, path = state, []
                pairs = np.array([h1, h2], dtype="<i8").T.tobytes()
                for at in range(0, len(pairs), 16):
                    state = xxhash.xxh3_128_digest(state + pairs[at : at + 16])
                    path.append(state)
                held = [start, b"".join(path), conv_id, seg * size, np.array(words, "<i8").tobytes(), False, up]
                up = start
            if rows:
                yield _batch(rows)
        if held is not None:
            yield _batch([held])

    def _batch(rows):
        types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.bool_(), pa.binary()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["start", "path", "conv_id", "depth", "words", "more", "up"])

    schema = "start binary, path binary, conv_id long, depth long, words binary, more boolean, up binary"
    return cut.repartition("conv_id").sortWithinPartitions("conv_id", "_seg").mapInArrow(chain, schema)


#: What a shard tells: final nodes; partial sums of spines and starts; ends of segments that go on; pieces of member lists.
NODE, PART, END, MEMBERS = range(4)
_SHARD = (
    "kind int, id binary, is_start boolean, conv_id long, depth long, parent binary, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, more boolean, ancestors binary, up binary, "
    "ends_sha256 string, shard long, piece long, members binary"
)
_NAMES = [c.split()[0] for c in _SHARD.split(", ")]
_TYPES = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}


def _rows(n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for c in _SHARD.split(", "):
        name, kind = c.split()
        arrays.append(pa.array(columns[name], _TYPES[kind]) if name in columns else pa.nulls(n, _TYPES[kind]))
    return pa.RecordBatch.from_arrays(arrays, names=_NAMES)


class _Shard:
    """The trees of a run of segments in order, as arrays in depth-first order and the bits of their parentheses."""

    def __init__(self, batches):
        self.ids: list[bytes] = []
        self.depth: list[int] = []
        self.parent: list[int] = []
        self.words: list[int] = []
        self.up: dict[int, bytes] = {}  # of the starts
        self.bits: list[int] = []
        self.at: list[int] = []  # the node at which each segment ends
        self.conv: list[int] = []
        self.goes_on: list[bool] = []
        self.first_path: list[int] = []
        stack: list[int] = []
        last: bytes | None = None
        names = ["start", "path", "conv_id", "depth", "words", "more", "up"]
        for batch in batches:
            for start, path, conv_id, depth, words, more, up in zip(*(column_of(batch, n).to_pylist() for n in names), strict=True):
                if last != start:
                    self.bits += [0] * len(stack)
                    stack, last = [], start
                    self.up[self._open(start, depth, -1, 0)] = up
                    stack.append(len(self.ids) - 1)
                same = 1
                while same < len(stack) and self.ids[stack[same]] == path[16 * (same - 1) : 16 * same]:
                    same += 1
                self.bits += [0] * (len(stack) - same)
                del stack[same:]
                counts = np.frombuffer(words, "<i8").tolist()
                for i in range(same - 1, len(counts)):
                    self._open(path[16 * i : 16 * i + 16], depth + i + 1, stack[-1], counts[i])
                    stack.append(len(self.ids) - 1)
                if not self.first_path:
                    self.first_path = stack[:]
                self.at.append(stack[-1])
                self.conv.append(conv_id)
                self.goes_on.append(more)
        self.last_path = stack[:]
        self.bits += [0] * len(stack)

    def _open(self, node: bytes, depth: int, parent: int, words: int) -> int:
        self.ids.append(node)
        self.depth.append(depth)
        self.parent.append(parent)
        self.words.append(words)
        self.bits.append(1)
        return len(self.ids) - 1

    def ancestors(self, node: int) -> bytes:
        """The nodes above up to the start, which comes last."""
        out = []
        node = self.parent[node]
        while node >= 0:
            out.append(self.ids[node])
            node = self.parent[node]
        return b"".join(out)

    def results(self, shard: int):
        n = len(self.ids)
        if not n:
            return
        depth, parent = np.array(self.depth), np.array(self.parent)
        words, at = np.array(self.words), np.array(self.at)
        conv, goes_on = np.array(self.conv), np.array(self.goes_on)
        bits = np.array(self.bits, dtype=np.int8)
        opens = np.flatnonzero(bits)
        tree = Parentheses(bits)
        closes = tree.findclose(opens)
        order = np.arange(n)
        size = (closes - opens + 1) // 2

        def within(values: np.ndarray) -> np.ndarray:
            """Sums over subtrees."""
            total = np.concatenate([[0], np.cumsum(values)])
            return total[order + size] - total[order]

        is_start = parent < 0
        spine = is_start.copy()
        spine[self.first_path] = spine[self.last_path] = True
        members = within(np.bincount(at, minlength=n))
        on = np.bincount(at[goes_on], minlength=n) > 0
        # Leaf pairs of the subtree, without those of spines and of nodes that go on, which may not be leaves.
        pairs = size == 1
        leaves = tree.rank_leaves(closes) - tree.rank_leaves(opens) - within(pairs & (spine | on))
        own = np.where(spine, 0, (members - 1) * words)
        saved = within(own)
        children = np.bincount(parent[(parent >= 0) & ~spine], minlength=n)
        least = np.full(n, _MANY)
        np.minimum.at(least, at, conv)
        for d in range(int(depth.max()), int(depth.min()), -1):
            here = np.flatnonzero((depth == d) & ~is_start)
            np.minimum.at(least, parent[here], least[here])
        # Conversations that end at a node, in ascending order.
        ending = np.flatnonzero(~goes_on)
        ending = ending[np.argsort(at[ending], kind="stable")]
        ends: dict[int, np.ndarray] = {}
        if len(ending):
            cuts = np.flatnonzero(np.diff(at[ending])) + 1
            ends = {int(at[some[0]]): conv[some] for some in np.split(ending, cuts)}
        done = np.flatnonzero(~spine)
        inner = ~spine[parent[done]]
        above = np.where(inner, least[parent[done]], 0)
        yield _rows(
            len(done),
            kind=np.full(len(done), NODE, np.int32),
            id=[self.ids[i] for i in done.tolist()],
            is_start=np.zeros(len(done), bool),
            conv_id=least[done],
            depth=depth[done],
            parent=[self.ids[i] for i in parent[done].tolist()],
            parent_conv_id=pa.array(above, pa.int64(), mask=~inner),
            n_convs=members[done],
            n_children=children[done],
            n_leaves=leaves[done],
            saved_tokens=saved[done],
            ends_sha256=[hashlib.sha256(_listed(ends[i])).hexdigest() if i in ends else _NO_MEMBERS for i in done.tolist()],
        )
        part = np.flatnonzero(spine).tolist()
        yield _rows(
            len(part),
            kind=np.full(len(part), PART, np.int32),
            id=[self.ids[i] for i in part],
            is_start=is_start[part],
            conv_id=least[part],
            depth=depth[part],
            parent=[None if is_start[i] else self.ids[parent[i]] for i in part],
            n_convs=members[part],
            n_children=children[part],
            n_leaves=leaves[part],
            saved_tokens=saved[part],
            words=words[part],
            more=on[part],
            ancestors=[self.ancestors(i) for i in part],
            up=[self.up.get(i) for i in part],
        )
        going = np.flatnonzero(on).tolist()
        if going:
            yield _rows(
                len(going),
                kind=np.full(len(going), END, np.int32),
                id=[self.ids[i] for i in going],
                ancestors=[self.ancestors(i)[:-16] for i in going],
            )
        for i in part:
            yield from _pieces(self.ids[i], shard, ends.get(i, np.zeros(0, np.int64)), 0)


def _listed(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _pieces(node: bytes, shard: int, ids: np.ndarray, first: int):
    """The member list of a node in pieces."""
    texts = [_listed(ids[a : a + PIECE_MEMBERS]) for a in range(0, len(ids), PIECE_MEMBERS)]
    if texts:
        n = len(texts)
        yield _rows(
            n,
            kind=np.full(n, MEMBERS, np.int32),
            id=[node] * n,
            shard=np.full(n, shard),
            piece=np.arange(first, first + n),
            members=texts,
        )


def _member_digests(pieces: DataFrame) -> DataFrame:
    """``id, ends_sha256`` of the lists that are in pieces, read one piece after the other."""

    def digest(batches):
        last, state = None, None
        for batch in batches:
            done = []
            for node, members in zip(column_of(batch, "id").to_pylist(), column_of(batch, "members").to_pylist(), strict=True):
                if node != last:
                    if last is not None:
                        done.append((last, state.hexdigest()))
                    last, state = node, hashlib.sha256(members)
                else:
                    state.update(b"," + members)
            if done:
                yield named(done)
        if last is not None:
            yield named([(last, state.hexdigest())])

    def named(rows):
        ids, digests = zip(*rows, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.binary()), pa.array(digests)], names=["id", "ends_sha256"])

    dealt = pieces.repartition("id").sortWithinPartitions("id", "shard", "piece").select("id", "members")
    return dealt.mapInArrow(digest, "id binary, ends_sha256 string")


def _below(nodes: DataFrame, sums: list[str], to_start: bool) -> DataFrame:
    """``id, is_start`` and the ``sums`` of ``nodes``, added up at each of their ancestors; the last one is a start or is not."""
    last = F.octet_length("ancestors") - 16
    each = F.explode(
        F.transform(
            F.sequence(F.lit(0), last, F.lit(16)),
            lambda i: F.struct(
                F.substring("ancestors", i + 1, F.lit(16)).alias("id"), (F.lit(to_start) & (i == last)).alias("is_start")
            ),
        )
    )
    some = nodes.filter(F.octet_length("ancestors") > 0).select(each.alias("_node"), *sums)
    return some.groupBy("_node.id", "_node.is_start").agg(*[F.sum(c).alias(c) for c in sums])


def prefix_trie(conversations: DataFrame, segment: int = SEGMENT, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    A null role or text is empty; null turns come first; rows of equal turn are ordered by role and text, and repeated rows are
    turns of their own. Rows without a ``conv_id`` belong to no conversation. A conversation without turns of its own left is
    a member of the root alone. An empty table has no members and so not even a root. Other columns are ignored;
    conversations may have any number of turns.
    """
    spark = conversations.sparkSession
    work = scratch(spark)
    each, turns = rebuilt(conversations, work)
    each = work.stage(each, "lengths")
    total = each.agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.coalesce(F.sum("length"), F.lit(0)).alias("turns"),
        F.coalesce(F.max("length"), F.lit(0)).alias("longest"),
    ).first()
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    schema = ", ".join(f"{c} {'string' if c == 'ends_sha256' else 'long'}" for c in columns)
    if not total["n"]:
        return spark.createDataFrame([], schema)

    def build(batches):
        yield from _Shard(batches).results(TaskContext.get().partitionId())

    order = ["start", "path", "conv_id"]
    shards = max(1, -(-total["turns"] // shard_turns))
    dealt = segments(turns, segment).repartitionByRange(shards, *order).sortWithinPartitions(*order)
    told = work.stage(dealt.mapInArrow(build, _SHARD), "shards")

    # Spines and starts, merged. A start other than the root is also a node of the segments above.
    merged = told.filter(F.col("kind") == PART).groupBy("id", "is_start").agg(
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.max("parent").alias("parent"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.max("words").alias("words"),
        F.max("more").alias("more"),
        F.first("ancestors").alias("ancestors"),
        F.max("up").alias("up"),
    )
    merged = work.stage(merged, "spines")
    # The only node above a start's child is the start; a node of the same name in the segments above has no such children.
    of_start = (F.octet_length("ancestors") == 16).alias("is_start")
    more = merged.filter("NOT is_start").groupBy(F.col("parent").alias("id"), of_start).agg(F.count("*").alias("_more_children"))
    merged = merged.join(more, ["id", "is_start"], "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("_more_children", F.lit(0))
    )
    leaf = (~F.col("is_start") & (F.col("n_children") == 0) & ~F.col("more")).cast("long")
    saves = F.when(F.col("is_start"), 0).otherwise((F.col("n_convs") - 1) * F.col("words"))
    merged = merged.withColumns({"_leaves": leaf, "_saved": saves})
    added = _below(merged.filter("NOT is_start"), ["_leaves", "_saved"], to_start=True)
    added = added.toDF("id", "is_start", "_leaves_below", "_saved_below")
    merged = merged.join(added, ["id", "is_start"], "left").withColumns(
        {
            "n_leaves": F.col("n_leaves") + F.col("_leaves") + F.coalesce("_leaves_below", F.lit(0)),
            "saved_tokens": F.col("saved_tokens") + F.col("_saved") + F.coalesce("_saved_below", F.lit(0)),
        }
    )
    merged = work.stage(merged.drop("_more_children", "_leaves", "_saved", "_leaves_below", "_saved_below"), "merged")

    # A start's tree with those of all starts below it.
    trees = merged.filter("is_start").select("id", "up", "n_children", "n_leaves", "saved_tokens")
    reach, longest = 1, -(-total["longest"] // segment)
    while reach < longest:
        there = F.when(F.col("id") != F.lit(ROOT), F.col("up"))
        trees = trees.withColumn("up", there) if reach == 1 else trees
        below = trees.filter("up IS NOT NULL").groupBy(F.col("up").alias("id")).agg(
            F.sum("n_leaves").alias("_l"), F.sum("saved_tokens").alias("_s")
        )
        ahead = trees.select(F.col("id").alias("up"), F.col("up").alias("_up"))
        trees = trees.join(below, "id", "left").join(ahead, "up", "left").select(
            "id",
            F.col("_up").alias("up"),
            "n_children",
            (F.col("n_leaves") + F.coalesce("_l", F.lit(0))).alias("n_leaves"),
            (F.col("saved_tokens") + F.coalesce("_s", F.lit(0))).alias("saved_tokens"),
        )
        trees = work.stage(trees, "trees")
        reach *= 2

    nodes = told.filter(F.col("kind") == NODE).select(
        "id", "conv_id", "depth", "parent", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )
    # Conversations that have no turns end at the root.
    turnless = each.filter("length = 0").select("conv_id")

    def list_turnless(batches):
        shard, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = column_of(batch, "conv_id").to_numpy()
            yield from _pieces(ROOT, shard, ids, first)
            first += -(-len(ids) // PIECE_MEMBERS)

    at_root = turnless.repartitionByRange("conv_id").sortWithinPartitions("conv_id").mapInArrow(list_turnless, _SHARD)
    digests = _member_digests(told.filter(F.col("kind") == MEMBERS).unionByName(at_root))
    spines = merged.filter("NOT is_start").join(digests, "id", "left").select(
        "id", "conv_id", "depth", "parent", F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
        "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(_NO_MEMBERS)).alias("ends_sha256"),
    )
    nodes = nodes.unionByName(spines)
    if longest > 1:
        # The trees below ends of segments belong to these ends and to what is above them in their segments.
        ends = told.filter(F.col("kind") == END).dropDuplicates(["id"]).select("id", "ancestors")
        deep = trees.filter(F.col("id") != F.lit(ROOT)).join(ends, "id")
        deep = work.stage(deep.select("id", "ancestors", "n_children", "n_leaves", "saved_tokens"), "deep")
        own = deep.select("id", F.col("n_children").alias("_c"), F.col("n_leaves").alias("_l"), F.col("saved_tokens").alias("_s"))
        above = _below(deep, ["n_leaves", "saved_tokens"], to_start=False).select("id", F.lit(0).alias("_c"), F.col("n_leaves").alias("_l"), F.col("saved_tokens").alias("_s"))
        more = own.union(above).groupBy("id").agg(*[F.sum(c).alias(c) for c in ("_c", "_l", "_s")])
        nodes = nodes.join(more, "id", "left")
        for c, extra in (("n_children", "_c"), ("n_leaves", "_l"), ("saved_tokens", "_s")):
            nodes = nodes.withColumn(c, F.col(c) + F.coalesce(extra, F.lit(0)))
        nodes = nodes.drop("_c", "_l", "_s")
    top = spark.range(1).select(F.lit(ROOT).alias("id")).join(trees, "id", "left").join(digests, "id", "left").select(
        "id",
        F.lit(total["least"]).cast("long").alias("conv_id"),
        F.lit(0).cast("long").alias("depth"),
        F.lit(None).cast("binary").alias("parent"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(total["n"]).cast("long").alias("n_convs"),
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_NO_MEMBERS)).alias("ends_sha256"),
    )
    nodes = work.stage(nodes.unionByName(top), "nodes")
    # Parents that were not final in the shard of their child: spines and ends of segments, a small part of all nodes.
    known = nodes.filter("parent IS NULL OR parent_conv_id IS NOT NULL").select(*columns)
    open_ = nodes.filter("parent IS NOT NULL AND parent_conv_id IS NULL").drop("parent_conv_id")
    names = nodes.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return known.unionByName(open_.join(names, "parent").select(*columns))
