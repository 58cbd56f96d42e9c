"""The prefix trie against a brute-force version, and the parentheses against plain scans."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.parentheses import Parentheses
from plumbline.llm.prefix_trie import prefix_trie

TURNS = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            own[c].append((t is not None, t or 0, r or "", x or ""))
    turns = {c: [v[2:] for v in sorted(rows)] for c, rows in own.items()}
    paths = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(turns.get(c - c % 20, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c in sorted(paths):
        for d in range(len(paths[c]) + 1):
            members[paths[c][:d]].append(c)
    children = defaultdict(set)
    for p in members:
        if p:
            children[p[:-1]].add(p)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, own_members in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(own_members) - 1) * words
    out = []
    for p, own_members in members.items():
        ends = ",".join(str(c) for c in own_members if paths[c] == p)
        parent = members[p[:-1]][0] if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((own_members[0], len(p), parent, len(own_members), len(children[p]), leaves[p], saved[p], sha))
    return ordered(out)


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v) for v in r))


def got(df):
    return ordered(tuple(r) for r in df.select(*COLUMNS).collect())


def branching(rng, n, deepest):
    """Conversations that share turns with each other, many of them whole."""
    seen = [[]]
    for c in range(n):
        old = rng.choice(seen[-30:])
        turns = old[: rng.randrange(len(old) + 1)] + [(rng.choice(["user", "assistant", None]), f"w{rng.randrange(6)} " * rng.randrange(4)) for _ in range(rng.randrange(deepest))]
        seen.append(old if rng.random() < 0.3 else turns)
        for t, (role, text) in enumerate(seen[-1]):
            yield c, t, role, text


@pytest.mark.parametrize(("segment", "shard_turns"), [(64, 200_000), (64, 60), (3, 40), (1, 25), (2, 100_000)])
def test_nodes_are_those_of_brute_force(spark, segment, shard_turns):
    rows = list(branching(random.Random(segment + shard_turns), 150, 9))
    df = spark.createDataFrame(rows, TURNS).repartition(3)
    assert got(prefix_trie(df, segment, shard_turns)) == brute(rows)


def test_hot_turns_and_copies_spread_over_shards(spark):
    rng = random.Random(3)
    rows = [(c, t, "user", f"same {t}") for c in range(300) for t in range(3)]
    rows += [(c, t, "user", f"{'same' if t == 0 else rng.random()} {t}") for c in range(300, 400) for t in range(3)]
    df = spark.createDataFrame(rows, TURNS)
    assert got(prefix_trie(df, 64, 50)) == brute(rows)


def test_a_long_conversation(spark):
    rows = [(20, t, "user", f"turn {t}") for t in range(1_000)] + [(21, t, "user", f"turn {t}") for t in range(700)]
    rows += [(22, t, "user", f"turn {t}") for t in range(64)] + [(c, 0, "user", "turn 0") for c in range(23, 40)]
    df = spark.createDataFrame(rows, TURNS)
    assert got(prefix_trie(df, 64, 300)) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None, None, None), (1, None, "user", "before"), (1, 0, "user", None), (2, 5, "user", "x"), (2, 5, "user", "x"), (2, 5, "a", "y")]
    rows += [(None, 0, "user", "nobody"), (40, 0, "user", "many words " * 30_000), (41, 0, None, ""), (-5, 1, "user", "below zero")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in ("id", "d", "_k", "path", "kind", "base", "h")})
    assert got(prefix_trie(df)) == brute(rows)
    assert got(prefix_trie(df.filter("false"))) == []
    # A conversation whose turns are all replaced by those of one that isn't there.
    lone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    assert got(prefix_trie(spark.createDataFrame([(lone, 0, "user", "x")], TURNS))) == brute([(lone, 0, "user", "x")])


def test_parentheses():
    rng = random.Random(1)
    for n in (1, 2, 5, 40, 200, 900):
        bits, stack, close, left, down = [], [], {}, n, rng.random()
        while left or stack:
            if left and (not stack or rng.random() < down):
                stack.append(len(bits))
                bits.append(1)
                left -= 1
            else:
                close[stack.pop()] = len(bits)
                bits.append(0)
        tree, opens, at, b = Parentheses(np.array(bits)), np.array(sorted(close)), np.arange(len(bits)), np.array(bits)
        assert tree.findclose(opens).tolist() == [close[i] for i in opens.tolist()]
        assert tree.rank_open(at).tolist() == [int(b[:i].sum()) for i in at]
        assert tree.rank_leaves(at).tolist() == [sum(b[j] == 1 and b[j + 1] == 0 for j in range(i)) for i in at]
