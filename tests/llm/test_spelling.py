"""Spelling variants against a brute-force version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from plumbline.llm.spelling import spelling_variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_counts(rows):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]+", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = h % len(run)
            counts[run[:at] + run[at + 1 :] if h % 97 == 0 else run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows):
    counts = brute_counts(rows)
    near = {w: [v for v in counts if one_apart(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def family(rng, stem):
    """A word and chains of its misspellings: letters inserted, left out and replaced, runs of equal letters too."""
    words = [stem]
    for _ in range(14):
        w = rng.choice(words)
        i = rng.randrange(len(w))
        words.append(rng.choice([w[:i] + w[i] + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice("abcdeéÿ") + w[i + 1 :]]))
    return words


@pytest.mark.parametrize("tasks", [1, 7])
def test_variants_are_those_of_brute_force(spark, make_docs, tasks):
    rng = random.Random(tasks)
    words = [w for stem in ("aaabbbaa", "connect", "tionen", "ééàtrèe", "zzzzzzz") for w in family(rng, stem)]
    texts = [" ".join(rng.choices(words, weights=[60 / (1 + i % 15) ** 2 for i in range(len(words))], k=70)) for _ in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(tasks))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = got(spelling_variants(make_docs(texts)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = brute(list(enumerate(texts)))
    assert found == want
    assert any(r[1] and r[2] != r[1] for r in want) and any(r[1] is None and r[4] for r in want)


def test_edge_rows(edge_docs, edge_rows, no_docs, make_docs):
    assert got(spelling_variants(edge_docs)) == brute(edge_rows)
    assert got(spelling_variants(no_docs)) == []
    long = "ab" * 30_000
    texts = [f"{long}c {long} {long}c" for _ in range(4)] + [None, "", "a b ÀÁÂ ×÷×÷× ×÷×÷×", "×÷×÷×"]
    assert long in brute_counts(list(enumerate(texts)))
    found = {(r[0], r[1], r[4]) for r in got(spelling_variants(make_docs(texts)))}
    assert found == {(r[0], r[1], r[4]) for r in brute(list(enumerate(texts)))}


def test_a_word_of_a_third_of_all_rows(make_docs):
    rows = ["common commom comon other"] * 200 + [f"words{'abcdefghij'[i % 10]} common" for i in range(100)]
    assert got(spelling_variants(make_docs(rows))) == brute(list(enumerate(rows)))
