"""Near duplicates, mixing, shards and quality rules."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from plumbline.llm.chosen_path import runs_for, similar_documents, verified
from plumbline.llm.components import connected_components
from plumbline.llm.decontamination import folded_words
from plumbline.llm.mixing import entropy, mixed, mixed_rows, solve_alpha, tempered
from plumbline.llm.quality import chi2_cdf, chi2_quantile, of_quality, quality_verdicts
from plumbline.llm.sharding import interleaved

from .conftest import prose


def sets_of(rows):
    out = []
    for d, t, *_ in rows:
        w = folded_words((t or "").encode())
        n = min(5, len(w))
        out.append((d, {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()))
    return out


def brute_similar(rows):
    sets = sets_of(rows)
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = Counter()
    for i, (d, a) in enumerate(sets):
        for j, (e, b) in enumerate(sets[:i]):
            if d is not None and e is not None and a and b and 5 * len(a & b) >= 4 * len(a | b):
                links[i] += 1
                links[j] += 1
                x, y = sorted((find(i), find(j)), key=lambda k: sets[k][0])
                parent[y] = x
    return sorted((d if d is not None else -1, sets[find(i)][0] if d is not None else -1, links[i]) for i, (d, _) in enumerate(sets))


def got_similar(df):
    rows = df.select("doc_id", "class_id", "n_linked_docs").collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in rows)


def test_links_are_those_of_brute_force(make_docs, monkeypatch):
    from plumbline.llm import chosen_path

    # Small bounds, so that buckets are split, compared in blocks, and families meet in blocks.
    for name, value in (("SMALL", 8), ("BLOCK", 12), ("FAMILY_BLOCK", 6)):
        monkeypatch.setattr(chosen_path, name, value)
    rng = random.Random(2)
    texts = []
    for family in range(6):
        base = prose(rng, 120, 3000).split()
        for _ in range(3 + 7 * family):
            copy = base[:]
            for _ in range(rng.randrange(0, 5)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(99)}"
            texts.append(" ".join(copy))
    texts += [prose(rng, 80, 3000) for _ in range(40)]
    assert got_similar(similar_documents(make_docs(texts))) == brute_similar(list(enumerate(texts)))


def test_similar_edge_rows(edge_docs, edge_rows, no_docs):
    assert got_similar(similar_documents(edge_docs)) == brute_similar(edge_rows)
    assert similar_documents(no_docs).count() == 0


def test_runs_reach_the_recall():
    assert runs_for(0.9) < runs_for(0.999)
    q = 1.0
    for _ in range(4):
        q = 1 - math.exp(-q)
    assert 1 - (1 - q) ** runs_for(0.999) >= 0.999


def test_verified_counts_only_pairs_of_the_two_sides():
    sets = [np.arange(n, n + 10, dtype=np.uint64) for n in (0, 0, 1, 50)]
    sides = np.array([True, True, False, False]), np.array([False, False, True, True])
    assert np.argwhere(verified(sets, *sides, 0.8)).tolist() == [[0, 2], [1, 2], [2, 0], [2, 1]]


def test_components(spark, workspace):
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(0, 300)]
    star = [(1000 + i, 1000) for i in range(1, 200)]
    loose = [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    edges = path + star + loose + [(5, 5)]
    root = {}
    adjacent = defaultdict(set)
    for a, b in edges:
        if a != b:
            adjacent[a].add(b)
            adjacent[b].add(a)
    for n in sorted(adjacent):
        if n not in root:
            todo = [n]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = n
                    todo += adjacent[x]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), workspace)
    assert {r.node: r.root for r in got.collect()} == root


def test_exponents():
    shares = [0.7, 0.2, 0.1]
    alpha = solve_alpha(shares, repeat_limit=2.0)
    repeats = [w / s for w, s in zip(tempered(shares, alpha), shares, strict=True)]
    assert max(repeats) / min(repeats) == pytest.approx(2.0)
    alpha = solve_alpha(shares, target_entropy=0.9)
    assert entropy(tempered(shares, alpha)) == pytest.approx(0.9)
    assert solve_alpha(shares, repeat_limit=100) == 0 and solve_alpha([1.0], repeat_limit=1) == 1
    with pytest.raises(ValueError):
        solve_alpha(shares)


def test_mixture_has_its_weights(make_docs):
    rng = random.Random(4)
    docs = make_docs([prose(rng, 40) for _ in range(1200)], lambda i: "big" if i % 6 else f"small{i % 4}")
    taken = mixed(docs, repeat_limit=3.0).withColumn("n", F.size(F.split("text", " "))).cache()
    total = taken.agg(F.sum("n")).first()[0]
    for r in taken.groupBy("source").agg(F.sum("n").alias("n"), F.first("weight").alias("w")).collect():
        assert r.n / total == pytest.approx(r.w, abs=0.02)
    times = taken.groupBy("doc_id").count()
    assert times.count() == 1200 and times.agg(F.max("count")).first()[0] <= 3
    assert taken.select("doc_id", "epoch").distinct().count() == taken.count()
    # With a budget below its weight a source loses whole blocks.
    less = mixed(docs, repeat_limit=None, target_entropy=0.0, budget=20_000)
    assert 0 < less.filter("source = 'big'").select("doc_id").distinct().count() < 1000


def test_mixing_edge_rows(edge_docs, edge_rows, no_docs):
    out = mixed_rows(edge_docs)
    assert out.columns == edge_docs.columns
    assert out.distinct().exceptAll(edge_docs.distinct()).isEmpty() and edge_docs.distinct().exceptAll(out.distinct()).isEmpty()
    assert mixed(edge_docs).count() >= len(edge_rows)
    assert mixed(no_docs).count() == 0


@pytest.mark.parametrize("bucket", [1 << 14, 7])
def test_shards_match_the_mixture(make_docs, bucket):
    docs = make_docs([f"t {i}" for i in range(500)], lambda i: f"s{min(i % 10, 4)}")
    rows = interleaved(docs, n_shards=8, rows_per_bucket=bucket).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r)
        assert r.size == len(f"t {r.doc_id}") + 1 and r.text_crc32 == zlib.crc32(f"t {r.doc_id}".encode())
    sizes = [len(by[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == 500
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
        for source, share in (("s0", 0.1), ("s4", 0.6)):
            n = sum(f"s{min(r.doc_id % 10, 4)}" == source for r in part)
            assert abs(n - share * len(part)) <= 2


def test_shards_of_edge_rows(edge_docs, edge_rows, no_docs):
    rows = interleaved(edge_docs, rows_per_bucket=10).collect()
    assert sorted(r["rank"] for r in rows) == list(range(len(edge_rows)))
    assert interleaved(no_docs).count() == 0


def brute_measures(text):
    text = text or ""
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.encode().split()]
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {j for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for j in range(i, i + 5)}
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_measures_are_those_of_brute_force(make_docs, edge_docs, edge_rows, no_docs):
    rng = random.Random(9)
    texts = ["\n".join(prose(rng, rng.randrange(0, 9), 3) for _ in range(rng.randrange(6))) for _ in range(150)]
    texts += ["a b c d e", "a b c d e a b c d e", "<b>| x #\x0b\n<b>| x #\x0b\n", "a " * 40, "x y z", "日本 語"]
    for docs, rows in ((make_docs(texts), list(enumerate(texts))), (edge_docs, edge_rows)):
        got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                      for r in quality_verdicts(docs, steps=1).collect())
        want = Counter()
        for d, t, *_ in rows:
            m = brute_measures(t)
            want[(d, *m, m[0] < 10 or 100 * m[4] > 20 * m[0])] += 1
        assert got == want
    assert quality_verdicts(no_docs).count() == 0


def test_outliers_go_and_others_stay(make_docs, edge_docs):
    rng = random.Random(6)
    texts = [prose(rng, rng.randrange(40, 400), 4000) for _ in range(400)]
    for i in range(0, 400, 20):
        texts[i] = " ".join(f"#*${w}<>|" for w in texts[i].split())
    verdicts = quality_verdicts(make_docs(texts, lambda i: f"s{i % 2}")).collect()
    assert {r.doc_id for r in verdicts if not r.kept} == set(range(0, 400, 20))
    assert of_quality(edge_docs).columns == edge_docs.columns


def test_moderate_outliers_of_one_measure_go(make_docs):
    """Each differs in one measure: symbols, repeated lines, longer or shorter words, number of words."""
    rng = random.Random(16)
    texts = [prose(rng, int(math.exp(rng.gauss(5, 0.4))), 4000) for _ in range(500)]
    lines = [f"line{i}" for i in range(12)]
    planted = {
        3: lambda w: " ".join(x + "#" if i % 4 else x for i, x in enumerate(w)),
        13: lambda w: "\n".join(rng.choice(lines) for _ in range(60)),
        23: lambda w: " ".join(x + "abcd" for x in w),
        33: lambda w: " ".join(x[:2] + x[-1:] for x in w),
        43: lambda w: prose(rng, 1300, 40_000),
        53: lambda w: "\n".join(x for i, x in enumerate(w) for x in ([x, x] if i % 2 else [x])),
    }
    for start, change in planted.items():
        for i in range(start, 500, 100):
            texts[i] = change(texts[i].split())
    verdicts = quality_verdicts(make_docs(texts)).collect()
    want = {i for i in range(500) if i % 100 in planted}
    assert not [r.doc_id for r in verdicts if r.doc_id in want and r.base_failed]
    gone = {r.doc_id for r in verdicts if not r.kept}
    assert want <= gone
    assert len(gone - want) <= 5


def test_few_rows_have_no_estimate(make_docs):
    rng = random.Random(8)
    rows = quality_verdicts(make_docs([prose(rng, 50) for _ in range(10)] + ["short"])).collect()
    assert sum(r.kept for r in rows) == 10 and all(r.distance is None for r in rows)


def test_chi_squared():
    assert chi2_cdf(chi2_quantile(0.75, 5), 5) == pytest.approx(0.75)
    assert chi2_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
