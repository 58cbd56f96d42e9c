"""Personal data and language-model scores."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from plumbline.llm import crf, logbloom
from plumbline.llm.personal_data import KINDS, PATTERNS, Decoder, _featured, _shape, addresses, base_spans, fit, luhn, personal_data
from plumbline.llm.common import Remembered
from plumbline.llm.scoring import scored

from .conftest import prose

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def test_patterns_match_as_stated():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice("a1.@-+ 2.@") for _ in range(rng.randrange(25)))
        assert addresses(text) == [m.span() for m in EMAIL.finditer(text)]
        assert [m.span() for m in PATTERNS["ip"].finditer(text)] == [m.span() for m in IP.finditer(text)]


def test_matches_that_do_not_hold_are_dropped():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    text = "4111 1111-1111 1111, 4111111111111112; 1.2.3.256 01.2.3.4 +1 234 567 x +49 (30) 1234567 y " + "9" * 5000
    found = [(k, text[a:b]) for k, a, b in base_spans(text)]
    assert found == [("ip", "01.2.3.4"), ("card", "4111 1111-1111 1111"), ("phone", "+49 (30) 1234567")]


def test_viterbi_is_the_best_of_all_labellings():
    rng = np.random.default_rng(0)
    lengths = np.array([1, 4, 2, 5, 3])
    scores = rng.normal(size=(lengths.sum(), 3))
    transition, start = rng.normal(size=(3, 3)), rng.normal(size=3)
    got = crf.viterbi(scores, lengths, transition, start)
    at = 0
    for n in lengths:
        own = scores[at : at + n]

        def value(path, own=own):
            steps = sum(transition[a, b] for a, b in itertools.pairwise(path))
            return start[path[0]] + steps + sum(own[i, y] for i, y in enumerate(path))

        best = max(itertools.product(range(3), repeat=int(n)), key=value)
        assert tuple(got[at : at + n]) == best
        at += n


def labelled_texts(rng, n):
    out = []
    for _ in range(n):
        words = prose(rng, 30).split()
        data = rng.choice(
            [
                f"{prose(rng, 1)}@{prose(rng, 1)}.org",
                ".".join(str(rng.randrange(256)) for _ in range(4)),
                "4111 1111 1111 1111",
                f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
            ]
        )
        words.insert(rng.randrange(30), data)
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def model(make_docs):
    return fit(make_docs(labelled_texts(random.Random(5), 300)))


def test_model_finds_held_out_data(make_docs, model):
    """Numbers without their plus are no base match; the model has to find most of them by their shape."""
    rng = random.Random(77)
    texts, gold = [], []
    for _ in range(100):
        number = f"1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}"
        before = prose(rng, 12)
        texts.append(f"{before} {number} {prose(rng, 12)}")
        gold.append((len(before) + 1, len(before) + 1 + len(number)))
    rows = {r.doc_id: r for r in personal_data(make_docs(texts), model).collect()}
    found = sum(f"phone:{a}:{b}" in rows[i].spans.split(",") for i, (a, b) in enumerate(gold))
    assert found >= 80
    plain = personal_data(make_docs([prose(rng, 50) for _ in range(50)]), model)
    assert plain.filter("n_added > 0").isEmpty()


def test_model_finds_spelled_out_addresses(make_docs):
    """Without a digit or an at sign in the line."""
    rng = random.Random(78)
    names = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(4, 9))) for _ in range(600)]
    draw = lambda n: " ".join(rng.choice(names) for _ in range(n))
    own = lambda at, dot: f"{draw(1)}{dot}{draw(1)}{at}{draw(1)}{dot}org"
    model = fit(make_docs([f"{draw(9)} at {draw(3)}\n{draw(12)} {own('@', '.')} {draw(12)}" for _ in range(200)]))
    texts, gold = [], []
    for _ in range(100):
        address, before = own(" at ", " dot "), draw(12)
        texts.append(f"{before} {address} {draw(12)}")
        gold.append((len(before) + 1, len(before) + 1 + len(address)))
    rows = {r.doc_id: r for r in personal_data(make_docs(texts), model).collect()}
    assert sum(f"email:{a}:{b}" in rows[i].spans.split(",") for i, (a, b) in enumerate(gold)) >= 80
    plain = personal_data(make_docs([f"{draw(20)} at {draw(20)}" for _ in range(50)]), model)
    assert plain.filter("n_added > 0").count() <= 2


def test_cut_lines_have_the_labels_of_whole_ones(model):
    """Words of data, halves of it and plain words in any order, so that lines are cut in many places."""
    rng = random.Random(9)
    pool = ["a@b.org", "at", "dot", "org", "1", "(415)", "555-1234", "+1", "4111", "1111", "10.0.0.1", "[.]", "word", "another", "x,", "é", "é.", "ab,", "Été,", "a.b", "...", ",", "abc", "abcd.", "日本", "x1."]
    lines = [[rng.choice(pool if rng.random() < 0.5 else pool[12:]) for _ in range(rng.randrange(1, 30))] for _ in range(1500)]
    lengths = np.array([len(x) for x in lines])
    words = [w for line in lines for w in line]
    scores = model.emission[_featured(words, lengths, Remembered(_shape))].sum(axis=1)
    want = crf.viterbi(scores, lengths, model.transition, model.start)
    decoder = Decoder(model)
    assert np.array_equal(decoder.labels([w.encode() for w in words], lengths), want)
    assert len(set(want.tolist())) > 4


def test_copies_do_not_change_the_model(make_docs):
    texts = labelled_texts(random.Random(8), 3)
    few, many = fit(make_docs(texts * 3)), fit(make_docs(texts * 900))
    assert np.array_equal(few.emission, many.emission) and np.abs(few.emission).max() > 0.2


def test_base_spans_stay(make_docs, model, edge_docs, edge_rows, no_docs):
    texts = labelled_texts(random.Random(6), 40) + [None, ""]
    for r in personal_data(make_docs(texts), model).collect():
        base = base_spans(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
    rows = personal_data(edge_docs).collect()
    assert len(rows) == len(edge_rows) and {r.n_email for r in rows if r.doc_id == 108} == {1}
    assert personal_data(no_docs).count() == 0


def test_levels_are_never_too_low():
    rng = np.random.default_rng(3)
    grams = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2))
    counts = rng.geometric(0.2, len(grams)) ** 3
    parts = {}
    owner = logbloom.slice_of(grams, 4)
    for k in range(4):
        parts[k] = logbloom.build(grams[owner == k], counts[owner == k])
    whole = logbloom.Filter(4, parts)
    levels = whole.levels(grams).astype(int)
    exact = logbloom.levels_of(counts)
    assert (levels >= exact).all() and (levels > exact).mean() < 0.05
    strange = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    assert (whole.levels(strange) > 0).mean() < 0.05
    assert (np.abs(logbloom.count_of(exact) / counts - 1) < 0.25).all()
    small = np.arange(1, 4)
    assert np.array_equal(logbloom.count_of(logbloom.levels_of(small)), small)
    every = np.arange(1, 5_000)
    level, middle = logbloom.levels_of(every), logbloom.count_of(logbloom.levels_of(every))
    for k in range(1, int(level[-1])):
        own = every[level == k]
        assert own[0] <= middle[level == k][0] <= own.mean() and middle[level == k][0] == pytest.approx(len(own) / (1 / own).sum(), rel=0.01)


LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def test_base_scores_are_exact(edge_docs, edge_rows, no_docs):
    texts = [((str(d) if d is not None else ""), [*(t or "").encode().translate(LOWER).split(), None]) for d, t, *_ in edge_rows]
    counts = Counter()
    for d, words in texts:
        if zlib.crc32(d.encode()) % 10:
            counts.update(words)
    n, v = sum(counts.values()), len(counts)
    want = Counter()
    for d, words in texts:
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words)
        want[d, zlib.crc32(d.encode()) % 10 == 0, len(words), sum(counts[w] > 0 for w in words), n, round(base, 4)] += 1
    rows = scored(edge_docs).collect()
    got = Counter(
        ("" if r.doc_id is None else str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4))
        for r in rows
    )
    assert got == want
    assert scored(no_docs).count() == 0


def test_scores_are_those_of_exact_pair_counts(make_docs):
    """With a filter so large that no probe hits by chance, against counts in a dictionary; and p(. | v) adds up to one."""
    rng = random.Random(14)
    texts = [" ".join(rng.choices([f"W{i}" for i in range(40)], weights=[1 / (i + 1) for i in range(40)], k=rng.randrange(0, 90))) for _ in range(150)]
    words, pairs = Counter(), Counter()
    lines = {i: [*t.lower().split(), None] for i, t in enumerate(texts)}
    for i, line in lines.items():
        if zlib.crc32(str(i).encode()) % 10:
            words.update(line)
            pairs.update(zip([None, *line[:-1]], line, strict=True))
    n, v = sum(words.values()), len(words)

    def p(word, before):
        c = pairs[before, word]
        seen = min(float(logbloom.count_of(logbloom.levels_of(np.array([c])))[0]) if c else 0.0, words[before], words[word])
        trust = words[before] / (words[before] + 5)
        return trust * seen / max(words[before], 1) + (1 - trust) * (words[word] + 0.1) / (n + 0.1 * (v + 1))

    want = {i: sum(math.log10(p(w, b)) for b, w in zip([None, *line[:-1]], line, strict=True)) for i, line in lines.items()}
    got = {r.doc_id: r.score for r in scored(make_docs(texts), tokens_per_slice=1_000, bits_per_entry=2_000).collect()}
    assert got.keys() == want.keys() and max(abs(got[i] - want[i]) for i in want) < 1e-6
    sums = [sum(p(w, b) for w in words) for b in words]
    # Quantised counts miss a single context by a few hundredths, and hardly all together.
    assert max(abs(s - 1) for s in sums) < 0.1 and abs(sum(sums) / len(sums) - 1) < 0.02, sums


def test_rounds_do_not_change_scores(make_docs):
    rng = random.Random(12)
    docs = make_docs([prose(rng, 200) for _ in range(80)])
    one = {r.doc_id: r for r in scored(docs, tokens_per_slice=2_000).collect()}
    many = {r.doc_id: r for r in scored(docs, tokens_per_slice=2_000, broadcast_bytes=10_000).collect()}
    assert one == many


def test_the_model_beats_the_base_on_held_out_texts(make_docs):
    rng = random.Random(13)
    chains = {w: [f"w{rng.randrange(300)}" for _ in range(3)] for w in (f"w{i}" for i in range(300))}
    texts = []
    for _ in range(400):
        words = ["w0"]
        while len(words) < 60:
            words.append(rng.choice(chains[words[-1]]))
        texts.append(" ".join(words))
    rows = [r for r in scored(make_docs(texts)).collect() if r.held_out]
    assert len(rows) > 20 and sum(r.score for r in rows) > 0.6 * sum(r.base_score for r in rows)
