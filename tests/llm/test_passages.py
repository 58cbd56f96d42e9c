"""Decontamination and substring deduplication against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from plumbline.llm import substrings
from plumbline.llm.automaton import ItemAutomaton
from plumbline.llm.decontamination import contamination, decontaminated, find_hits, folded_words
from plumbline.llm.substrings import without_repeats

from .conftest import prose


def brute_hits(words, items, width):
    hit, names = set(), set()
    for name, item in items.items():
        n = min(width, len(item))
        for k in range(len(item) - n + 1 if n else 0):
            for i in range(len(words) - n + 1):
                if words[i : i + n] == item[k : k + n]:
                    hit |= set(range(i, i + n))
                    names.add(name)
    return hit, names


def test_automaton_finds_every_window():
    rng = random.Random(5)
    for _ in range(600):
        width, letters = rng.choice([1, 2, 3, 4]), rng.choice([2, 3, 5])
        draw = lambda n, k: [b"%d" % rng.randrange(k) for _ in range(n)]
        items = {str(i): draw(rng.randrange(9), letters) for i in range(rng.randrange(5))}
        words = draw(rng.randrange(30), letters + 1)
        spans, names = find_hits(words, ItemAutomaton(items, width))
        assert ({i for a, b in spans for i in range(a, b)}, names) == brute_hits(words, items, width)


ITEMS = [(7, "The quick  brown-fox jumps over the lazy dog near river bank today"), (10, "alpha BETA"), (3, None), (4, "!!")]


@pytest.mark.parametrize("limit", [200_000, 1])
def test_hits_of_edge_rows(edge_docs, edge_rows, bench_items, make_docs, limit):
    texts = ["x " + ITEMS[0][1].upper() + " y", "alpha, beta; gamma alpha beta", "the quick brown fox jumps over the lazy dog", None, ""]
    items = {str(i): folded_words((t or "").encode()) for i, t in ITEMS}
    got = contamination(make_docs(texts), bench_items(ITEMS), words_per_automaton=limit)
    for r in got.collect():
        words = folded_words((texts[r.doc_id] or "").encode())
        hit, names = brute_hits(words, items, 10)
        assert (r.n_words, r.n_hit, r.items) == (len(words), len(hit), sorted(names))
    assert contamination(edge_docs, bench_items(ITEMS)).count() == len(edge_rows)
    assert contamination(edge_docs, bench_items([])).filter("contaminated").isEmpty()


def test_passages_are_cut_and_others_stay(make_docs, bench_items, edge_docs, no_docs, edge_rows):
    passage = ITEMS[0][1]
    texts = [f"Before it. I A B {passage}! X Y After it.", passage, "alpha beta is here, among very many other words of a text", "clean text", None]
    out = {r.doc_id: r for r in decontaminated(make_docs(texts), bench_items(ITEMS)).collect()}
    assert set(out) == {0, 2, 3, 4}
    assert "brown" not in out[0].text and out[0].text == "Before it. I A B \n! X Y After it."
    assert out[0].n_chars == len(out[0].text)
    assert [out[i].text for i in (2, 3, 4)] == [texts[i] for i in (2, 3, 4)]
    clean = decontaminated(edge_docs, bench_items(ITEMS))
    assert clean.columns == edge_docs.columns and clean.count() == len(edge_rows)
    assert clean.exceptAll(edge_docs).isEmpty()
    assert decontaminated(no_docs, bench_items(ITEMS)).count() == 0


def test_items_without_an_id_and_short_items(make_docs, bench_items, spark):
    """An item without an id is an item; whole short items are cut; cuts go on until none is left."""
    twelve = "this passage of twelve words belongs to an item without any id"
    short = "what is the capital of france"
    nested = "one two three four five six seven eight nine ten"
    # Inside each cut another passage has been hidden, five times over.
    hidden = nested
    for _ in range(5):
        hidden = f"{' '.join(nested.split()[:5])} {hidden} {' '.join(nested.split()[5:])}"
    items = bench_items([(None, twelve), (None, None), (7, short), (8, nested), (None, short + " please tell me")])
    texts = [f"it says {twelve} here", f"Tell me: What is the capital of France? " + "other words " * 20, f"a {hidden} b", "clean", None, ""]
    docs = make_docs(texts)
    found = {r.doc_id: r for r in contamination(docs, items).collect()}
    assert (found[0].n_hit, found[0].n_items, found[0]["items"]) == (12, 1, [None])
    assert (found[1].n_hit, found[1]["items"]) == (6, ["7"])
    assert not found[3].contaminated and not found[4].contaminated
    left = {r.doc_id: r.text for r in decontaminated(docs, items).collect()}
    assert left.keys() == set(range(6))
    assert "passage" not in left[0] and "capital" not in left[1] and "other words" in left[1]
    assert left[2].split() == ["a", "b"] and (left[3], left[4], left[5]) == ("clean", None, "")
    none = spark.createDataFrame([], "item_id long, text string")
    assert {r.doc_id: r.text for r in decontaminated(docs, none).collect()} == dict(enumerate(texts))
    assert contamination(docs, none).filter("contaminated").isEmpty()
    assert decontaminated(docs.filter("false"), items).isEmpty()


def brute_repeats(rows, width):
    first = {}
    texts = [(d, (t or "").encode().split()) for d, t, *_ in rows]
    for d, w in texts:
        for i in range(len(w) - width + 1 if d is not None else 0):
            key = tuple(w[i : i + width])
            first[key] = min(d, first.get(key, d))
    out = []
    for d, w in texts:
        gone = set()
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i : i + width])] < d:
                gone |= set(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((-1 if d is None else d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got_repeats(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in (tuple(x)[:4] for x in df.collect()))


@pytest.mark.parametrize("sketch_bytes", [1 << 20, 0])
def test_repeats_are_those_of_brute_force(make_docs, sketch_bytes):
    rng = random.Random(3)
    blocks = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 14))] for _ in range(12)]
    texts = [" ".join(x for _ in range(rng.randrange(0, 9)) for x in rng.choice(blocks)) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    for width in (1, 3, 8, 12):
        got = without_repeats(make_docs(texts), width=width, anchor=4, sketch_bytes=sketch_bytes)
        assert got_repeats(got) == brute_repeats(rows, width)


def test_repeats_of_edge_rows(edge_docs, edge_rows, no_docs):
    got = without_repeats(edge_docs, width=10)
    assert got_repeats(got) == brute_repeats(edge_rows, 10)
    kept = {r.doc_id: r.kept_text for r in got.collect()}
    assert kept[106] == "one two" and kept[101] == ""
    assert without_repeats(no_docs).count() == 0


def test_a_short_line_in_many_documents_is_no_large_group(make_docs, monkeypatch):
    """A line between other words each time: its anchor has many different windows, which must not meet in one row."""
    rng = random.Random(9)
    line = " ".join(f"licence{i}" for i in range(49))
    texts = [f"{prose(rng, 60, 5_000)} {line} {prose(rng, 60, 5_000)}" for _ in range(300)]
    texts = [t for t in texts for _ in range(2)]
    longest = []
    first_documents = substrings.first_documents

    def watched(runs):
        firsts = first_documents(runs)
        longest.append(firsts.selectExpr("max(octet_length(windows)) DIV 8").first()[0])
        return firsts

    monkeypatch.setattr(substrings, "first_documents", watched)
    got = got_repeats(without_repeats(make_docs(texts)))
    assert got == brute_repeats(list(enumerate(texts)), 50)
    assert longest[0] < 3 * 512
