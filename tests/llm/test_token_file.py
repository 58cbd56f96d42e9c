from __future__ import annotations

import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from plumbline.llm import rans
from plumbline.llm.common import tokenizer_path
from plumbline.llm.encoding import encoder
from plumbline.llm.lengths import at_limits, length_histogram, quantiles
from plumbline.llm.token_file import read_tokens, write_tokens

TRICKY = [
    "<|endoftext|> İstanbul ΣΑΣ’s it's DON'T áb <|ENDOFTEXT|> x<|startoftext|>y 12,345. foo., q r",
    "Å ŉx ſt ªº µm ß. É, Ǆ ﬁ. it's. 's 're. ...,, a.b.c \x0b\x1c\x85 x y 日本語. \U0001F600",
    "",
    " ",
]


def whole(text):
    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids


def test_pieces_have_the_ids_of_whole_texts():
    tokens = encoder(tokenizer_path())
    assert tokens.by_piece
    for text in TRICKY:
        assert np.frombuffer(tokens.ids([text.encode()])[0], tokens.dtype).tolist() == whole(text)
        assert tokens.counts([text.encode(), b"x"]) == [len(whole(text)), 1]


@pytest.mark.parametrize("alphabet", [1, 2, 300, 70_000])
def test_blocks_round_trip(alphabet):
    rng = np.random.default_rng(alphabet)
    sizes = [0, 1, 31, 32, 33, 8191, 8192, 8193, 40_000]
    blocks = [np.minimum(rng.geometric(0.01, n) * 7, alphabet * 7) for n in sizes]
    symbols, counts = np.unique(np.concatenate(blocks), return_counts=True)
    table = rans.Table.of_counts(symbols, counts)
    assert table.freqs.sum() == 1 << table.scale and table.freqs.min() >= 1
    coded = rans.encode(blocks, table)
    for got, want in zip(rans.decode(coded, table), blocks, strict=True):
        assert np.array_equal(got, want)
    # Any single block decodes by itself.
    assert np.array_equal(rans.decode([coded[-1]], table)[0], blocks[-1])


def test_a_flipped_word_is_noticed():
    block = np.random.default_rng(0).integers(0, 50, 5000)
    table = rans.Table.of_counts(*np.unique(block, return_counts=True))
    coded = rans.encode([block], table)[0]
    coded.words[len(coded.words) // 2] ^= 64
    with pytest.raises(ValueError, match="checksum"):
        rans.decode([coded], table)


def damaged(block, what):
    from dataclasses import replace

    changed = {f: getattr(block, f).copy() for f in ("states", "offsets", "words")}
    if what == "state":
        changed["states"][1, 3] ^= np.uint64(1 << 20)
    elif what == "state out of range":
        changed["states"][0, 0] = 1
    elif what == "offset":
        changed["offsets"][1] += 7
    elif what == "offset outside":
        changed["offsets"][1] = 1 << 40
    elif what == "truncated":
        changed["words"] = changed["words"][:-9]
    elif what == "fewer segments":
        changed["states"], changed["offsets"] = changed["states"][:-1], changed["offsets"][:-1]
    more = {"more tokens": {"n_tokens": block.n_tokens + 5}, "many more tokens": {"n_tokens": 1 << 40}, "crc": {"crc32": 7}}
    return replace(block, **changed, **more.get(what, {"n_tokens": -1} if what == "negative" else {}))


@pytest.mark.parametrize(
    "what",
    ["state", "state out of range", "offset", "offset outside", "truncated", "fewer segments", "more tokens", "many more tokens", "crc", "negative"],
)
def test_any_damage_is_a_checksum_error(what):
    rng = np.random.default_rng(4)
    blocks = [rng.integers(0, 3000, n) for n in (30_000, 20_000)]
    table = rans.Table.of_counts(*np.unique(np.concatenate(blocks), return_counts=True))
    first, second = rans.encode(blocks, table)
    with pytest.raises(ValueError, match="checksum"):
        rans.decode([damaged(first, what), second], table)
    with pytest.raises(ValueError, match="checksum"):
        rans.decode([first, damaged(second, what)], table)


def test_every_flipped_word_is_noticed():
    block = np.random.default_rng(0).integers(0, 50, 3000)
    table = rans.Table.of_counts(*np.unique(block, return_counts=True))
    coded = rans.encode([block], table)[0]
    for i in range(0, len(coded.words), 7):
        coded.words[i] ^= 1 << (i % 32)
        with pytest.raises(ValueError, match="checksum"):
            rans.decode([coded], table)
        coded.words[i] ^= 1 << (i % 32)


def test_more_symbols_than_the_least_scale():
    symbols = np.arange(100_000)
    table = rans.Table.of_counts(symbols, np.ones(100_000))
    assert table.freqs.sum() == 1 << table.scale
    assert np.array_equal(rans.decode(rans.encode([symbols], table), table)[0], symbols)


def expected(rows):
    out, start = [], 0
    keyed = [(d is not None, d or 0, np.array([*whole(t), 1], "<u2").tobytes()) for d, t, *_ in rows]
    for known, doc_id, ids in sorted(keyed):
        wide = np.frombuffer(ids, "<u2").astype("<u4")
        out.append((doc_id if known else None, start, len(wide), zlib.crc32(wide.tobytes())))
        start += len(wide)
    return out


def test_file_returns_what_was_encoded(spark, workspace, edge_docs, edge_rows):
    folder = workspace.path("tokens")
    write_tokens(edge_docs, folder, tokenizer_path(), shard_tokens=20_000)
    got = read_tokens(spark, folder)
    rows = sorted(tuple(r) for r in got.drop("ids").collect() if r.doc_id is not None)
    want = expected(edge_rows)
    assert rows == sorted(w for w in want if w[0] is not None)
    assert got.count() == len(want)
    assert {r.doc_id: bytes(r.ids) for r in got.filter("doc_id = 106").collect()} == {
        106: np.array([*whole("one two"), 1], "<u4").tobytes()
    }
    assert spark.read.parquet(folder + "/blocks").select("shard").distinct().count() > 1


def test_empty_table_makes_an_empty_file(spark, workspace, no_docs):
    folder = workspace.path("tokens")
    write_tokens(no_docs, folder, tokenizer_path())
    assert read_tokens(spark, folder, digest_only=True).count() == 0


def test_histogram_answers_every_limit(edge_docs, edge_rows, no_docs):
    rows = [r.asDict() for r in length_histogram(edge_docs, tokenizer_path()).collect()]
    groups = {}
    for _, text, lang, source, _ in edge_rows:
        groups.setdefault((lang, source), []).append(len(whole(text)))
    assert {(r["lang"], r["source"]) for r in rows} == set(groups)
    for r in rows:
        lengths, n = groups[r["lang"], r["source"]], r["n_tokens"]
        assert r["n_docs"] == lengths.count(n)
        assert r["docs_longer"] == sum(x > n for x in lengths)
        assert r["group_tokens"] == sum(lengths)
        assert r["truncated_tokens"] == sum(min(x, n) for x in lengths)
    histogram = length_histogram(edge_docs, tokenizer_path())
    for r in at_limits(histogram, ["lang", "source"], [0, 50, 10**6]).collect():
        lengths = groups[r.lang, r.source]
        assert r.truncated_tokens == sum(min(x, r.context_limit) for x in lengths)
        assert r.docs_within == sum(x <= r.context_limit for x in lengths)
    for r in quantiles(histogram, ["lang", "source"], [0.5, 1.0]).collect():
        lengths = sorted(groups[r.lang, r.source])
        assert r.n_tokens == lengths[int(np.ceil(r.share * len(lengths))) - 1]
    assert length_histogram(no_docs, tokenizer_path()).count() == 0


def test_ids_are_looked_up_in_the_frequency_table(monkeypatch):
    """op1: a place per id instead of a search of the table for each token; ids outside it are refused as before."""
    import numpy as np
    import pytest
    from plumbline.llm import rans

    def searched(*_):
        raise AssertionError("searched")

    monkeypatch.setattr(np, "searchsorted", searched)
    table = rans.Table.of_counts(np.array([7, 3, 900]), np.array([5, 1, 2]))
    blocks = [np.array([3, 900, 7, 7], np.uint16), np.zeros(0, np.uint16)]
    assert [x.tolist() for x in rans.decode(rans.encode(blocks, table), table)] == [[3, 900, 7, 7], []]
    for bad in (4, 901, -1):
        with pytest.raises(ValueError):
            rans.encode([np.array([3, bad])], table)


def test_python_meets_a_stem_once_and_its_occurrences_never(monkeypatch):
    """op1, op4: texts are cut and their pieces numbered by Arrow; the ids stay those of whole texts."""
    import random

    import pyarrow as pa
    from plumbline.llm.encoding import PieceEncoder

    tokens = PieceEncoder(tokenizer_path(), limit=50)
    # Every letter below U+0180 and some beyond, alone and inside words, before marks, in both cases, between all kinds of space.
    letters = [chr(c) for c in [*range(33, 0x180), 0x301, 0x345, 0x3A3, 0x1E9E, 0x212A, 0xFB01, 0x3000, 0x2028]]
    rng = random.Random(3)
    texts = [" ".join(x + y for x in letters for y in ("", "a", "?!", "\u0301"))]
    texts += ["".join(rng.choices([*letters, *" \t\n\x0b\x0c\r\x1f\xa0'sTd"], k=300)) for _ in range(60)]
    column = pa.array([None, "skipped", *TRICKY, None, "", *texts, "\n", None]).slice(2)
    column = pa.concat_arrays([pa.array(["x"]), column]).slice(1)
    ids, sizes = tokens.ids_of(column)
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [whole(t) for t in column.to_pylist()]
    assert tokens.counts_of(column).tolist() == sizes.tolist()
    assert [len(x) for x in tokens.ids_of(pa.array([], pa.string()))] == [0, 0] and tokens.ids([]) == []

    tokens, met = PieceEncoder(tokenizer_path()), []
    monkeypatch.setattr(tokens, "_merged", lambda stem, merged=tokens._merged: met.append(stem) or merged(stem))
    many = pa.array(["Stem, STEM. stem\u00e9 STEM\u00c9; stem 12"] * 500)
    ids, sizes = tokens.ids_of(many)
    assert sorted(met) == [b"stem", "stem\u00e9".encode()]
    assert np.array_equal(ids, np.tile(whole(many[0].as_py()), 500)) and len(set(sizes.tolist())) == 1
