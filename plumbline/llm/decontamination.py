"""Benchmark decontamination with a generalised suffix automaton of the normalised test items.

Texts and items are lower-cased (A-Z) and split into words of letters, digits and non-ASCII characters. Every text is
streamed through the automaton, which keeps the longest matching length; windows of ``width`` consecutive words of an
item (a shorter item is one window) that occur in the text are hits.

The automaton is broadcast. Its size is bounded: items beyond ``words_per_automaton`` words are dealt by hash to
several automata, and texts pass through one after the other in the same tasks, without a shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.automaton import ItemAutomaton
from plumbline.llm.common import column_of, pieces, row_and, texts_of
from plumbline.llm.substrings import merged_spans

WIDTH = 10
WORDS_PER_AUTOMATON = 200_000

#: Hit spans of at least so many words are cut out; shorter ones too where hits cover more than this share of a text.
SPAN_LIMIT = 10
COVERAGE_LIMIT = 0.2
#: The least words of a whole item that are cut out of a text, if the item has fewer than a window.
SHORT_ITEM = 5

#: ASCII characters that are no part of a word become blanks, A-Z become a-z.
_FOLD = bytes(
    (c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256)
)
_WORD = re.compile(rb"[^\x20]+")


_NO_ID = "-"


def folded_words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def find_hits(words: list[bytes], automaton: ItemAutomaton) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged hit spans and the items they belong to; only runs of words that items have are followed."""
    spans: list[tuple[int, int]] = []
    items: set[str] = set()
    if not automaton.least or len(words) < automaton.least:
        return spans, items
    get = automaton.words.get
    codes = np.fromiter((get(w, 0) for w in words), dtype=np.int32, count=len(words))
    edges = np.flatnonzero(np.diff(np.concatenate([[False], codes > 0, [False]]).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    long = ends - starts >= automaton.least
    for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
        automaton.follow(codes[a:b].tolist(), a, spans, items)
    return merged_spans(spans), items


def _automata(benchmark: DataFrame, width: int, limit: int) -> list:
    """Broadcast automata of at most about ``limit`` words; items without words have no windows."""
    spark = benchmark.sparkSession
    items = benchmark.select(
        F.col("item_id").cast("string").alias("item_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # A word and the character after it are two bytes at least; real text has about six.
    parts = max(1, -(-size // (6 * limit)))
    shared = []
    for part in range(parts):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        known: dict[str, list[bytes]] = {}
        for row in own.toLocalIterator():
            # Rows with the same id are items of their own that share it.
            name = _NO_ID if row["item_id"] is None else f"={row['item_id']}"
            known[f"{name}\0{len(known)}"] = folded_words(row["text"].encode())
        shared.append(spark.sparkContext.broadcast(ItemAutomaton(known, width)))
    return shared


def _item_id(name: str) -> str | None:
    known = name.rpartition("\0")[0]
    return None if known == _NO_ID else known[1:]


_FOUND = "_spans array<struct<a:int,b:int>>, _items array<string>, _n_words int"


def _matched(wanted: DataFrame, benchmark: DataFrame, width: int, limit: int) -> DataFrame:
    """``wanted``, of which one column is ``text``, and the hits of every row, from all automata."""
    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.schema.fields)
    span = pa.struct([("a", pa.int32()), ("b", pa.int32())])
    given = wanted.columns

    def matcher(shared, first):
        def match(batches):
            automaton = shared.value
            for piece in pieces(batches):
                n = piece.num_rows
                spans = [[]] * n if first else column_of(piece, "_spans").to_pylist()
                items = [[]] * n if first else column_of(piece, "_items").to_pylist()
                sizes = []
                for i, text in enumerate(texts_of(piece)):
                    words = folded_words(text)
                    sizes.append(len(words))
                    found, names = find_hits(words, automaton)
                    if found:
                        spans[i] = merged_spans([(s["a"], s["b"]) for s in spans[i]] + found)
                        spans[i] = [{"a": a, "b": b} for a, b in spans[i]]
                        items[i] = sorted({*items[i], *map(_item_id, names)}, key=lambda x: (x is None, x or ""))
                added = [pa.array(spans, pa.list_(span)), pa.array(items, pa.list_(pa.string())), pa.array(sizes, pa.int32())]
                names = [*given, "_spans", "_items", "_n_words"]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(given)], *added], names=names)

        return match

    out = wanted
    for i, shared in enumerate(_automata(benchmark, width, limit)):
        out = out.mapInArrow(matcher(shared, i == 0), f"{base}, {_FOUND}")
    return out


def contamination(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, words_per_automaton: int = WORDS_PER_AUTOMATON
) -> DataFrame:
    """Hits of every row: ``doc_id, n_words, n_hit, n_items, items`` (sorted as strings), ``spans`` (of word numbers),
    ``coverage`` and ``contaminated``. A null text has no words, of an item as of a document; texts may have any length. Items
    without an id are hit like others and count as one item, which is null and stands last in ``items``. Equal rows get equal
    results; an empty table gives an empty result, an empty benchmark hits nothing; other columns are ignored."""
    wanted = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = _matched(wanted, benchmark, width, words_per_automaton)
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]))
    return found.select(
        "doc_id",
        F.col("_n_words").cast("long").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.col("_items").alias("items"),
        F.col("_spans").alias("spans"),
        F.coalesce(hit / F.nullif("_n_words", F.lit(0)), F.lit(0.0)).alias("coverage"),
        (hit > 0).alias("contaminated"),
    )


def cut_text(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans; a line break stands where each was."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last : at[a][0]])
        last = at[b - 1][1]
    return b"\n".join([*out, text[last:]])


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    span_limit: int = SPAN_LIMIT,
    coverage_limit: float = COVERAGE_LIMIT,
    words_per_automaton: int = WORDS_PER_AUTOMATON,
) -> DataFrame:
    """``docs`` with its columns, hit spans cut out of ``text`` where they are too long or cover too much of it.

    Too long are ``span_limit`` words, and SHORT_ITEM words of an item that has no more than a window: such spans are whole items.
    A row of which no word is left is dropped; every other row stays, and texts without such spans are unchanged.
    ``n_chars``, if there is one, is that of the new text where it was cut. A text that was cut is searched again, since the words
    around a cut may meet in a window, until there is nothing left to cut. A null text stays; ids and other columns do not
    matter; empty tables give empty results.
    """
    n_chars = F.col("n_chars").cast("long") if "n_chars" in docs.columns else F.lit(None).cast("long")
    out = row_and(docs, F.col("text").cast("string").alias("text"), n_chars.alias("_n_chars"), without=("text",))
    shared = _automata(benchmark, width, words_per_automaton)

    def clean(text: str) -> str | None:
        """The text that is left, the same one if nothing is cut, none if no word is."""
        while True:
            words = folded_words(text.encode())
            spans = merged_spans(sorted(s for a in shared for s in find_hits(words, a.value)[0]))
            if sum(b - a for a, b in spans) <= coverage_limit * len(words):
                spans = [(a, b) for a, b in spans if b - a >= (span_limit if b - a >= width else min(span_limit, SHORT_ITEM))]
            if not spans:
                return text
            if sum(b - a for a, b in spans) == len(words):
                return None
            text = cut_text(text.encode(), spans).decode()

    def cut(batches):
        for piece in pieces(batches):
            texts = column_of(piece, "text").to_pylist()
            n_chars = column_of(piece, "_n_chars").to_pylist()
            stay = []
            for i, text in enumerate(texts):
                left = clean(text) if text else text
                stay.append(left is not None or text is None)
                if left != text:
                    texts[i], n_chars[i] = left, len(left or "")
            arrays = [column_of(piece, "_row"), pa.array(texts, pa.string()), pa.array(n_chars, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["_row", "text", "_n_chars"]).filter(pa.array(stay))

    out = out.mapInArrow(cut, out.schema)
    fresh = {"text": F.col("text"), "n_chars": F.col("_n_chars")}
    columns = [fresh.get(f.name, F.col("_row").getField(f.name)).cast(f.dataType).alias(f.name) for f in docs.schema]
    return out.select(*columns)

