"""Spelling variants: words that differ by one code point, by a dictionary of trie-node pairs.

The vocabulary is put into two tries, one of the words and one of the words backwards, whose nodes are numbered. A word
with position i left out is the pair (node of the first i letters, backward node of what follows i); a word with nothing
left out is the pair of nodes at each cut. Equal pairs are equal letters, so:

* two words with an equal left-out pair differ by one replaced letter, in that place;
* a word whose left-out pair is another word's cut pair has one letter more.

The tries are never held as a whole. Words are range-partitioned in sorted order; a task numbers the nodes it meets along
its run of words, with a stack of one path. Nodes that reach over the edge of a task are on the last path of one and the first path
of the next: these two paths per task are compared, and the later numbers replaced. A pair's group has at most one cut
and as many left-out words as the alphabet has letters, so groups are bounded whatever the vocabulary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from plumbline.llm.common import column_of, scratch, text_or_empty, unpacked

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
LEAST_LETTERS = 5
LEAST_COUNT = 3
#: One of so many (document, run) pairs loses a letter.
DELETE_OF = 97
#: A form has at least so many times the count of the word.
FORM_RATIO = 2
#: Words whose nodes are expanded at a time, by their letters.
LETTERS_AT_ONCE = 100_000

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: the runs of letters of all texts, some with a letter deleted, long and frequent enough to be words."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_id"),
        F.explode(F.regexp_extract_all(text_or_empty(), F.lit(RUN), F.lit(0))).alias("_run"),
    ).filter(F.length("_run") >= LEAST_LETTERS)
    runs = runs.select("_id", F.translate("_run", _UPPER, _UPPER.lower()).alias("_run"))
    hashed = runs.withColumn("_h", F.crc32(F.concat("_id", F.lit(":"), "_run").cast("binary")))
    at = (F.col("_h") % F.length("_run")).cast("int")
    cut = F.concat(F.substr("_run", F.lit(1), at), F.substr("_run", at + 2))
    words = hashed.select(F.when(F.col("_h") % DELETE_OF == 0, cut).otherwise(F.col("_run")).alias("word"))
    counted = words.filter(F.length("word") >= LEAST_LETTERS).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= LEAST_COUNT)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    for i in range(n):
        if a[i] != b[i]:
            return i
    return n


def _numbered(words: DataFrame, spelled: str, nodes: str, work, number_words: bool = False) -> DataFrame:
    """``words`` with ``nodes``, the packed numbers of the trie nodes along ``spelled``, the root first; a part's numbers are its own.

    With ``number_words`` also ``id``, ascending in the order of ``spelled``.
    """
    extra = ", id long" if number_words else ""
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in words.schema) + f", {nodes} binary, _part int{extra}"

    def number(batches):
        part = TaskContext.get().partitionId()
        first = part << 33
        fresh, at = first + 1, first
        path, last = [first], ""
        for batch in batches:
            found = []
            for word in column_of(batch, spelled).to_pylist():
                del path[_common(last, word) + 1 :]
                more = len(word) + 1 - len(path)
                path.extend(range(fresh, fresh + more))
                fresh += more
                last = word
                found.append(np.array(path, dtype="<i8").tobytes())
            n = batch.num_rows
            arrays = [*batch.columns, pa.array(found, pa.binary()), pa.array(np.full(n, part, np.int32))]
            if number_words:
                arrays.append(pa.array(np.arange(at, at + n)))
                at += n
            names = [*batch.schema.names, nodes, "_part", *(["id"] if number_words else [])]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    in_order = words.repartitionByRange(spelled).sortWithinPartitions(spelled)
    return work.stage(in_order.mapInArrow(number, schema), nodes)


def _shared(numbered: DataFrame, spelled: str, nodes: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that a later part gave to nodes of earlier parts, and the earlier numbers; from two paths of each part."""
    pair = F.struct(spelled, nodes)
    edges = numbered.groupBy("_part").agg(F.min_by(pair, spelled).alias("first"), F.max_by(pair, spelled).alias("last"))
    last, path, known = "", [0], {}
    for r in sorted(edges.collect(), key=lambda r: r["_part"]):
        own = np.frombuffer(r["first"][nodes], "<i8").tolist()
        same = _common(last, r["first"][spelled]) + 1
        known |= dict(zip(own[:same], path, strict=False))
        last = r["last"][spelled]
        path = [known.get(x, x) for x in np.frombuffer(r["last"][nodes], "<i8").tolist()]
    late = np.array(sorted(known), dtype=np.int64)
    return late, np.array([known[x] for x in late.tolist()], dtype=np.int64)


def _replaced(values: np.ndarray, shared: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    late, early = shared
    if not len(late):
        return values
    at = np.minimum(np.searchsorted(late, values), len(late) - 1)
    return np.where(late[at] == values, early[at], values)


def node_pairs(words: DataFrame, work) -> tuple[DataFrame, DataFrame]:
    """The vocabulary with ids in the order of code points, and ``prefix, suffix, skip, ends, id, n``: its node pairs.

    ``skip`` tells left-out pairs from cuts; ``ends`` is false where the next letter equals the one left out, so that
    of the pairs that leave the same letters only one has it.
    """
    spark = words.sparkSession
    forward = _numbered(words, "word", "forward", work, number_words=True)
    vocabulary = forward.select("id", "word", "n")
    backward = _numbered(
        forward.select("id", "n", "word", "forward", F.reverse("word").alias("back")), "back", "backward", work
    )
    shared = spark.sparkContext.broadcast((_shared(forward, "word", "forward"), _shared(backward, "back", "backward")))

    def expand(batches):
        for_forward, for_backward = shared.value
        for batch in batches:
            spelled = column_of(batch, "word").to_pylist()
            sizes = np.cumsum([len(w) for w in spelled]) // LETTERS_AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                some = batch.slice(a, b - a)
                heads, lengths = unpacked(column_of(some, "forward"), "<i8")
                tails, _ = unpacked(column_of(some, "backward"), "<i8")
                heads, tails = _replaced(heads, for_forward), _replaced(tails, for_backward)
                ends = np.cumsum(lengths)
                begins = ends - lengths
                word = np.repeat(np.arange(len(lengths)), lengths)
                place = np.arange(len(heads)) - begins[word]
                # The letters before the cut and those after it: together all of the word.
                opposite = tails[ends[word] - 1 - place]
                skips = np.flatnonzero(place < lengths[word] - 1)
                letters = np.array([ord(c) for w in spelled[a:b] for c in w + "\0"], dtype=np.int64)
                ids = column_of(some, "id").to_numpy()
                counts = column_of(some, "n").to_numpy()
                # Left out: the letters before the place, and those after the next cut.
                columns = [
                    np.concatenate([heads, heads[skips]]),
                    np.concatenate([opposite, opposite[skips + 1]]),
                    np.repeat([False, True], [len(heads), len(skips)]),
                    np.concatenate([np.zeros(len(heads), bool), letters[skips] != letters[skips + 1]]),
                    np.concatenate([ids[word], ids[word[skips]]]),
                    np.concatenate([counts[word], counts[word[skips]]]),
                ]
                names = ["prefix", "suffix", "skip", "ends", "id", "n"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = "prefix long, suffix long, skip boolean, ends boolean, id long, n long"
    return vocabulary, backward.select("id", "n", "word", "forward", "backward").mapInArrow(expand, schema)


def neighbours(pairs: DataFrame) -> DataFrame:
    """``id, n_near`` and ``best``, the count and negative id of the near word with the largest count, of words that have any."""
    group = Window.partitionBy("prefix", "suffix")
    own = F.struct(F.col("n").alias("n"), (-F.col("id")).alias("other"))
    skips, ends, cuts = F.col("skip"), F.col("skip") & F.col("ends"), ~F.col("skip")

    def top(which):
        return F.max(F.when(which, own)).over(group)

    met = pairs.withColumns(
        {
            "_skips": F.count(F.when(skips, 1)).over(group),
            "_ends": F.count(F.when(ends, 1)).over(group),
            "_top": top(skips),
            "_longest": top(ends),
            "_cut": top(cuts),
        }
    ).filter("_skips > 1 OR (_ends > 0 AND _cut IS NOT NULL)")
    shorter = ends & F.col("_cut").isNotNull()
    replaced = F.when(F.col("_top.other") != -F.col("id"), F.col("_top"))
    return (
        met.select(
            "id",
            F.when(skips, F.col("_skips") - 1 + shorter.cast("long")).otherwise(F.col("_ends")).alias("_near"),
            F.when(skips, F.greatest(replaced, F.when(shorter, F.col("_cut")))).otherwise(F.col("_longest")).alias("_best"),
        )
        .groupBy("id")
        .agg(F.sum("_near").alias("n_near"), F.max("_best").alias("best"))
        .filter("n_near > 0")
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word: see :func:`word_counts` and :func:`neighbours`.

    ``form`` is the near word of the largest count (of equal counts the first in code-point order), if that is at least
    FORM_RATIO times the word's own; counts grow along forms, so ``root`` ends after at most log2 of the largest
    count, and its pointers are doubled. A null text has no words; a null id counts as an empty one; repeated rows count
    each; an empty table gives an empty result; other columns are ignored; words may be of any length.
    """
    work = scratch(docs.sparkSession)
    words = work.stage(word_counts(docs), "words")
    vocabulary, pairs = node_pairs(words, work)
    near = work.stage(neighbours(pairs), "near")
    forms = vocabulary.join(near, "id").filter(F.col("best.n") >= FORM_RATIO * F.col("n"))
    links = work.stage(forms.select("id", (-F.col("best.other")).alias("form_id")), "links")
    roots = links.select("id", F.col("form_id").alias("root_id"))
    most = words.agg(F.coalesce(F.max("n"), F.lit(1))).first()[0]
    reach = 1
    while FORM_RATIO**reach <= most:
        ahead = roots.select(F.col("id").alias("root_id"), F.col("root_id").alias("_next"))
        roots = roots.join(ahead, "root_id", "left").select("id", F.coalesce("_next", "root_id").alias("root_id"))
        roots = work.stage(roots, "roots")
        reach *= 2
    linked = links.join(roots, "id")
    for kind in ("form", "root"):
        named = vocabulary.select(F.col("id").alias(f"{kind}_id"), F.col("word").alias(kind), F.col("n").alias(f"{kind}_n"))
        linked = linked.join(named, f"{kind}_id")
    return (
        vocabulary.join(linked.select("id", "form", "root", "form_n"), "id", "left")
        .join(near.select("id", "n_near"), "id", "left")
        .select(
            "word",
            "form",
            F.coalesce("root", "word").alias("root"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            "form_n",
        )
    )
