"""Token ids of whole texts with a tokenizers file, one white-space piece at a time.

The tokenizer's rules never join text across white space, so the ids of a text are those of its pieces in order. Arrow cuts
the texts, numbers their distinct pieces and takes marks and capitals off those of plain letters, so Python meets each
lower-case stem once a batch and its occurrences never. Most stems recur, and a task remembers the ids of those it has seen
in a table of bounded size. A stem is one pre-token, so only the merges are left to do; any other piece is encoded by itself.
Whether a tokenizer file allows this is tested on its rules when it is loaded; if not, whole texts are encoded.
"""

from __future__ import annotations

import codecs
import json
import os
import re
import sys
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The piece rules under which white space always separates: nothing that matches spans it.
_SEPARATING = {"Split", "ByteLevel"}

#: Letters up to U+017F, without \u0130, have composed forms and lower cases of their own, whatever stands beside them.
_PLAIN_LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c != "\u0130")
#: Marks that no rule joins to the letters before them.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
_MARKS_REMEMBERED = 10_000
#: Stems and other pieces that are remembered.
REMEMBERED = 400_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Generations:
    """A map whose size stays bounded: full, it becomes the older map, in which frequent keys are found again."""

    def __init__(self):
        self.young: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    def turn(self) -> None:
        if self.young:
            self.young, self.older = {}, self.young

    def all_of(self, keys: list[bytes], encode: Callable[[bytes], bytes]) -> list[bytes]:
        """The values of the keys; ``encode`` makes those that are new."""
        young, older = self.young, self.older
        for key in keys:
            if key not in young:
                value = older.get(key)
                young[key] = encode(key) if value is None else value
        return list(map(young.__getitem__, keys))


def _values(column: pa.Array) -> list[bytes]:
    """The bytes of each string of a column without nulls, several times faster than ``to_pylist``."""
    _, offsets, data = column.buffers()
    if not len(column) or data is None:
        return [b""] * len(column)
    data, bounds = data.to_pybytes(), np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    return [data[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]


class PieceEncoder:
    """``ids(texts)`` as little-endian unsigned integers of ``dtype`` and ``counts(texts)`` of UTF-8 texts.

    ``ids_of`` and ``counts_of`` do the same for Arrow columns of strings, null being empty.
    """

    def __init__(self, path: str, limit: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # Ids are packed by the machine's byte order.
        assert sys.byteorder == "little"
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        rules = json.loads(self.tokenizer.to_str())
        self.specials = [t["content"].encode() for t in rules["added_tokens"]]
        self.by_piece = self._separates(rules)
        self.letters = "".join(_byte_letters())
        self.stems, self.pieces, self.limit = Generations(), Generations(), limit
        self.marks: dict[bytes, bytes] = {}

    def _separates(self, rules: dict) -> bool:
        """True if white space is dropped between pieces and lower case is the only rule that reaches over letters."""
        pre = rules.get("pre_tokenizer") or {}
        steps = pre.get("pretokenizers", [pre])
        normal = rules.get("normalizer") or {}
        kinds = [n["type"] for n in normal.get("normalizers", [normal]) if n]
        return (
            {s.get("type") for s in steps} == _SEPARATING
            and steps[0]["behavior"] == "Removed"
            and steps[0]["invert"]
            and "[^\\s" in steps[0]["pattern"].get("Regex", "")
            and not steps[1]["add_prefix_space"]
            and kinds == ["NFC", "Replace", "Lowercase"]
            and not any(re.search(rb"\s", t) for t in self.specials)
        )

    def _whole(self, text: bytes) -> bytes:
        return self._packed(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def _merged(self, stem: bytes) -> bytes:
        """The ids of a stem, given to the merges in the letters that stand for its bytes."""
        letters = codecs.charmap_decode(stem, "strict", self.letters)[0]
        return array("H" if self.dtype.itemsize == 2 else "I", [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _mark(self, mark: bytes) -> bytes:
        if mark not in self.marks:
            if len(self.marks) >= _MARKS_REMEMBERED:
                self.marks.clear()
            self.marks[mark] = self._whole(mark)
        return self.marks[mark]

    def _known(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The ids of each distinct piece, the piece at each place of the texts, and the first place of each text and the end.

        Marks after letters are a pre-token of their own.
        """
        if len(self.stems.young) + len(self.pieces.young) > self.limit:
            self.rest()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        places = split.values.dictionary_encode()
        words = places.dictionary
        plain = pc.match_substring_regex(pc.ascii_rtrim(words, _MARKS), f"\\A[{_PLAIN_LETTERS}]+\\z")
        lettered = words.filter(plain)
        stems = pc.utf8_lower(pc.ascii_rtrim(lettered, _MARKS)).dictionary_encode()
        marks = pc.utf8_ltrim(lettered, _PLAIN_LETTERS).dictionary_encode()
        stem_ids = pa.array(self.stems.all_of(_values(stems.dictionary), self._merged), pa.binary()).take(stems.indices)
        mark_ids = pa.array([self._mark(x) for x in _values(marks.dictionary)], pa.binary()).take(marks.indices)
        others = pa.array(self.pieces.all_of(_values(words.filter(pc.invert(plain))), self._whole), pa.binary())
        joined = pc.binary_join_element_wise(stem_ids, mark_ids, pa.scalar(b"", pa.binary()))
        has = plain.to_numpy(zero_copy_only=False)
        order = np.where(has, np.cumsum(has), len(joined) + np.cumsum(~has)) - 1
        return pa.concat_arrays([joined, others]), order[places.indices.to_numpy()], split.offsets.to_numpy()

    def ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        if self.by_piece:
            known, places, first = self._known(texts)
            found = known.take(pa.array(places))
            bounds = np.frombuffer(found.buffers()[1], np.int32, len(found) + 1) if len(found) else np.zeros(1, np.int32)
            data = found.buffers()[2]
            ids = np.frombuffer(data, self.dtype, int(bounds[-1]) // self.dtype.itemsize) if data else np.zeros(0, self.dtype)
            return ids, np.diff(bounds[first].astype(np.int64)) // self.dtype.itemsize
        each = [self._whole(x) for x in pc.fill_null(texts, "").cast(pa.binary()).to_pylist()]
        sizes = np.fromiter(map(len, each), np.int64, len(each)) // self.dtype.itemsize
        return np.frombuffer(b"".join(each), self.dtype), sizes

    def counts_of(self, texts: pa.Array) -> np.ndarray:
        if self.by_piece:
            known, places, first = self._known(texts)
            sizes = pc.binary_length(known).to_numpy() // self.dtype.itemsize
            return np.diff(np.concatenate([[0], np.cumsum(sizes[places], dtype=np.int64)])[first])
        return self.ids_of(texts)[1]

    def ids(self, texts: list[bytes]) -> list[bytes]:
        ids, counts = self.ids_of(pa.array(texts, pa.binary()).cast(pa.string()))
        return [x.tobytes() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []

    def counts(self, texts: list[bytes]) -> list[int]:
        return self.counts_of(pa.array(texts, pa.binary()).cast(pa.string())).tolist()

    def rest(self) -> None:
        """At the end of a task: keep what was met last for the next one, and give the memory of the others back."""
        self.pieces.turn()
        self.stems.turn()


_loaded: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    """The encoder of a file, loaded once in a Python worker."""
    if path not in _loaded:
        _loaded[path] = PieceEncoder(path)
    return _loaded[path]
