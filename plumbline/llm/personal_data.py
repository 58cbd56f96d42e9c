"""Personal data: fixed base patterns, and a linear-chain conditional random field for what they miss.

The field labels white-space words by the shapes of a word and its neighbours. It is trained on a small labelled table:
SAMPLE_ROWS documents whose words are labelled by the base patterns, once as they are and once with the marks that the
patterns hinge on taken away or replaced (``name at host dot org``, a number without its plus), so that it learns how such
data look rather than one spelling. Its spans are added to the base spans, which stay.

Decoding is Viterbi over all lines of a piece of documents at a time, whatever signs they have. What a word adds to the scores
of its own place and of its neighbours' places is kept per distinct shape. A line is cut at the words that are surely
outside, where no label could make up for what it loses, whatever stands around: the best labels are the same.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm import crf
from plumbline.llm.common import Remembered, column_of, pieces, texts_of

KINDS = ["email", "ip", "card", "phone"]

#: The base patterns, leftmost and non-overlapping for each kind. Possessive parts match the same and never go back over a
#: long run of digits; an address is found from its at sign, since what stands before it has none.
PATTERNS = {
    "ip": re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
#: Rows of the labelled table and the size of each, at most: the bound of what the model is fitted on.
SAMPLE_ROWS = 400
SAMPLE_BYTES = 20_000
SEED = 31
#: Lines without data that a text gives to the labelled table, at most.
PLAIN_LINES = 20
#: Words that are decoded together, at least, and distinct words that a task remembers.
WORDS_AT_ONCE = 60_000
REMEMBERED = 150_000

LABELS = ["O", *[f"{p}-{k}" for k in KINDS for p in "BI"]]
_BUCKETS = 1 << 12
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(\.[A-Za-z0-9-]++)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def addresses(text: str) -> list[tuple[int, int]]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``."""
    out, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            last = found.end()
            out.append((start, last))
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def _holds(kind: str, found: str) -> bool:
    if kind == "ip":
        parts = [p.lstrip("0") for p in found.split(".")]
        return all(len(p) <= 3 and int(p or "0") <= 255 for p in parts)
    digits = "".join(c for c in found if "0" <= c <= "9")
    return 16 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 8 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the patterns that hold, by kind and start, in code points."""
    out = [("email", a, b) for a, b in addresses(text)]
    for kind in KINDS[1:]:
        for m in PATTERNS[kind].finditer(text):
            if _holds(kind, m.group()):
                out.append((kind, m.start(), m.end()))
    return out


_DIGIT = re.compile(r"[0-9]")


_bucket_of: dict[str, int] = {}


def _bucket(name: str) -> int:
    found = _bucket_of.get(name)
    if found is None:
        if len(_bucket_of) > 100_000:
            _bucket_of.clear()
        found = int.from_bytes(hashlib.blake2b(name.encode(), digest_size=4).digest(), "little") % _BUCKETS
        _bucket_of[name] = found
    return found


def _shape(word: str) -> tuple[int, int, int, int, int]:
    """Buckets of a word: its shape, digits, marks, spelling if short, and size with the check digit of a long number."""
    signal = word.lower() if len(word) <= 3 and word.isascii() else ""
    size = min(len(word), 30) // 3
    if word.isalpha():
        return _bucket("sa"), _bucket("d0"), _bucket("m"), _bucket("w" + signal), _bucket(f"l{size}True")
    shape = re.sub(r"[A-Za-z\u0080-\U0010FFFF]+", "a", re.sub(r"[0-9]+", lambda m: "9" * min(4, len(m.group())), word))
    digits = len(_DIGIT.findall(word))
    marks = "".join(sorted({c for c in word if not c.isalnum()}))
    plain = not digits and not marks
    check = luhn("".join(_DIGIT.findall(word))) if 12 <= digits <= 19 else ""
    names = ("s" + shape[:12], f"d{min(digits, 20)}", "m" + marks[:6], "w" + signal, f"l{size}{plain}{check}")
    return tuple(map(_bucket, names))


def _signature(word: bytes) -> tuple:
    """Words of one signature have one shape: letters alone, or with a full stop or comma, by size and spelling; else the shape itself."""
    mark = word[-1:] if word[-1:] in (b".", b",") else b""
    if (word[:-1] if mark else word).isalpha():
        size = len(word)
        return mark, min(size, 30) // 3, word.lower() if size <= 3 else b""
    text = word.decode()
    if (text[:-1] if mark else text).isalpha():
        return mark, min(len(text), 30) // 3, b""
    return _shape(text)


#: Of a neighbour, the line's features are its shape, digits and short spelling.
_SEEN_BESIDE = (0, 1, 3)


def _featured(words: list[str], lengths: np.ndarray, shapes: Remembered) -> np.ndarray:
    """Own features of every word, and shape, digits and short spelling of its neighbours in the line."""
    own = np.array([shapes[w] for w in words], dtype=np.int64).reshape(-1, 5)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    ends = np.cumsum(lengths) - 1
    columns = [own[:, i] for i in range(5)]
    for step, edge in ((1, begins), (-1, ends)):
        for place, kind in enumerate(_SEEN_BESIDE):
            moved = np.roll(own[:, kind], step)
            moved[edge] = 0
            # Neighbours' features live in buckets of their own.
            columns.append((1 + place + 3 * (step < 0)) * _BUCKETS + moved)
    return np.stack(columns, axis=1)


def _lines(text: str) -> list[tuple[int, int]]:
    """All lines as (start, end)."""
    out, start = [], 0
    while start <= len(text):
        end = text.find("\n", start)
        end = len(text) if end < 0 else end
        out.append((start, end))
        start = end + 1
    return out


def _words_of(text: str, start: int, end: int) -> list[tuple[int, int]]:
    return [m.span() for m in _WORD.finditer(text, start, end)]


def _gold(words: list[tuple[int, int]], spans: list[tuple[str, int, int]]) -> list[int]:
    """The label of each word from the spans that touch it."""
    out = [0] * len(words)
    starts = [w[0] for w in words]
    for kind, a, b in spans:
        first = bisect_left(starts, a + 1) - 1
        inside = [i for i in range(max(first, 0), len(words)) if words[i][0] < b and words[i][1] > a]
        for n, i in enumerate(inside):
            out[i] = 1 + 2 * KINDS.index(kind) + (n > 0)
    return out


def _varied(text: str, spans: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with its data spelled in a way the base patterns do not match, and the new spans."""
    out, at, moved = [], 0, []
    length = 0
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        found = text[a:b]
        new = {
            "email": found.replace("@", " at ").replace(".", " dot "),
            "ip": found.replace(".", "[.]"),
            "card": found.replace(" ", ".").replace("-", "."),
            "phone": found.lstrip("+"),
        }[kind]
        out += [text[at:a], new]
        length += a - at
        moved.append((kind, length, length + len(new)))
        length += len(new)
        at = b
    return "".join([*out, text[at:]]), moved


def allowed_transitions() -> np.ndarray:
    """Inside labels follow a begin or an inside label of the same kind."""
    n = len(LABELS)
    ok = np.ones((n, n), dtype=bool)
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        ok[:, inside] = False
        ok[[inside - 1, inside], inside] = True
    return ok


def labelled_lines(texts: list[str]) -> tuple[list[list[str]], list[list[int]]]:
    """The small labelled table: words and labels of each line with data, as given and varied, and of some others."""
    lines, labels = [], []
    for text in texts:
        spans = base_spans(text)
        for body, marks in ((text, spans), _varied(text, spans)):
            plain = 0
            for start, end in _lines(body):
                own = [s for s in marks if start <= s[1] < end]
                # Of lines without data, which are alike in both, the first ones of the text as given.
                plain += not own
                if not own and (body is not text or plain > PLAIN_LINES):
                    continue
                words = _words_of(body, start, end)
                if not words:
                    continue
                gold = _gold(words, own)
                # Long lines are cut to what surrounds their data, which is all that neighbours' features see.
                keep = {j for i, g in enumerate(gold) if g for j in range(max(0, i - 4), min(len(gold), i + 5))}
                keep |= set(range(min(12, len(words))))
                at = sorted(keep)
                lines.append([body[words[i][0] : words[i][1]] for i in at])
                labels.append([gold[i] for i in at])
    return lines, labels


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS, seed: int = SEED) -> crf.Crf:
    """A model from ``sample_rows`` distinct texts with an at sign or several digits, those with the smallest seeded hashes."""
    text = F.col("text").cast("string")
    has = text.contains("@") | text.rlike(r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]") | text.rlike(r"[0-9][\x20().-]?[0-9]{3}")
    order = F.shiftrightunsigned(F.xxhash64(F.lit(seed), text), 1)
    rows = docs.filter(has & (F.octet_length(text) <= SAMPLE_BYTES)).select(text.alias("text"), order.alias("o"))
    # Copies count once: the smallest hashes first, then one text of each.
    least = [r["o"] for r in rows.select("o").distinct().orderBy("o").limit(sample_rows).collect()]
    drawn = rows.filter(F.col("o").isin(least)).dropDuplicates(["o"]) if least else rows.limit(0)
    lines, labels = labelled_lines([r["text"] for r in sorted(drawn.collect(), key=lambda r: r["o"])])
    if not lines:
        lines, labels = [["-"]], [[0]]
    lengths = np.array([len(x) for x in lines])
    shapes = Remembered(_shape)
    features = _featured([w for line in lines for w in line], lengths, shapes)
    gold = np.array([y for line in labels for y in line])
    start_free = allowed_transitions()
    model = crf.train(features, lengths, gold, LABELS, start_free, 7 * _BUCKETS)
    model.start[[2 + 2 * k for k in range(len(KINDS))]] = -1e4
    return model


class Decoder:
    """A model with the scores of the distinct words met so far."""

    def __init__(self, model: crf.Crf):
        self.model = model
        emission = model.emission
        beside = [[(1 + place + 3 * side) * _BUCKETS for place in range(len(_SEEN_BESIDE))] for side in (0, 1)]
        self.beside = [np.array(b) for b in beside]
        #: What the edge of a line adds to the scores of its first and last word.
        self.edge = [emission[b].sum(axis=0) for b in self.beside]
        self.bound = crf.outside_bound(model.transition, model.start, len(KINDS))
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.row_of: dict[tuple, int] = {}
        self.rows = np.zeros((3, 0, len(self.model.labels)))

    def _numbers(self, words: list[bytes]) -> np.ndarray:
        """The row of each word in ``rows``: its own scores, those it adds to the word after it and to the word before it."""
        if len(self.number) > REMEMBERED or len(self.row_of) > REMEMBERED:
            self._forget()
        number, row_of = self.number, self.row_of
        fresh: list[bytes] = []
        for word in set(words).difference(number):
            signature = _signature(word)
            row = row_of.get(signature)
            if row is None:
                row = row_of[signature] = len(row_of)
                fresh.append(word)
            number[word] = row
        if fresh:
            shapes = np.array([_shape(w.decode()) for w in fresh], dtype=np.int64)
            emission, seen = self.model.emission, shapes[:, _SEEN_BESIDE]
            more = np.stack([emission[shapes].sum(axis=1), *(emission[seen + b].sum(axis=1) for b in self.beside)])
            self.rows = np.concatenate([self.rows, more], axis=1)
        return np.fromiter(map(number.__getitem__, words), np.int64, len(words))

    def labels(self, words: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """The best label of every word of some lines."""
        at = self._numbers(words)
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
        ends = np.cumsum(lengths) - 1
        own, after, before = self.rows
        scores = own[at]
        beside = after[np.roll(at, 1)]
        beside[begins] = self.edge[0]
        scores += beside
        beside = before[np.roll(at, -1)]
        beside[ends] = self.edge[1]
        scores += beside
        # A word is surely outside if no label there, with an inside label after it made a begin, can be better.
        inside, begin = scores[:, 2::2], scores[:, 1::2]
        ahead = np.roll(np.maximum((inside - begin).max(axis=1), 0), -1)
        ahead[ends] = 0
        open_ = np.flatnonzero(scores[:, 0] - scores[:, 1:].max(axis=1) <= ahead + self.bound)
        out = np.zeros(len(words), dtype=np.int8)
        if not len(open_):
            return out
        line = np.repeat(np.arange(len(lengths)), lengths)[open_]
        fresh = np.ones(len(open_), dtype=bool)
        fresh[1:] = (np.diff(open_) > 1) | (np.diff(line) > 0)
        first = np.flatnonzero(fresh)
        sizes = np.diff([*first.tolist(), len(open_)])
        last = first + sizes - 1
        part = scores[open_]
        at_begin = open_[first] == begins[line[first]]
        part[first] += np.where(at_begin[:, None], self.model.start, self.model.transition[0])
        inner = last[open_[last] < ends[line[last]]]
        part[inner] += self.model.transition[:, 0]
        out[open_] = crf.viterbi(part, sizes, self.model.transition, np.zeros(len(self.model.labels)))
        return out


def model_spans(texts: list[bytes], decoder: Decoder) -> list[list[tuple[str, int, int]]]:
    """Spans of every text by Viterbi over all its lines, many at a time; in code points."""
    out: list[list[tuple[str, int, int]]] = [[] for _ in texts]
    words: list[bytes] = []
    lengths: list[int] = []
    held: list[tuple[int, int]] = []  # a text and its first word
    for i, text in enumerate(texts):
        held.append((i, len(words)))
        for line in text.split(b"\n"):
            own = line.split()
            if own:
                words += own
                lengths.append(len(own))
        if len(words) >= WORDS_AT_ONCE or i == len(texts) - 1:
            if words:
                _add_spans(texts, held, decoder.labels(words, np.array(lengths)), out)
            words, lengths, held = [], [], []
    return out


def _add_spans(texts, held, best, out) -> None:
    """Add the labelled words of some texts; only these texts' words are placed."""
    labelled = np.flatnonzero(best)
    begins = np.array([b for _, b in held])
    owner = np.searchsorted(begins, labelled, side="right") - 1
    for k in np.unique(owner).tolist():
        i, begin = held[k]
        places = [m.span() for m in _WORD.finditer(texts[i].decode())]
        for at in labelled[owner == k].tolist():
            label, (a, b) = int(best[at]), places[at - begin]
            if label % 2:
                out[i].append((KINDS[(label - 1) // 2], a, b))
            else:
                kind, first, _ = out[i][-1]
                out[i][-1] = (kind, first, b)


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2])))


def personal_data(docs: DataFrame, model: crf.Crf | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added`` of every row.

    The counts and the digest are of the base spans; ``spans`` has these and the model's spans that touch no base span,
    as kind:start:end in code points. A null text is empty and has no data; null ids stay null; lines and texts may have any
    length. Equal texts get equal results. An empty table gives an empty result; other columns are ignored.
    """
    model = fit(docs, sample_rows) if model is None else model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def search(batches):
        decoder = Decoder(shared.value)
        for piece in pieces(batches):
            texts = texts_of(piece)
            out: dict[str, list] = {f"n_{k}": [] for k in KINDS} | {"base_sha256": [], "spans": [], "n_added": []}
            for data, more in zip(texts, model_spans(texts, decoder), strict=True):
                text = data.decode()
                base = base_spans(text)
                taken = sorted((a, b) for _, a, b in base)
                ends = [b for _, b in sorted(taken, key=lambda s: s[1])]
                added = []
                for kind, a, b in more:
                    # The first base span that ends after the start of this one.
                    i = bisect_left(ends, a + 1)
                    if not any(x < b and y > a for x, y in taken[max(0, i - 8) : i + 8]):
                        added.append((kind, a, b))
                for kind in KINDS:
                    out[f"n_{kind}"].append(sum(s[0] == kind for s in base))
                out["base_sha256"].append(hashlib.sha256(_joined(base).encode()).hexdigest())
                out["spans"].append(_joined(base + added))
                out["n_added"].append(len(added))
            types = [pa.int64()] * 4 + [pa.string(), pa.string(), pa.int64()]
            arrays = [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
            yield pa.RecordBatch.from_arrays([column_of(piece, "doc_id"), *arrays], names=["doc_id", *out])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return wanted.mapInArrow(search, f"doc_id long, {counts}, base_sha256 string, spans string, n_added long")
