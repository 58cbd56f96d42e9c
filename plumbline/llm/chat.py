"""Chats from event logs: streamed deltas, edits and regenerations folded into final messages, and rendered.

A log has ``conv_id, seq, message, kind, role, text``. ``message`` is the place of the message in its conversation; a
message is what its events make of it, in the order of ``seq``:

* ``open`` begins it, with its role; ``delta`` appends text; ``regenerate`` discards the text so far;
* ``edit`` replaces the text, whenever it comes; ``retract`` takes the message away, until it is opened again.

Events are dealt by conversation and block of BLOCK messages and sorted by message and ``seq``, so a conversation of any
length spreads over tasks, and a task holds one message at a time and one block of the rendered text. Logs are delivered at
least once: an event equal to the one before it counts once.

The template marks the turns of all roles. A text that holds a marker gets a backslash into each, and one that already has
backslashes there one more, so that no marker is left and all can be undone. Spans of the rendered text that are under the
loss mask, the assistant's texts, are kept beside it, in code points.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from plumbline.llm.common import column_of, ranked, unpacked

#: Messages of a block, and letters of a streamed delta.
BLOCK = 64
DELTA = 200
#: Letters of rendered blocks that a task collects before it hands them on.
READY = 2_000_000

#: Before and after the text of each role; any other role stands before its text, as OTHER has it.
MARKS = {"user": ("[INST] ", " [/INST]"), "system": ("[SYS] ", " [/SYS]"), "assistant": ("", "</s>")}
OTHER = ("[ROLE] ", " [/ROLE]", "</s>")
_PLAIN = re.compile(r"([<\[])(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]))")
_MARKED = re.compile(r"([<\[])\\(\\*)(/?(?:s>|INST\]|SYS\]|ROLE\]))")

EVENTS = "conv_id long, seq long, message long, kind string, role string, text string"
PARTS = "conv_id long, part long, n_turns long, formatted string, loss_mask binary"


def escaped(text: str) -> str:
    return _PLAIN.sub(r"\1\2\\\3", text)


def unescaped(text: str) -> str:
    return _MARKED.sub(r"\1\2\3", text)


def render(role: str, text: str) -> tuple[str, tuple[int, int] | None]:
    """A message in the template, and where the loss is taken."""
    if role in MARKS:
        before, after = MARKS[role]
    else:
        before, after = f"{OTHER[0]}{escaped(role)}{OTHER[1]}", OTHER[2]
    body = escaped(text)
    span = (len(before), len(before) + len(body)) if role == "assistant" else None
    return f"{before}{body}{after}", span


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages of a rendered text."""
    out, at = [], 0
    while at < len(formatted):
        for role, (before, after) in MARKS.items():
            if before and formatted.startswith(before, at):
                break
        else:
            role, (before, after) = "assistant", MARKS["assistant"]
            if formatted.startswith(OTHER[0], at):
                end = formatted.index(OTHER[1], at)
                role, before, after = unescaped(formatted[at + len(OTHER[0]) : end]), "", OTHER[2]
                at = end + len(OTHER[1])
        at += len(before)
        end = formatted.index(after, at)
        out.append((role, unescaped(formatted[at:end])))
        at = end + len(after)
    return out


def event_log(conversations: DataFrame, work) -> DataFrame:
    """A log whose messages are the rows of ``conversations`` in the order of their turns.

    Texts are streamed by DELTA letters. Of all messages, by a hash, a quarter is first streamed as far as its first delta
    and regenerated; a quarter is streamed in lower case and edited, which comes after the next message has begun.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = ranked(rows, "conv_id", ["turn", "role", "text"], work)
    way = F.pmod(F.xxhash64("conv_id", "_k"), F.lit(4))

    def event(kind, text, order):
        return F.struct(order.cast("long").alias("order"), F.lit(kind).alias("kind"), text.alias("text"))

    starts = F.sequence(F.lit(0), F.length("text"), F.lit(DELTA))
    shown = F.when(way == 2, F.lower("text")).otherwise(F.col("text"))
    streamed = F.transform(
        starts, lambda at, i: event("delta", F.substr(shown, at + 1, F.lit(DELTA)), i.cast("long") + 3)
    )
    none = F.lit(None).cast("string")
    first = F.array(event("open", none, F.lit(0)))
    again = F.array(event("delta", F.substr("text", F.lit(1), F.lit(DELTA)), F.lit(1)), event("regenerate", none, F.lit(2)))
    late = F.array(event("edit", F.col("text"), F.lit((1 << 32) + (1 << 31))))
    nothing = F.array().cast("array<struct<order:bigint,kind:string,text:string>>")
    events = F.concat(
        first, F.when(way == 1, again).otherwise(nothing), streamed, F.when(way == 2, late).otherwise(nothing)
    )
    return rows.select("conv_id", "_k", "role", F.explode(events).alias("_event")).select(
        "conv_id",
        (F.shiftleft("_k", 32) + F.col("_event.order")).alias("seq"),
        F.col("_k").alias("message"),
        F.col("_event.kind").alias("kind"),
        F.when(F.col("_event.kind") == "open", F.col("role")).alias("role"),
        F.col("_event.text").alias("text"),
    )


class _Message:
    """The state of a message between its events."""

    def __init__(self):
        self.role, self.parts, self.there = "", [], True

    def take(self, kind: str | None, role: str | None, text: str | None) -> None:
        if kind == "open":
            self.role, self.there = role or "", True
        elif kind == "regenerate":
            self.parts = []
        elif kind == "edit":
            self.parts = [text or ""]
        elif kind == "retract":
            self.parts, self.there = [], False
        else:
            self.parts.append(text or "")


def _fold(batches):
    """Events of whole blocks in order to ``PARTS``, one block at a time."""
    key, last, message = None, None, None
    texts: list[str] = []
    spans: list[int] = []
    size = turns = held = 0
    ready: list[tuple] = []

    def finish():
        nonlocal size, turns
        if message is not None and message.there:
            text, span = render(message.role, "".join(message.parts))
            if span:
                spans.extend((size + span[0], size + span[1]))
            texts.append(text)
            size += len(text)
            turns += 1

    def close():
        nonlocal texts, spans, size, turns, held
        finish()
        if turns:
            ready.append((*key, turns, "".join(texts), np.array(spans, "<i8").tobytes()))
            held += size + 500
        texts, spans, size, turns = [], [], 0, 0

    names = ["conv_id", "_block", "message", "seq", "kind", "role", "text"]
    for batch in batches:
        for row in zip(*(column_of(batch, n).to_pylist() for n in names), strict=True):
            if row[:2] != key:
                if key is not None:
                    close()
                key, message = row[:2], _Message()
            elif row[2] != last[2]:
                finish()
                message = _Message()
            elif row == last:
                continue
            message.take(*row[4:])
            last = row
            if held > READY:
                yield _parts(ready)
                ready, held = [], 0
    if key is not None:
        close()
    if ready:
        yield _parts(ready)


def _parts(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    columns = zip(*rows, strict=True)
    names = ["conv_id", "part", "n_turns", "formatted", "loss_mask"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def formatted_chats(events: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, part, n_turns, formatted, loss_mask`` of a log: the rendered text of each block of ``block`` messages.

    The parts of a conversation, in their order, are its text. ``loss_mask`` has the starts and ends of the spans under
    the mask as 64-bit integers. A null ``conv_id`` is a conversation; null messages are one message, before the others; a null
    role or text is empty; a null or unknown kind is a delta; of equal ``seq`` the order is by kind, role and text. A block
    without messages has no row, so an empty log gives an empty result. Other columns are ignored.
    """
    chosen = events.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.floor(F.coalesce(F.col("message"), F.lit(0)) / block).cast("long").alias("_block"),
        F.col("message").cast("long").alias("message"),
        F.col("seq").cast("long").alias("seq"),
        *[F.col(c).cast("string").alias(c) for c in ("kind", "role", "text")],
    )
    dealt = chosen.repartition("conv_id", "_block")
    return dealt.sortWithinPartitions(*chosen.columns).mapInArrow(_fold, PARTS)


def chat_digests(parts: DataFrame) -> DataFrame:
    """Read back: ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of each conversation.

    ``turns_sha256`` is of role, newline, text, newline of every turn; ``loss_sha256`` of the unescaped text under the mask. The
    parts of a conversation are read one after the other and none is kept.
    """

    def digest(batches):
        rows: list[tuple] = []
        key = turns = loss = None
        n = chars = size = 0
        begun = False
        for batch in batches:
            masks, lengths = unpacked(column_of(batch, "loss_mask"), "<i8")
            ends = np.cumsum(lengths).tolist()
            ids, texts = column_of(batch, "conv_id").to_pylist(), column_of(batch, "formatted").to_pylist()
            for conv_id, text, end, length in zip(ids, texts, ends, lengths.tolist(), strict=True):
                if not begun or conv_id != key:
                    if begun:
                        rows.append((key, n, turns.hexdigest(), chars, loss.hexdigest(), size))
                    key, begun, n, chars, size = conv_id, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, body in parse(text):
                    turns.update(f"{role}\n{body}\n".encode())
                    n += 1
                for a, b in masks[end - length : end].reshape(-1, 2).tolist():
                    body = unescaped(text[a:b])
                    loss.update(body.encode())
                    chars += len(body)
                size += len(text)
            if rows:
                yield _digests(rows)
                rows = []
        if begun:
            yield _digests([(key, n, turns.hexdigest(), chars, loss.hexdigest(), size)])

    dealt = parts.repartition("conv_id").sortWithinPartitions("conv_id", "part").select("conv_id", "formatted", "loss_mask")
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    return dealt.mapInArrow(digest, schema)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def write_chats(conversations: DataFrame, work) -> DataFrame:
    """The rendered parts of all conversations, written to a scratch table and read back."""
    return work.stage(formatted_chats(event_log(conversations, work)), "chats")
