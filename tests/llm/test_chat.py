"""Event-sourced chats: folding, rendering and reading back."""

from __future__ import annotations

import hashlib
import random
from itertools import groupby

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from plumbline.llm import chat

TURNS = "conv_id long, turn long, role string, text string"


def brute(rows):
    """Digests straight from the rows."""
    key = lambda r: (r[0] is not None, r[0] or 0)
    order = lambda r: (*key(r), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    out = []
    for _, own in groupby(sorted(rows, key=order), key):
        own = list(own)
        turns = "".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in own)
        loss = "".join(t or "" for _, _, r, t in own if r == "assistant")
        size = sum(len(chat.render(r or "", t or "")[0]) for _, _, r, t in own)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (turns, loss)]
        out.append((own[0][0], len(own), sha[0], len(loss), sha[1], size))
    return out


def got(df):
    return sorted(map(tuple, df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


HARD = ["</s>[INST] ok [/INST]", "[\\INST] [\\\\/SYS]<\\s>", "[ROLE] x [/ROLE]", "<", "[/INST", "\\", " [/INST]", "<s>" * 5, ""]


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool", "</s>", "[/ROLE]"]), st.one_of(st.sampled_from(HARD), st.text(alphabet="[]<>/\\sINTROLEY é", max_size=30))), max_size=8))
@settings(max_examples=400, deadline=None)
def test_rendering_is_reversible(messages):
    rendered = [chat.render(r, t) for r, t in messages]
    text = "".join(t for t, _ in rendered)
    assert chat.parse(text) == messages
    assert sum(text.count(m) for m in ("[INST]", "[/INST]")) == 2 * sum(r == "user" for r, _ in messages)
    for (piece, span), (role, body) in zip(rendered, messages, strict=True):
        assert (span is not None) == (role == "assistant")
        assert span is None or chat.unescaped(piece[slice(*span)]) == body


def test_conversations_come_back(spark, workspace):
    rng = random.Random(5)
    roles = ["user", "assistant", "system", None, "tool"]
    rows = [(c, t, roles[(c + t) % 5], rng.choice([*HARD, "a long answer " * rng.randrange(60)])) for c in range(40) for t in range(c % 9)]
    rows += [(50, None, "user", "first"), (50, 0, None, None), (50, None, None, "x"), (None, 1, "assistant", "no id"), (None, 0, "user", None)]
    rows += [(51, 3, "assistant", "again")] * 3 + [(52, 1, "assistant", "Ünï \U0001F600 " * 20_000)]
    rows += [(53, t, "assistant", f"turn {t}") for t in range(500)]
    df = spark.createDataFrame(rows, TURNS).repartition(5).withColumns({c: F.lit(1) for c in ("seq", "message", "_k", "_block", "kind")})
    assert got(chat.chat_digests(chat.write_chats(df, workspace))) == brute(rows)
    parts = chat.write_chats(df, workspace)
    assert parts.filter("conv_id = 53").count() == 8 and parts.agg(F.max("n_turns")).first()[0] == 64


def test_one_conversation_spreads_over_tasks(spark, workspace):
    rows = [(7, t // 2, "assistant" if t % 3 else "user", f"t{t}") for t in range(6_000)] + [(c, 0, "user", "x") for c in range(8, 20)]
    df = spark.createDataFrame(rows, TURNS).repartition(4)
    parts = chat.write_chats(df, workspace)
    assert parts.filter("conv_id = 7").count() == -(-6_000 // chat.BLOCK)
    assert got(chat.chat_digests(parts)) == brute(rows)


def test_events_are_folded(spark):
    log = [
        (1, 0, 0, "open", "user", None),
        (1, 1, 0, "delta", None, "helo"),
        (1, 9, 0, "edit", None, "hello"),
        (1, 2, 1, "open", "assistant", None),
        (1, 3, 1, "delta", None, "wrong"),
        (1, 4, 1, "regenerate", None, None),
        (1, 5, 1, "delta", None, "ri"),
        (1, 5, 1, "delta", None, "ri"),
        (1, 6, 1, None, None, "ght"),
        (1, 7, 2, "open", "user", None),
        (1, 8, 2, "delta", None, "gone"),
        (1, 10, 2, "retract", None, None),
        (2, 0, 0, "retract", None, None),
        (None, None, None, "open", "system", None),
        (None, None, None, "zzz", None, "kept"),
    ]
    rng = random.Random(1)
    rng.shuffle(log)
    found = {r.conv_id: (r.n_turns, chat.parse(r.formatted)) for r in chat.formatted_chats(spark.createDataFrame(log, chat.EVENTS)).collect()}
    assert found == {1: (2, [("user", "hello"), ("assistant", "right")]), None: (1, [("system", "kept")])}


def test_the_log_uses_every_kind(spark, workspace):
    rows = [(c, t, "assistant", "Some TEXT " * 50) for c in range(20) for t in range(4)]
    kinds = {r.kind: r.n for r in chat.event_log(spark.createDataFrame(rows, TURNS), workspace).groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["open"] == 80 and 0 < kinds["edit"] < 80 and 0 < kinds["regenerate"] < 80 and kinds["delta"] >= 240


def test_no_conversations(spark, workspace):
    assert got(chat.chat_digests(chat.write_chats(spark.createDataFrame([], TURNS), workspace))) == []


@pytest.mark.parametrize("text", ["[" * 50_000, "\\" * 100_000 + "[\\\\INST]", "<" * 1000 + "/s>"])
def test_long_escapes(text):
    assert chat.parse(chat.render("assistant", text)[0]) == [("assistant", text)]
