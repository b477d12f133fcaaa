"""Chat formatting: the fold over event logs, escapes, and the round trip."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from leafmill.llm import chat

LOG = "conv_id bigint, seq bigint, message_id string, kind string, role string, text string"


def escaped(text):
    return re.sub(r"(###|</turn>)", r"\\\1", text)


def turns_of(chats):
    rows = chats.select("conv_id", chat.read_back(F.col("formatted")).alias("t")).collect()
    return {r["conv_id"]: [(t["role"], t["text"]) for t in r["t"]] for r in rows}


def test_deltas_edits_and_regenerations(spark):
    log = [
        (1, 5, "b", "delta", None, "lo "), (1, 4, "b", "delta", "assistant", "hel"), (1, 6, "b", "regenerate", None, None),
        (1, 7, "b", "delta", None, "good"), (1, 8, "b", None, None, " day"),
        (1, 1, "a", "message", "user", "hi"), (1, 9, "a", "edit", None, "hi there"), (1, 10, "a", "delta", None, "!"),
        (2, None, "x", "delta", "user", "early"), (2, 0, "y", "message", None, ""),
    ]
    got = turns_of(chat.format_chats(spark.createDataFrame(log, LOG).repartition(4)))
    assert got == {1: [("user", "hi there!"), ("assistant", "good day")], 2: [("user", "early"), ("", "")]}


def test_fold_equals_brute_force_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 3)
    log = [(c, i, str(i % 2), ("edit" if (i * 7 + c) % 11 == 0 else "delta"), "user", f"<{i}>") for c in range(5) for i in range(40)]
    want = {}
    for c in range(5):
        texts = {}
        for _, i, m, kind, _, text in sorted(x for x in log if x[0] == c):
            texts[m] = text if kind == "edit" else texts.get(m, "") + text
        want[c] = [("user", texts["0"]), ("user", texts["1"])]
    assert turns_of(chat.format_chats(spark.createDataFrame(log, LOG).repartition(7))) == want


@pytest.mark.parametrize("text", [
    "", "\\", "###", "####", "\\### x", "\\\\</turn>", "\n</turn>\n", "a\n", "### user: b\n</turn>\n### c", "</turn></turn>", "###" * 5, "é😀" * 30_000,
])
def test_round_trip(spark, text):
    rows = [(1, 0, "sys%3A:\nx", text), (1, 1, "assistant", text)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert turns_of(chat.format_chats(chat.events_of_turns(turns)))[1] == [(r, t) for _, _, r, t in rows]


def test_nulls_ties_repeats_clashing_columns_and_nothing(spark):
    rows = [(None, 0, None, None, 1, "k"), (3, None, "user", "b", 1, "k"), (3, None, "user", "a", 1, "k"), (3, None, "user", "a", 1, "k")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, seq int, kind string")
    out = {r["conv_id"]: r for r in chat.digests(chat.format_chats(chat.events_of_turns(turns))).collect()}
    assert out[None]["n_turns"] == 1 and out[None]["loss_chars"] == 0
    assert out[3]["turns_sha256"] == hashlib.sha256(b"user\na\nuser\na\nuser\nb\n").hexdigest()
    assert chat.digests(chat.format_chats(chat.events_of_turns(turns.limit(0)))).count() == 0


def test_loss_spans_are_the_assistants_texts(spark, monkeypatch):
    """Code points and bytes alike, over blocks, with escapes in role and text."""
    monkeypatch.setattr(chat, "BLOCK", 3)
    said = ["é😀", "", "\\### </turn>", "plain", "\n</turn>\n### assistant: x"]
    rows = [(c, t, ["assistant", "user", "a:%\n"][(t + c) % 3], said[(t * 3 + c) % 5]) for c in range(4) for t in range(11)]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(5)
    found = chat.format_chats(chat.events_of_turns(turns)).withColumn("learned", chat.masked_texts(F.col("formatted"), F.col("loss_spans")))
    for r in found.collect():
        want = [text for c, _, role, text in rows if c == r["conv_id"] and role == "assistant"]
        whole, octets = r["formatted"], r["formatted"].encode()
        cut = [whole[s["start"] : s["end"]] for s in r["loss_spans"]]
        assert r["learned"] == want and len(cut) == len(want)
        assert [octets[s["start_byte"] : s["end_byte"]].decode() for s in r["loss_spans"]] == cut
        assert whole == "".join(
            f"### {role.replace('%', '%25').replace(':', '%3A').replace(chr(10), '%0A')}: {escaped(text)}\n</turn>\n"
            for c, _, role, text in rows if c == r["conv_id"]
        ) and all(escaped(w) == x for w, x in zip(want, cut, strict=True))


def test_a_log_of_turns_holds_every_kind_of_event(spark):
    rows = [(1, 0, "user", "u" * 40), (1, 1, "assistant", "a" * 1200), (1, 2, "assistant", None)]
    log = chat.events_of_turns(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert {r["kind"]: r["count"] for r in log.groupBy("kind").count().collect()} == {"message": 3, "edit": 1, "regenerate": 2, "delta": 3}
    assert turns_of(chat.format_chats(log))[1] == [(role, text or "") for _, _, role, text in rows]


def test_a_log_is_shuffled_three_times(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    plan = chat.format_chats(chat.events_of_turns(turns))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 3


def test_no_python_in_the_plan(spark):
    plan = chat.digests(chat.format_chats(chat.events_of_turns(chat.probe(spark))))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
