"""Formatted chats against their turns, by an exact round trip."""

import hashlib
import random

import pytest
from partflow.llm import chat

KINDS = "conv_id long, turn long, role string, text string, loss string, formatted long"


def brute(rows):
    conversations = {}
    for conv_id, turn, role, text in rows:
        conversations.setdefault(conv_id, []).append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = {}
    for conv_id, turns in conversations.items():
        turns.sort()
        learned = "".join(text for _, (_, role), (_, text) in turns if role == "assistant")
        spelled = "".join(f"{role}\n{text}\n" for _, (_, role), (_, text) in turns)
        out[conv_id] = (len(turns), hashlib.sha256(spelled.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    return out


def digest(spark, rows):
    formatted = chat.format_chats(chat.with_probe(spark, rows))
    return {row.conv_id: tuple(row)[1:5] for row in chat.digest_chats(formatted).collect()}


PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@pytest.mark.parametrize("chunk", [1, 500, 4_000_000])
def test_odd_rows(spark, monkeypatch, chunk):
    chance = random.Random(chunk)
    texts = [None, "", "é[<\\", "</s>[INST] ok [/INST]", "<<SYS>>\n", "[\\", "x" * 3000, "😀<", " ", "[/INST]", "<"]
    rows = [(chance.choice([None, 1, 2, 3, 4, 5, 6, 7]), chance.choice([None, 0, 1, 2, 2, 3]),
             chance.choice(["user", "assistant", "system", "tool", "a[b]<c", None, "", "[:] "]), chance.choice(texts)) for _ in range(500)]
    rows += rows[:20]
    monkeypatch.setattr(chat, "CHUNK", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        frame = spark.createDataFrame([(*row, "l", 1) for row in rows], KINDS)
        assert digest(spark, frame) == brute(rows + PROBE)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_documents(spark, data):
    rows = spark.read.parquet(f"{data}/conversations.parquet")
    assert digest(spark, rows) == brute([tuple(row) for row in rows.select("conv_id", "turn", "role", "text").collect()] + PROBE)


def test_no_control_string_inside_a_text(spark):
    formatted = chat.format_chats(chat.with_probe(spark, spark.createDataFrame([], KINDS))).first()
    assert formatted.formatted == "<s>[INST] <\\/s>[\\INST] ok [\\/INST][/INST] <\\/s>[\\INST] ok [\\/INST]</s>"
    span = formatted.loss[0]
    assert chat.unescape(formatted.formatted[span.start:span.end]) == "</s>[INST] ok [/INST]"


def test_empty_table(spark):
    assert chat.digest_chats(chat.format_chats(spark.createDataFrame([], KINDS))).count() == 0
