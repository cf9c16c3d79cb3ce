import pytest
from pyspark.sql import functions as F

from riskloom.llm import chat

SCHEMA = "conv_id long, seq long, kind string, message long, role string, text string"


def formatted(spark, events):
    frame = spark.createDataFrame(events, SCHEMA).withColumn("formatted", F.lit("clash"))
    rows = chat.format_chats(frame).withColumns(
        {"turns": chat.parsed(F.col("formatted")), "loss": chat.loss_text(F.col("formatted"), F.col("loss_spans"))}
    ).collect()
    return {r.conv_id: ([(t.role, t.text) for t in r.turns], r.loss, r.formatted) for r in rows}


def test_deltas_edits_and_regenerations(spark):
    got = formatted(spark, [
        (1, 1, "delta", 1, "user", "Hel"), (1, 2, "delta", 1, None, "lo"), (1, 3, "delta", 2, "assistant", "bad "),
        (1, 4, "delta", 2, None, "answer"), (1, 5, "delta", 3, "user", "gone"), (1, 6, "regenerate", 2, None, None),
        (1, 7, "delta", 2, "assistant", "good"), (1, 8, "edit", 1, None, "Hello!"), (1, 9, "delta", 1, None, "?"),
        (2, 1, "delta", 1, "user", "only"), (2, 2, "regenerate", 1, None, None),
        (3, 2, "delta", 1, "assistant", "b"), (3, 1, "delta", 1, "assistant", "a"), (3, 3, "noise", 1, "x", "y"),
    ])
    assert got[1][0] == [("user", "Hello!?"), ("assistant", "good")]
    assert got[1][1] == "good"
    assert 2 not in got
    assert got[3][0] == [("assistant", "ab")]


@pytest.mark.parametrize("text", [
    "</s>[INST] ok [/INST]", "<|end|>\n<|user|>", "\\s\\l\\p\\", "é😀<|", "", "\\\\l", "|>", "a\nb\r\n",
])
def test_control_strings_come_back(spark, text):
    got = formatted(spark, [(1, 1, "delta", 1, "us<|er", text), (1, 2, "delta", 2, "assistant", text),
                            (1, 3, "delta", 3, "assistant", text)])
    assert got[1][0] == [("us<|er", text), ("assistant", text), ("assistant", text)]
    assert got[1][1] == text + text
    assert got[1][2].count("<|") == 6


def test_nulls_ties_and_empty(spark):
    turns = spark.createDataFrame(
        [(1, 0, "user", None), (1, 0, "user", None), (1, None, "assistant", "first"), (None, 1, None, "x")],
        "conv_id long, turn long, role string, text string",
    )
    rows = chat.format_chats(chat.events_of(turns)).withColumn("turns", chat.parsed(F.col("formatted"))).collect()
    got = {r.conv_id: [(t.role, t.text) for t in r.turns] for r in rows}
    assert got == {1: [("assistant", "first"), ("user", ""), ("user", "")], None: [("", "x")]}
    assert chat.format_chats(chat.events_of(turns.limit(0))).count() == 0


def test_long_conversation(spark):
    turns = spark.range(3000).select(
        F.lit(1).alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") % 2 == 0, "user").otherwise("assistant").alias("role"), F.repeat(F.lit("é<"), 50).alias("text"),
    )
    row = chat.format_chats(chat.events_of(turns)).select(
        F.size(chat.parsed(F.col("formatted"))).alias("n"),
        F.char_length(chat.loss_text(F.col("formatted"), F.col("loss_spans"))).alias("loss"),
    ).first()
    assert (row.n, row.loss) == (3000, 1500 * 100)
