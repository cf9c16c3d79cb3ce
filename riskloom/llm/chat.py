"""Chat formatting: events of a conversation are folded into messages, which a template renders.

The template writes ``<|role|>text<|end|>`` and a line feed per message. In roles and texts a backslash, ``<`` and
``|`` are written as a backslash and a letter, so every ``<`` in the output belongs to a mark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.exprs import let

ESCAPES = (("\\", "\\s"), ("<", "\\l"), ("|", "\\p"))
END = "<|end|>\n"
TURN = r"<\|([^|]*)\|>([^<]*)<\|end\|>\n"


def escape(text: Column) -> Column:
    for plain, coded in ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def unescape(text: Column) -> Column:
    for plain, coded in reversed(ESCAPES):
        text = F.replace(text, F.lit(coded), F.lit(plain))
    return text


def events_of(turns: DataFrame) -> DataFrame:
    """A log of events from stored turns: each row adds the text of a message of its own, in the order of ``turn``;
    equal turns go by role, then text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), text.alias("text"))
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("bigint")
    return rows.withColumn("seq", place).select(
        "conv_id", "seq", F.lit("delta").alias("kind"), F.col("seq").alias("message"), "role", "text"
    )


def fold(events: DataFrame) -> DataFrame:
    """The final messages (conv_id, message, role, text) of a log (conv_id, seq, kind, message, role, text).

    ``delta`` adds its text to a message; ``edit`` replaces the message's text; ``regenerate`` drops what its message
    and all later messages of the conversation held so far. A message without any event left is gone. Its role is the
    last one given.

    Null texts are empty and null roles unknown (rendered as empty). Events without a sequence number count as the
    first, those of one number go by text. Other kinds are ignored. All steps share one shuffle by conversation; a
    conversation is one row of the result in the end, so it is gathered in one place.
    """
    rows = events.select(
        "conv_id", F.coalesce(F.col("seq").cast("bigint"), F.lit(-(2**63))).alias("seq"), "kind", "message",
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    later = Window.partitionBy("conv_id").orderBy(F.desc("seq"), F.desc("text")).rowsBetween(
        Window.unboundedPreceding, -1
    )
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    alive = rows.withColumn("cut", cut).filter("cut IS NULL OR message < cut").filter("kind IN ('delta', 'edit')")
    own = Window.partitionBy("conv_id", "message")
    edited = F.max(F.when(F.col("kind") == "edit", F.col("seq"))).over(own)
    given = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq"))).over(own)
    live = alive.withColumns({"edited": edited, "given": given}).filter("edited IS NULL OR seq >= edited")
    parts = F.sort_array(F.collect_list(F.struct("seq", "text")))
    return live.groupBy("conv_id", "message").agg(
        F.max("given").alias("role"),
        F.array_join(F.transform(parts, lambda p: p.text), "").alias("text"),
    )


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """conv_id, formatted and loss_spans: start from 0 and length of each text that the loss counts, in code points and
    in bytes of UTF-8 (which can be cut out without walking through the text)."""
    role = escape(F.coalesce(F.col("role"), F.lit("")))
    head, body = F.concat(F.lit("<|"), role, F.lit("|>")), escape(F.coalesce(F.col("text"), F.lit("")))
    rows = messages.select("conv_id", "message", "role", head.alias("head"), body.alias("body"))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)

    def start(length) -> Column:
        size = length("head") + length("body") + len(END)
        return F.coalesce(F.sum(size).over(before), F.lit(0)) + length("head")

    placed = rows.withColumns({
        "start": start(F.char_length), "byte_start": start(F.octet_length),
        "counts": F.coalesce(F.col("role") == loss_role, F.lit(False)),
    })
    turn = F.struct(
        "message", F.concat("head", "body", F.lit(END)).alias("piece"), "counts", "start", "byte_start",
        F.char_length("body").cast("bigint").alias("length"), F.octet_length("body").cast("bigint").alias("byte_length"),
    )
    whole = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "conv_id", F.array_join(F.transform("turns", lambda t: t.piece), "").alias("formatted"),
        F.transform(
            F.filter("turns", lambda t: t.counts),
            lambda t: F.struct(*[t[c].alias(c) for c in ("start", "length", "byte_start", "byte_length")]),
        ).alias("loss_spans"),
    )


def format_chats(events: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Fold a log of events and render each conversation. Empty logs give no rows; extra columns are ignored."""
    return render(fold(events), loss_role)


def parsed(formatted: Column) -> Column:
    """The turns (role, text) of a rendered conversation."""
    roles, texts = F.regexp_extract_all(formatted, F.lit(TURN), 1), F.regexp_extract_all(formatted, F.lit(TURN), 2)
    return F.zip_with(
        roles, texts, lambda role, text: F.struct(unescape(role).alias("role"), unescape(text).alias("text"))
    )


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and without gaps."""
    held = F.struct(formatted.cast("binary").alias("bytes"), spans.alias("spans"))
    return let(held, lambda row: unescape(F.array_join(
        F.transform(row.spans, lambda s: F.substr(
            row.bytes, (s.byte_start + 1).cast("int"), s.byte_length.cast("int")).cast("string")),
        "",
    )))
