"""Chat formatting by event-sourced reconstruction, on DataFrame functions alone (operator 9).

A conversation is stored as a log of events. Each event names its conversation, a sequence number, the
message it is about and a kind: ``open`` (a role), ``delta`` (text to append), ``edit`` (text that
replaces what the message holds) and ``regenerate`` (forget the message's text so far). The log is
partitioned by conversation and message, put in order of the sequence and folded into final messages:
the text of a message is that of its last edit, or nothing from the last regeneration on, followed by
the deltas after it. Long conversations spread over many tasks up to here; what is rendered is one
string per conversation, so its messages meet only there.

Rendered text marks turns with ``<|turn|>``, ``<|text|>`` and ``<|end|>``. Inside roles and texts a
backslash is doubled and ``<|`` becomes ``<\\|``, so no text can hold a mark; one pass turns it back.
The loss mask holds, per turn, the spans of assistant texts in code points of the rendered string.

Null roles and texts are empty; a null conversation id is a conversation, and null message numbers come
last. Events of equal number are ordered by kind and text. Messages without an ``open`` event have an
empty role. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold(events: DataFrame) -> DataFrame:
    """(conv_id, message, part, role, text) from rows of (conv_id, seq, message, part, kind, text).

    ``part`` tells apart messages of equal number.
    """
    keys = ["conv_id", "message", "part"]
    inside = Window.partitionBy(*keys).orderBy("seq", "kind", "text")
    reset = F.col("kind").isin("edit", "regenerate")
    numbered = events.withColumn("_nth", F.row_number().over(inside))
    last = F.max(F.when(reset, F.col("_nth"))).over(Window.partitionBy(*keys))
    counts = ((F.col("kind") == "delta") & (F.col("_nth") > F.col("_last"))) | (
        (F.col("kind") == "edit") & (F.col("_nth") == F.col("_last"))
    )
    live = numbered.withColumn("_last", F.coalesce(last, F.lit(0))).withColumn(
        "_text", F.when(counts, F.coalesce("text", F.lit("")))
    )
    pieces = F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_nth", "_text"))))
    return live.groupBy(*keys).agg(
        F.coalesce(F.max_by(F.coalesce("text", F.lit("")), F.when(F.col("kind") == "open", F.col("_nth"))), F.lit("")).alias("role"),
        F.array_join(F.transform(pieces, lambda p: p["_text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss) from folded messages; ``loss`` holds (turn, begin, start, end) in code points."""
    head = F.concat(F.lit(TURN), escaped(F.col("role")), F.lit(TEXT))
    body = escaped(F.col("text"))
    pieces = messages.select(
        "conv_id", "message", "part", "role",
        F.concat(head, body, F.lit(END)).alias("piece"),
        F.length(head).alias("_head"), F.length(body).alias("_body"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("message"), "part")
    before = F.coalesce(F.sum(F.length("piece").cast("long")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = pieces.select(
        "conv_id", "piece", "role", F.row_number().over(order).alias("turn"),
        before.alias("begin"), (before + F.col("_head")).alias("start"), (before + F.col("_head") + F.col("_body")).alias("end"),
    )
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", "begin", "start", "end", "piece")))
    return placed.groupBy("conv_id").agg(turns.alias("_turns")).select(
        "conv_id",
        F.array_join(F.transform("_turns", lambda t: t.piece), "").alias("formatted"),
        F.transform(
            F.filter("_turns", lambda t: t.role == "assistant"), lambda t: F.struct(t.turn, t.begin, t.start, t.end)
        ).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_texts, formatted_chars): roles, texts, and what the mask covers, unescaped."""
    mark = len(TURN)
    cut = formatted.withColumn("_pieces", F.split("formatted", r"<\|turn\|>"))  # the first is empty

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, TEXT, 1)
        start = F.length(role) + len(TEXT)
        text = piece.substr(start + 1, F.length(piece) - start - len(END))
        return F.struct(unescaped(role).alias("role"), unescaped(text).alias("text"))

    def masked(span: Column) -> Column:
        piece = F.get("_pieces", span.turn)
        return unescaped(piece.substr((span.start - span.begin - mark + 1).cast("int"), (span.end - span.start).cast("int")))

    return cut.select(
        "conv_id",
        F.transform(F.slice("_pieces", 2, F.size("_pieces")), turn).alias("turns"),
        F.transform("loss", masked).alias("loss_texts"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def log_of(rows: DataFrame, chunk: int = 200) -> DataFrame:
    """The event log that would have led to the given rows (conv_id, turn, role, text).

    Texts arrive in portions of ``chunk`` characters. An assistant's text is begun, dropped and generated
    again; a user's first portion is edited once.
    """
    part = F.row_number().over(Window.partitionBy("conv_id", "turn").orderBy("role", "text"))
    text = F.coalesce("text", F.lit(""))
    portions = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % chunk), F.lit(0))
    first = F.coalesce(F.get("_portions", F.lit(0)), F.lit(""))

    def event(seq: Column, kind: str, text: Column) -> Column:
        return F.struct(seq.cast("long").alias("seq"), F.lit(kind).alias("kind"), text.alias("text"))

    begun = F.array(event(F.lit(1), "delta", first))
    rest = F.transform("_portions", lambda p, i: event(i + 3, "delta", p))
    again = F.array(event(F.lit(2), "regenerate", F.lit("")))
    edited = F.array(event(F.lit(2), "edit", first))
    events = (
        F.when(F.col("role") == "assistant", F.concat(begun, again, rest))
        .when(F.col("role") == "user", F.concat(begun, edited, F.filter(rest, lambda e: e.seq > 3)))
        .otherwise(rest)
    )
    opened = F.array(event(F.lit(0), "open", F.coalesce("role", F.lit(""))))
    numbered = rows.select("conv_id", "turn", "role", "text", part.alias("part")).withColumn("_portions", portions)
    return numbered.select(
        "conv_id", F.col("turn").alias("message"), "part", F.explode(F.concat(opened, events)).alias("e")
    ).select("conv_id", "message", "part", "e.*")
