"""Chat formatting by event-sourced reconstruction, in DataFrame functions only.

A conversation is a log of events with a sequence number: ``message`` opens a turn, ``delta``
appends text to it, ``edit`` replaces its text, ``regenerate`` empties it for what follows. Logs are
partitioned by conversation, sorted by sequence and folded turn by turn: the last edit or
regeneration of a turn decides where its text starts, and the deltas after it are appended in
order. The messages are then rendered to one template text with a loss mask over assistant text.

Template, per turn: ``<|im_start|>`` role, line feed, text, ``<|im_end|>``, line feed. In roles and
texts ``<|`` is written ``<\\|`` and ``<\\`` is written ``<\\\\``, so no text can hold a control string,
and taking one backslash after each ``<`` back restores it; roles write line feeds as ``<\\n``.

Null texts and roles are empty; events of a null conversation form one. A null turn of a log comes
first. Plain rows (``messages``) are one turn each, also when they share a turn number or have
none; null turns come last there, as in the SQL twin. Events of a log that agree in sequence are ordered by kind, role and text, so repeated rows give
the same result on every run; a repeated message event repeats its text. Folding reduces per
turn before conversations are put together; a conversation is one row, so its text must
fit a row. Columns other than the named ones are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END = "<|im_start|>", "<|im_end|>"
KINDS = ("message", "delta", "edit", "regenerate")


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\"), F.lit("<\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("<\\\\"), F.lit("<\\"))


def fold(events: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``: the final messages of ``(conv_id, turn, seq, kind, role,
    text)``. A turn's role is that of its first event that has one."""
    text = F.coalesce("text", F.lit(""))
    event = F.struct("seq", F.element_at(
        F.create_map(*[x for i, k in enumerate(KINDS) for x in (F.lit(k), F.lit(i))]),
        F.col("kind")).alias("order"), F.coalesce("role", F.lit("")).alias("role"),
        text.alias("text"), F.col("kind").isin("edit", "regenerate").alias("restart"),
        (F.col("kind") == "regenerate").alias("empty"))
    turns = events.groupBy("conv_id", "turn").agg(F.array_sort(F.collect_list(event)).alias("log"))
    last = F.aggregate(F.sequence(F.lit(1), F.size("log")), F.lit(1), lambda at, i: F.when(
        F.element_at("log", i)["restart"], i).otherwise(at))
    live = F.slice(F.col("log"), last, F.size("log") - last + 1)
    body = F.array_join(F.transform(live, lambda e: F.when(e["empty"], F.lit("")).otherwise(
        e["text"])), "")
    roles = F.filter(F.transform("log", lambda e: e["role"]), lambda r: r != "")
    return turns.select("conv_id", "turn", F.coalesce(F.try_element_at(roles, F.lit(1)), F.lit(""))
                        .alias("role"), body.alias("text"))


def messages(conversations: DataFrame) -> DataFrame:
    """Events of plain ``(conv_id, turn, role, text)`` rows: each row is one message and opens its
    own turn, a struct that sorts by turn (null last), role and a hash of the text.

    System comes first in a turn, then user, other roles and assistant. The row's number tells
    equal rows apart; which of them has which number changes nothing."""
    role = F.coalesce("role", F.lit(""))
    place = F.when(role == "system", 0).when(role == "user", 1).when(
        role == "assistant", 3).otherwise(2)
    turn = F.struct(F.col("turn").isNull().alias("none"), F.col("turn").alias("turn"),
                    place.alias("place"), role.alias("role"), F.xxhash64("text").alias("text"),
                    F.monotonically_increasing_id().alias("row"))
    return conversations.select("conv_id", turn.alias("turn"), F.col("turn").alias("seq"),
                                F.lit("message").alias("kind"), "role", "text")


def render(turns: DataFrame) -> DataFrame:
    """``(conv_id, formatted, mask)``; ``mask`` has ``(start, length)`` of each assistant text in
    ``formatted``, counted from 0 in code points, in order."""
    def escaped(name: str) -> Column:
        return escape(F.coalesce(name, F.lit("")))

    role = F.replace(escaped("role"), F.lit("\n"), F.lit("<\\n"))
    head = F.concat(F.lit(START), role, F.lit("\n"))
    piece = F.struct("turn", head.alias("head"), escaped("text").alias("body"),
                     (F.coalesce("role", F.lit("")) == "assistant").alias("loss"))
    logs = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(piece)).alias("log"))
    tail = END + "\n"
    parts = F.transform("log", lambda p: F.concat(p["head"], p["body"], F.lit(tail)))
    spans = F.aggregate(
        F.col("log"),
        F.struct(F.lit(0).cast("long").alias("at"),
                 F.array().cast("array<struct<start:bigint,length:bigint>>").alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(tail)).alias("at"),
            F.when(p["loss"], F.array_append(acc["spans"], F.struct(
                (acc["at"] + F.length(p["head"])).alias("start"),
                F.length(p["body"]).cast("long").alias("length")))).otherwise(acc["spans"])
            .alias("spans")),
        lambda acc: acc["spans"])
    return logs.select("conv_id", F.array_join(parts, "").alias("formatted"), spans.alias("mask"))


def parse(formatted: Column) -> Column:
    """``array<struct<role, text>>`` read back from a rendered text."""
    pieces = F.split(formatted, r"<\|im_start\|>")
    pieces = F.slice(pieces, F.lit(2), F.size(pieces))

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, "\n")
        role = F.substr(piece, F.lit(1), cut - 1)
        body = F.substr(piece, cut + 1, F.length(piece) - cut - len(END) - 1)
        return F.struct(unescape(F.replace(role, F.lit("<\\n"), F.lit("\n"))).alias("role"),
                        unescape(body).alias("text"))
    return F.transform(pieces, turn)


def masked(formatted: Column, mask: Column) -> Column:
    """The text under the loss mask, unescaped: assistant texts in order, nothing between."""
    return F.array_join(F.transform(mask, lambda s: unescape(F.substr(
        formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")
