"""Chat formatting of event-sourced conversations, with DataFrame functions only.

A log has one row per event: ``conv_id, seq, message, kind, role, text``. Kinds:

* ``start``: message ``message`` begins with ``role`` and ``text``;
* ``delta``: ``text`` is appended;
* ``edit``: ``text`` replaces what the message has so far, later deltas are appended to it;
* ``regenerate``: the message's text is thrown away, and all messages after it that began before.

Events are folded by ``seq`` to final messages and these rendered. In the template each turn is
``<|turn|>role``, a line feed, the text and ``<|end|>``; a conversation is enclosed by ``<s>`` and ``</s>``. Control
strings inside roles and texts get a backslash after their first character, and backslashes are doubled before, so
reading back gives the very texts. ``loss`` lists the ranges (code points) of the assistant's texts.

A conversation is one row of the output, so its messages meet in one group, after the deltas of each message have
been folded by a grouping of their own.

Edge cases: NULL texts and roles are empty. Events of equal ``seq`` are ordered by kind and text. A message without
``start`` has an empty role. Rows with a NULL ``conv_id`` are one conversation of that id. Repeated rows of a table
of messages are turns each for itself. Messages without an event left are no turns; an empty log gives no row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BEGIN, TURN, END, STOP, LINE = "<s>", "<|turn|>", "<|end|>", "</s>", "<|line|>"
#: Strings that mean something to this template or others.
CONTROL = [BEGIN, STOP, TURN, END, LINE, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), CONTROL, text)


def unescape(text: Column) -> Column:
    text = reduce(
        lambda t, c: F.replace(t, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c)), reversed(CONTROL), text
    )
    return F.replace(text, F.lit("\\\\"), F.lit("\\"))


#: What stands in drafts that an edit or a regeneration replaces.
DRAFT = "draft <|end|> "


def log_of(messages: DataFrame) -> DataFrame:
    """An event log that comes to the rows of ``conv_id, turn, role, text``, as an application may have written it.

    A hash of a message's place picks how it came about: a start and a delta; a wrong draft, an edit
    that replaces it, and a delta; or a wrong start, a reply to it, a regeneration that throws both away, and two deltas.
    Messages have even numbers, replies thrown away odd ones.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    text = F.coalesce("text", F.lit(""))
    cut = F.floor(F.length(text) / 2).cast("int")
    half, rest = F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text))

    def event(kind: str, said: Column, reply: int = 0) -> Column:
        return F.struct(F.lit(kind).alias("kind"), said.alias("text"), F.lit(reply).alias("reply"))

    draft, nothing = F.concat(F.lit(DRAFT), text), F.lit(None).cast("string")
    way = F.pmod(F.xxhash64("conv_id", "message"), F.lit(4))
    events = (
        F.when(way == 0, F.array(event("start", draft), event("edit", half), event("delta", rest)))
        .when(
            way == 1,
            F.array(
                event("start", draft),
                event("start", F.lit(DRAFT), 1),
                event("regenerate", nothing),
                event("delta", half),
                event("delta", rest),
            ),
        )
        .otherwise(F.array(event("start", half), event("delta", rest)))
    )
    number = (F.col("message") * 2 + F.col("event.reply")).cast("bigint")
    role = F.when(F.col("event.reply") == 1, F.lit("user")).otherwise(F.col("role"))
    return (
        messages.select("conv_id", "turn", "role", "text")
        .withColumn("message", F.row_number().over(order))
        .select("conv_id", "message", "role", F.posexplode(events).alias("at", "event"))
        .select(
            "conv_id",
            (F.col("message") * 8 + F.col("at")).cast("bigint").alias("seq"),
            number.alias("message"),
            "event.kind",
            F.when(F.col("event.kind") == "start", role).alias("role"),
            "event.text",
        )
    )


def fold(log: DataFrame) -> DataFrame:
    """``conv_id, message, role, text``: what the events of each message come to."""
    later = (
        Window.partitionBy("conv_id").orderBy(F.desc("seq")).rangeBetween(Window.unboundedPreceding, -1)
    )
    redone = F.min(F.when(F.col("kind") == "regenerate", F.col("message"))).over(later)
    events = (
        log.withColumn("_redone", redone)
        .filter(F.coalesce(F.col("_redone") >= F.col("message"), F.lit(True)))
        .select("conv_id", "message", "role", F.struct("seq", "kind", "text").alias("event"))
    )
    own = events.groupBy("conv_id", "message").agg(
        F.sort_array(F.collect_list("event")).alias("events"),
        F.max("role").alias("role"),
    )
    # What stands before the last edit or regeneration doesn't count.
    resets = F.filter("events", lambda e: e["kind"].isin("edit", "regenerate"))
    since = F.coalesce(F.array_max(F.transform(resets, lambda e: e["seq"])), F.lit(-(1 << 62)))
    valid = F.filter(
        "events", lambda e: (e["seq"] >= F.col("_since")) & (e["kind"] != "regenerate")
    )
    return own.withColumn("_since", since).select(
        "conv_id",
        "message",
        F.coalesce("role", F.lit("")).alias("role"),
        F.array_join(F.transform(valid, lambda e: F.coalesce(e["text"], F.lit(""))), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss``; ``loss`` has the first code point (from 1) and length of each range."""
    head = F.concat(
        F.lit(TURN), F.replace(escape(F.col("role")), F.lit("\n"), F.lit(LINE)), F.lit("\n")
    )
    turns = messages.select(
        "conv_id",
        F.struct(
            "message",
            head.alias("head"),
            escape(F.col("text")).alias("body"),
            (F.col("role") == LOSS_ROLE).alias("counts"),
        ).alias("turn"),
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "")
    start = F.struct(
        F.lit(len(BEGIN) + 1).cast("bigint").alias("at"),
        F.expr("CAST(array() AS array<struct<first: bigint, length: bigint>>)").alias("loss"),
    )

    def step(state: Column, t: Column) -> Column:
        first = state["at"] + F.length(t["head"])
        size = F.length(t["body"]).cast("bigint")
        own = F.array(F.struct(first.alias("first"), size.alias("length")))
        return F.struct(
            (first + size + len(END)).alias("at"),
            F.when(t["counts"], F.concat(state["loss"], own)).otherwise(state["loss"]).alias("loss"),
        )

    return whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), text, F.lit(STOP)).alias("formatted"),
        F.aggregate("turns", start, step, lambda s: s["loss"]).alias("loss"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``conv_id, turns, loss_texts, formatted``: roles and texts as they were, parsed from the output."""
    inner = F.substring("formatted", F.lit(len(BEGIN) + 1), F.length("formatted") - len(BEGIN + STOP))
    parts = F.filter(F.split(inner, r"<\|turn\|>"), lambda p: p != "")

    def turn(p: Column) -> Column:
        role = F.substring_index(p, "\n", 1)
        size = F.length(role)
        text = F.substring(p, size + 2, F.length(p) - size - 1 - len(END))
        return F.struct(
            unescape(F.replace(role, F.lit(LINE), F.lit("\n"))).alias("role"), unescape(text).alias("text")
        )

    def masked(r: Column) -> Column:
        return unescape(F.substring(F.col("formatted"), r["first"].cast("int"), r["length"].cast("int")))

    return formatted.select(
        "conv_id",
        F.transform(parts, turn).alias("turns"),
        F.transform("loss", masked).alias("loss_texts"),
        "formatted",
    )


def digest(read: DataFrame) -> DataFrame:
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = F.array_join("loss_texts", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )
