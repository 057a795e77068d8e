"""Chat formatting: event logs of conversations are folded into final messages and rendered with a loss mask.

Events have the columns conv_id, seq, msg_id, kind, role, text. Kinds: ``message`` opens a message or replaces it whole,
``delta`` adds streamed text, ``edit`` replaces the text, ``regenerate`` empties the message and drops the messages that
were opened after it and before the event, ``delete`` removes the message. All of it is DataFrame work: no Python runs on executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Strings around a turn. ``controls`` are the strings that texts may not hold unescaped.

    Escaping adds one backslash after the first character of a control string (or of one that is already escaped), so
    taking one away restores the text. A control string begins with ``<`` or ``[``.
    """

    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    controls: tuple[str, ...] = ("<|im_start|>", "<|im_end|>", "<|endoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
    loss_roles: tuple[str, ...] = ("assistant",)



def escape(text: Column, template: ChatTemplate) -> Column:
    """Texts with every control string made harmless; ``unescape`` gives the text back exactly."""
    pattern = "|".join(f"(?<={re.escape(c[0])})(?=\\\\*{re.escape(c[1:])})" for c in template.controls)
    return F.regexp_replace(text, pattern, r"\\")


def unescape(text: Column, template: ChatTemplate) -> Column:
    pattern = "|".join(f"(?<={re.escape(c[0])})\\\\(?=\\\\*{re.escape(c[1:])})" for c in template.controls)
    return F.regexp_replace(text, pattern, "")


def _escape_role(role: Column, template: ChatTemplate) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), template)


def _unescape_role(role: Column, template: ChatTemplate) -> Column:
    return F.replace(F.replace(unescape(role, template), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


#: Events above which a conversation is large and spread over tasks. Large ones are at most LARGE_LIST, whatever the input.
LARGE, LARGE_LIST = 1024, 10_000
_KINDS = ("delete", "delta", "edit", "regenerate")


def _events(events: DataFrame) -> DataFrame:
    return events.select(
        "conv_id", "msg_id", "seq", F.when(F.col("kind").isin(*_KINDS), F.col("kind")).otherwise("message").alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )


def large_conversations(events: DataFrame, least: int = LARGE) -> DataFrame:
    """conv_id of conversations with more than ``least`` events, and more than one in LARGE_LIST of all; so at most LARGE_LIST rows.

    Only conv_id is read and counts are summed in each task first.
    """
    sizes = events.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > least)
    return sizes.where(F.col("n") * LARGE_LIST > events.select(F.count(F.lit(1))).scalar()).select("conv_id")


def _message(parts: Column) -> Column:
    """Struct (pos, regen, alive, role, text) of one message from its events in order."""
    last = F.aggregate(parts, F.struct(F.lit(0).alias("i"), F.lit(1).alias("from")), lambda a, p: F.struct((a["i"] + 1).alias("i"), F.when(p["kind"] != "delta", a["i"] + 1).otherwise(a["from"]).alias("from")))["from"]
    kept = F.slice(parts, last, F.size(parts))
    text = F.array_join(F.transform(kept, lambda p: F.when(p["kind"] == "regenerate", "").otherwise(p["text"])), "")
    told = F.filter(parts, lambda p: p["kind"] == "message")
    role = F.when(F.size(told) > 0, F.element_at(told, -1)["role"]).otherwise(F.array_max(F.transform(parts, lambda p: p["role"])))
    regen = F.array_max(F.transform(parts, lambda p: F.when(p["kind"] == "regenerate", p["seq"])))
    return F.struct(F.array_min(F.transform(parts, lambda p: F.struct(p["seq"].alias("s"))))["s"].alias("pos"), regen.alias("regen"), (F.element_at(kept, 1)["kind"] != "delete").alias("alive"), role.alias("role"), text.alias("text"))


def _fold_small(e: DataFrame) -> DataFrame:
    """Messages of conversations that are not large, dealt once by conv_id; every later step keeps that partitioning."""
    m = e.repartition("conv_id").groupBy("conv_id", "msg_id").agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("parts"))
    m = m.select("conv_id", "msg_id", _message(F.col("parts")).alias("m")).select("conv_id", "msg_id", "m.*")
    earlier = Window.partitionBy("conv_id").orderBy(F.col("pos").asc_nulls_first(), F.col("msg_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    dropped = F.coalesce(F.max("regen").over(earlier) > F.col("pos"), F.lit(False))
    return m.withColumn("dropped", dropped).where(~F.col("dropped") & F.col("alive")).select("conv_id", "pos", "msg_id", "role", "text")


def _fold_large(e: DataFrame, span: int) -> DataFrame:
    """Messages of large conversations: what decides about them is found without texts; only texts that stand are dealt, by message.

    Which messages later regenerations drop is a running maximum over chunks of ``span`` messages and then over chunk totals. Places
    come from counts of the conversation's messages, so sparse seq (timestamps) make no small chunks.
    """
    by_message = ["conv_id", "msg_id"]
    keys = e.groupBy(*by_message).agg(
        F.max(F.when(F.col("kind") != "delta", F.struct("seq", "kind"))).alias("reset"), F.min(F.struct("seq"))["seq"].alias("pos"),
        F.max(F.when(F.col("kind") == "message", F.struct("seq", "role")))["role"].alias("role_at"), F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).alias("regen"), F.max("role").alias("any_role"),
    )
    # the conversation's messages in order, cut at the positions of every `span`-th: bounds are found on hashed samples of positions
    bounds = keys.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("least"), F.max("pos").alias("most"), F.percentile_approx("pos", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(2000)).alias("cuts"))
    k = keys.join(F.broadcast(bounds.select(F.col("conv_id").alias("c"), "n", "cuts")), F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    k = k.withColumn("chunk", F.when(F.col("n") > span, F.size(F.filter("cuts", lambda c: c < F.col("pos")))).otherwise(0)).drop("cuts", "n")
    place = [F.col("pos").asc_nulls_first(), F.col("msg_id").asc_nulls_first()]
    inner = Window.partitionBy("conv_id", "chunk").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    k = k.withColumn("own_before", F.max("regen").over(inner))
    outer = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = k.groupBy("conv_id", "chunk").agg(F.max("regen").alias("top")).withColumn("before", F.max("top").over(outer)).drop("top")
    # 64 rows for each of at most LARGE_LIST conversations
    k = k.alias("k").join(chunks.alias("c"), F.col("k.conv_id").eqNullSafe(F.col("c.conv_id")) & (F.col("k.chunk") == F.col("c.chunk"))).select("k.*", "c.before")
    gone = F.coalesce(F.greatest("own_before", "before") > F.col("pos"), F.lit(False)) | F.coalesce(F.col("reset.kind") == "delete", F.lit(False))
    k = k.where(~gone).select(F.col("conv_id").alias("c"), F.col("msg_id").alias("g"), "pos", "reset", F.coalesce("role_at", "any_role").alias("r"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("msg_id").eqNullSafe(F.col("g"))
    stands = F.col("reset").isNull() | (F.struct("seq", "kind") >= F.col("reset"))
    t = e.join(k.hint("merge"), same).where(stands).groupBy("c", "g").agg(F.first("pos").alias("pos"), F.first("r").alias("role"), F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("parts"))
    return t.select(F.col("c").alias("conv_id"), "pos", F.col("g").alias("msg_id"), "role", _message(F.col("parts"))["text"].alias("text"))


def fold_events(events: DataFrame, span: int = 256, large: int = LARGE) -> DataFrame:
    """Final messages of each conversation: conv_id, pos (opening seq), msg_id, role, text.

    Events of a message are ordered by (seq, kind, role, text), nulls first; the last ``message``, ``edit`` or ``regenerate`` and what
    follows it make its text. Conversations of up to ``large`` events are dealt once by conv_id. Larger ones (see
    ``large_conversations``) are spread over tasks: resets, regenerations and deletions are found without texts, in chunks of about
    ``span`` messages or a 64th of the conversation, and only texts that stand move. Null role or text: empty; null seq: before all others;
    events with a null conv_id are one conversation, and those with a null msg_id one message of theirs; unknown or null kinds count as
    ``message``. Repeated rows repeat (a repeated delta is added twice). No events: empty. Extra columns are ignored.
    """
    small, big = _split(events, large)
    return _fold_small(small).unionByName(_fold_large(big, span))


def _split(events: DataFrame, large: int) -> tuple[DataFrame, DataFrame]:
    e = _events(events)
    named = F.broadcast(large_conversations(e, large).select(F.col("conv_id").alias("c")))
    return tuple(e.join(named, F.col("conv_id").eqNullSafe(F.col("c")), how).select(*e.columns) for how in ("left_anti", "left_semi"))


def _turns(messages: DataFrame, template: ChatTemplate) -> DataFrame:
    head = F.concat(F.lit(template.turn_open), _escape_role(F.col("role"), template), F.lit(template.role_end))
    m = messages.select("conv_id", "pos", "msg_id", "role", "text", F.col("role").isin(*template.loss_roles).alias("learned"), head.alias("head"), escape(F.col("text"), template).alias("body"))
    m = m.withColumns({"turn": F.concat("head", "body", F.lit(template.turn_close)), "h": F.length("head"), "b": F.length("body")})
    return m.withColumn("n", F.length("turn")).drop("head", "body")


def _place() -> list[Column]:
    return [F.col("pos").asc_nulls_first(), "role", "text", F.col("msg_id").asc_nulls_first()]


def _span_of(at: Column, r: Column) -> Column:
    return F.struct(
        (at + r["start"]).alias("start"), F.when(r["learned"], at + r["start"] + r["h"]).alias("loss_start"),
        F.when(r["learned"], at + r["start"] + r["h"] + r["b"]).alias("loss_end"),
    )


def _render_small(messages: DataFrame, template: ChatTemplate) -> DataFrame:
    """One sorted pass over partitions by conv_id, which the messages keep from their folding."""
    order = Window.partitionBy("conv_id").orderBy(*_place())
    start = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = _turns(messages, template).withColumns({"i": F.row_number().over(order), "start": start})
    c = m.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("i", "start", "learned", "h", "b", "turn"))).alias("rows"))
    return c.select("conv_id", F.array_join(F.col("rows.turn"), "").alias("formatted"), F.transform("rows", lambda r: _span_of(F.lit(0).cast("long"), r)).alias("turns"))


def _render_large(messages: DataFrame, template: ChatTemplate, span: int) -> DataFrame:
    """Turns are joined within chunks; a conversation's last step gets one row per chunk."""
    m = _turns(messages, template)
    cuts = m.groupBy("conv_id").agg(F.count(F.lit(1)).alias("k"), F.percentile_approx("pos", F.array(*[F.lit(i / 64) for i in range(1, 64)]), F.lit(2000)).alias("cuts"))
    m = m.join(F.broadcast(cuts.withColumnRenamed("conv_id", "c")), F.col("conv_id").eqNullSafe(F.col("c")))
    m = m.withColumn("chunk", F.when(F.col("pos").isNull() | (F.col("k") <= span), -1).otherwise(F.size(F.filter("cuts", lambda x: x < F.col("pos"))))).drop("c", "k", "cuts")
    inner = Window.partitionBy("conv_id", "chunk").orderBy(*_place())
    start = F.coalesce(F.sum("n").over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    m = m.withColumns({"start": start, "i": F.row_number().over(inner)})
    c = m.groupBy("conv_id", "chunk").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct("i", "start", "learned", "h", "b", "turn"))).alias("rows"))
    c = c.select("conv_id", "chunk", "n", F.array_join(F.col("rows.turn"), "").alias("text"), F.transform("rows", lambda r: r.dropFields("turn")).alias("rows"))
    outer = Window.partitionBy("conv_id").orderBy("chunk")
    c = c.withColumn("at", F.coalesce(F.sum("n").over(outer.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    c = c.select("conv_id", "at", "text", F.transform("rows", lambda r: _span_of(F.col("at"), r)).alias("turns"))
    c = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "text", "turns"))).alias("chunks"))
    return c.select("conv_id", F.array_join(F.col("chunks.text"), "").alias("formatted"), F.flatten(F.col("chunks.turns")).alias("turns"))


def render(messages: DataFrame, template: ChatTemplate = ChatTemplate(), span: int = 64, large: int = LARGE) -> DataFrame:
    """One row per conversation: conv_id, formatted, turns.

    ``turns`` is an array of (start, loss_start, loss_end): code-point offsets of each turn and of the text under the loss
    mask (nulls where a turn is not learned). Ties on pos are ordered by role, text and msg_id; nulls come first. Conversations of up to ``large``
    messages are dealt once; larger ones are joined within chunks first (up to 64, if they have more than ``span`` messages).
    """
    m = messages.select("conv_id", "pos", "msg_id", "role", "text")
    named = F.broadcast(large_conversations(m, large).select(F.col("conv_id").alias("c")))
    small, big = (m.join(named, F.col("conv_id").eqNullSafe(F.col("c")), how).select(*m.columns) for how in ("left_anti", "left_semi"))
    return _render_small(small, template).unionByName(_render_large(big, template, span))


def format_conversations(events: DataFrame, template: ChatTemplate = ChatTemplate(), large: int = LARGE) -> DataFrame:
    """Fold event logs and render them: conv_id, formatted, turns. See ``fold_events`` and ``render`` for edge cases.

    Whether a conversation is large is decided once, by its events, so the texts of all others are dealt once for both steps.
    """
    small, big = _split(events, large)
    return _render_small(_fold_small(small), template).unionByName(_render_large(_fold_large(big, 256), template, 64))


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """Turns parsed from the formatted text alone, and the learned texts cut out by the mask, unescaped.

    Returns conv_id, formatted, read (array of role, text) and learned (array of texts). A conversation without turns
    has empty arrays. Each turn is parsed from its own piece, so the work grows with the length of the text.
    """
    cut = F.split("formatted", re.escape(template.turn_open))
    pieces = F.slice(cut, 2, F.greatest(F.size(cut) - 1, F.lit(0)))

    def turn(p: Column) -> Column:
        at = F.position(F.lit(template.role_end), p)
        return F.struct(
            _unescape_role(F.substring(p, F.lit(1), at - 1), template).alias("role"),
            unescape(F.substring(p, at + len(template.role_end), F.length(p) - at + 1 - len(template.role_end) - len(template.turn_close)), template).alias("text"),
        )

    skip = len(template.turn_open)
    masked = F.filter(
        F.transform(F.arrays_zip(pieces.alias("p"), F.col("turns").alias("t")), lambda z: F.when(
            z["t"]["loss_start"].isNotNull(),
            F.substring(z["p"], (z["t"]["loss_start"] - z["t"]["start"] - skip + 1).cast("int"), (z["t"]["loss_end"] - z["t"]["loss_start"]).cast("int")),
        )),
        lambda x: x.isNotNull(),
    )
    return formatted.select("conv_id", "formatted", F.transform(pieces, turn).alias("read"), F.transform(masked, lambda x: unescape(x, template)).alias("learned"))
