"""Conversations rebuilt from an event log, then rendered; DataFrame functions only.

Events of a turn are ordered by ``seq`` and folded: ``message``, ``edit`` and ``regenerate`` replace what
the turn held so far, ``delta`` appends, ``delete`` removes the turn (a later ``message``, ``edit``,
``regenerate`` or ``delta`` brings it back). The fold runs on (conversation, turn) first, so a hot
conversation's events are reduced by many tasks; only final messages meet in their conversation.

Template: ``<turn ROLE>TEXT</turn>`` and a line feed for each turn. In roles and texts a backslash becomes
``\\b``, ``<`` becomes ``\\l`` and ``>`` becomes ``\\g``; no text can hold a turn mark, and reading back is exact.
The loss mask is a run for each turn: ``before`` characters of the turn lie outside, then ``inside``
characters, under the mask where ``loss`` (the role is ``assistant``), then ``after`` outside.

Null roles and texts count as empty. Repeated rows of a turn key are events of one turn; ties in ``seq``
are ordered by kind and text. A null conversation id is a conversation of its own. An empty log gives an
empty result. Other columns are ignored. The rendered conversation is one string, so a conversation is
limited by the 2 GB that a Spark string holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, NAME_END, CLOSE = "<turn ", ">", "</turn>\n"


def escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for plain, coded in (("\\", "\\b"), ("<", "\\l"), (">", "\\g")):
        out = F.replace(out, F.lit(plain), F.lit(coded))
    return out


def unescape(c: Column) -> Column:
    for plain, coded in ((">", "\\g"), ("<", "\\l"), ("\\", "\\b")):
        c = F.replace(c, F.lit(coded), F.lit(plain))
    return c


def fold(events: DataFrame, turn_columns: tuple[str, ...] = ("turn",)) -> DataFrame:
    """Final messages of a log (conv_id, turn columns, seq, kind, role, text)."""
    key = ["conv_id", *turn_columns]
    starts = F.col("kind").isin("message", "edit", "regenerate", "delete")
    order = F.struct("seq", "kind", F.coalesce("text", F.lit("")).alias("text"))
    last = F.max(F.when(starts, order)).over(Window.partitionBy(*key))
    held = events.withColumn("_order", order).withColumn("_last", last).where(F.col("_last").isNull() | (F.col("_order") >= F.col("_last")))
    parts = F.transform(F.sort_array(F.collect_list("_order")), lambda e: F.when(e["kind"] == "delete", F.lit("")).otherwise(e["text"]))
    folded = held.groupBy(*key).agg(F.array_join(parts, "").alias("text"), F.max_by("role", "_order").alias("role"), F.max("_order.kind").alias("_k"), F.min("_order.kind").alias("_j"))
    only_deleted = (F.col("_k") == "delete") & (F.col("_j") == "delete")
    return folded.where(~only_deleted).drop("_k", "_j")


def render(messages: DataFrame, turn_columns: tuple[str, ...] = ("turn",)) -> DataFrame:
    """One row for each conversation: ``formatted`` and the loss mask's ``runs``, one for each turn."""
    turns = F.sort_array(F.collect_list(F.struct(*turn_columns, escape(F.col("role")).alias("role"), escape(F.col("text")).alias("text"))))
    shown = lambda m: F.concat(F.lit(OPEN), m["role"], F.lit(NAME_END), m["text"], F.lit(CLOSE))
    run = lambda m: F.struct(
        (F.length(m["role"]) + len(OPEN) + len(NAME_END)).alias("before"), F.length(m["text"]).alias("inside"), F.lit(len(CLOSE)).alias("after"), (m["role"] == "assistant").alias("loss")
    )
    return messages.groupBy("conv_id").agg(turns.alias("turns")).select("conv_id", F.array_join(F.transform("turns", shown), "").alias("formatted"), F.transform("turns", run).alias("runs"))


def parse(formatted: DataFrame) -> DataFrame:
    """Turns (role, text) read back from ``formatted``, and the texts under the mask, in order."""
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    turn = lambda p: F.struct(
        unescape(F.substring(F.substring_index(p, NAME_END, 1), len(OPEN) + 1, 1 << 30)).alias("role"), unescape(p.substr(F.instr(p, NAME_END) + 1, F.length(p))).alias("text")
    )
    masked = F.filter(F.arrays_zip(F.col("_pieces").alias("piece"), F.col("runs").alias("run")), lambda z: z["run"]["loss"])
    under = F.transform(masked, lambda z: unescape(z["piece"].substr(z["run"]["before"] + 1, z["run"]["inside"])))
    return formatted.withColumn("_pieces", pieces).select("conv_id", "formatted", "runs", F.transform("_pieces", turn).alias("turns"), under.alias("loss_texts"))


def digest(parsed: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return parsed.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(told, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars")
    )


def events_of(conversations: DataFrame) -> DataFrame:
    """A table of turns as an event log, as a chat service would have streamed it. An assistant's turn is a draft, its
    regeneration (nothing yet), and the text in two deltas; any other turn is a first message that an edit replaces.
    Rows that share a turn number are turns of their own, ordered by role and text."""
    within = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    text = F.coalesce(F.col("text"), F.lit(""))
    half = F.floor(F.length(text) / 2).cast("int")
    event = lambda seq, kind, t: F.struct(F.lit(seq).alias("seq"), F.lit(kind).alias("kind"), t.alias("text"))
    draft = event(0, "message", F.left(text, F.lit(16)))
    streamed = F.array(draft, event(1, "regenerate", F.lit("")), event(2, "delta", text.substr(F.lit(1), half)), event(3, "delta", text.substr(half + 1, F.length(text))))
    edited = F.array(draft, event(1, "edit", text))
    turns = conversations.select("conv_id", "turn", "role", "text").withColumn("nth", F.row_number().over(within))
    return turns.select("conv_id", "turn", "nth", "role", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(edited)).alias("e")).select("conv_id", "turn", "nth", "role", "e.*")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """Stream, fold, render and read back all conversations of a table (conv_id, turn, role, text)."""
    keys = ("turn", "nth")
    return parse(render(fold(events_of(conversations), keys), keys))


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(15 + length(role) + length(text) + 2 * 0
           + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))
           + length(text) - length(replace(replace(replace(text, '\', ''), '<', ''), '>', '')))::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""
