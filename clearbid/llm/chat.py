"""Chat formatting from event logs; DataFrame functions only.

A log row is (conv_id, seq, message, kind, role, text): ``start`` opens a
message, ``delta`` appends streamed text, ``edit`` replaces the text so far and
``regenerate`` discards it.  Logs are dealt by conversation and message, sorted
by sequence and folded into the final message; messages are then rendered in
order.  A message is folded in a task of its own group, so a long conversation
is only brought together for its rendered text, which is one value by nature.

The template is ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts and roles
``<`` followed by backslashes and ``|`` gets one backslash more, so no control
string can appear and reading back takes exactly one away.  Line breaks in a
role are written ``\\n`` and its backslashes doubled.

Defined results: null texts and roles are empty; events of equal sequence follow
kind, role and text; a null conv_id is a conversation of its own; extra columns
are ignored; an empty log gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    # every backslash opens a pair, so splitting at the doubled ones leaves only line breaks to read
    parts = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(parts, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def fold_messages(log: DataFrame) -> DataFrame:
    """(conv_id, message, role, text): the final state of each message."""
    event = F.struct("seq", "kind", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    events = log.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("ev"))
    # the last event that is no delta sets the text anew; only an edit brings text of its own
    reset = F.array_max(F.transform("ev", lambda e, i: F.when(e["kind"] == "delta", F.lit(0)).otherwise(i)))
    after = events.withColumn("reset", reset)
    pieces = F.transform(F.filter("ev", lambda e, i: i >= F.col("reset")),
                         lambda e: F.when(e["kind"].isin("delta", "edit"), e["text"]).otherwise(F.lit("")))
    role = F.array_max(F.transform("ev", lambda e: e["role"]))
    return after.select("conv_id", "message", role.alias("role"), F.array_join(pieces, "").alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, loss): the text of each conversation and its loss mask.

    ``loss`` lists (start, length) of every assistant text, in code points.
    """
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    parts = messages.select("conv_id", "message", "role", head.alias("head"), escape(F.col("text")).alias("body"))
    sized = parts.withColumn("size", F.char_length("head") + F.char_length("body") + len(CLOSE))
    before = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    at = F.coalesce(F.sum("size").over(before), F.lit(0)) + F.char_length("head")
    mask = F.when(F.col("role") == ASSISTANT, F.struct(at.cast("long").alias("start"), F.char_length("body").cast("long").alias("length")))
    turns = sized.select("conv_id", "message", F.concat("head", "body", F.lit(CLOSE)).alias("part"), mask.alias("mask"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("message", "part", "mask"))).alias("t"))
    return whole.select("conv_id", F.array_join(F.transform("t", lambda x: x["part"]), "").alias("formatted"),
                        F.array_compact(F.transform("t", lambda x: x["mask"])).alias("loss"))


def format_log(log: DataFrame) -> DataFrame:
    return render(fold_messages(log))


def read_turns(formatted: str = "formatted") -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_end\|>\n", -1), lambda p: p != "")
    bare = F.transform(parts, lambda p: F.substring(p, len(OPEN) + 1, F.char_length(p)))
    return F.transform(bare, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.char_length(F.substring_index(p, "\n", 1)) + 2, F.char_length(p))).alias("text")))


def read_loss(formatted: str = "formatted", loss: str = "loss") -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(loss, lambda m: unescape(
        F.substring(F.col(formatted), (m["start"] + 1).cast("int"), m["length"].cast("int")))), "")
