"""Training examples from conversations: one per assistant turn, with all turns before it as context.

Every assistant turn becomes an example of its own, whose text is all turns up to it and
whose loss mask is that reply alone. Turns after the last reply form one more example without a mask, so that the
examples hold the whole conversation. ``Template`` says which marks surround a
turn. A mark, or another control string, inside a role or text is escaped by a backslash
after its first character (one more if there are some already), so marks in an example are
always real, and the escape can be undone exactly.

Defined cases. Null text or role is empty. Turns are ordered by number (nulls first), then
role, then text; repeated rows stay. Only the role ``assistant`` is trained on. A null
conversation id is one conversation. An empty table gives no examples. Other columns are
ignored.

Scale: one shuffle by conversation; examples are made row by row after it and are never
shuffled. An example is one value, so a conversation must fit into a row, and the
examples of n turns are as long as n/2 conversations; that is what the format asks for.
All expressions are built-in functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

REPLY = "assistant"


@dataclass(frozen=True)
class Template:
    """The marks of a turn, ``turn role body text end``, and further strings a model may read as control."""

    turn: str = "<|turn|>"
    body: str = "<|text|>"
    end: str = "<|end|>"
    others: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]")

    def __post_init__(self):
        marks = (self.turn, self.body, self.end, *self.others)
        firsts = {m[0] for m in marks if m}
        if any(len(m) < 2 or "\\" in m or firsts & set(m[1:]) for m in marks):
            raise ValueError("control strings have two characters or more, no backslash, and begin with characters they don't have elsewhere")

    def _first_of_control(self, backslashes: str) -> str:
        """A pattern of the first character of a control string with so many backslashes after it."""
        marks = (self.turn, self.body, self.end, *self.others)
        rests: dict[str, list[str]] = {}
        for mark in marks:
            rests.setdefault(mark[0], []).append(re.escape(mark[1:]))
        return "(" + "|".join(f"{re.escape(f)}(?={backslashes}(?:{'|'.join(r)}))" for f, r in rests.items()) + ")"

    def escaped(self, text: Column) -> Column:
        return F.regexp_replace(text, self._first_of_control(r"\\*"), r"$1\\")

    def plain(self, text: Column) -> Column:
        return F.regexp_replace(text, self._first_of_control(r"\\+") + r"\\", "$1")


def examples(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """conv_id, example (from 1), is_last, text, loss_start and loss_length (in code points; 0 and 0 without a mask)."""
    text = lambda name: F.coalesce(F.col(name), F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", text("role").alias("role"), text("text").alias("text")).alias("t"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    escaped = whole.select("conv_id", F.transform("turns", lambda t: F.struct(
        (t["role"] == REPLY).alias("reply"),
        F.concat(F.lit(template.turn), template.escaped(t["role"]), F.lit(template.body)).alias("head"),
        template.escaped(t["text"]).alias("text"))).alias("turns"))
    parts = F.transform("turns", lambda t: F.concat(t["head"], t["text"], F.lit(template.end)))
    ends = F.filter(F.transform("turns", lambda t, i: F.when(t["reply"] | (i + 1 == F.size("turns")), i + 1)), lambda i: i.isNotNull())
    cut = escaped.select("conv_id", "turns", parts.alias("parts"), ends.alias("ends"))
    each = cut.select("conv_id", "turns", "parts", F.size("ends").alias("n"), F.posexplode("ends").alias("example", "end"))
    target = F.element_at("turns", F.col("end"))
    start = F.char_length(F.array_join(F.slice("parts", F.lit(1), F.col("end") - 1), "")) + F.char_length(target["head"])
    return each.select(
        "conv_id", (F.col("example") + 1).alias("example"), (F.col("example") + 1 == F.col("n")).alias("is_last"),
        F.array_join(F.slice("parts", F.lit(1), F.col("end")), "").alias("text"),
        F.when(target["reply"], start).otherwise(0).alias("loss_start"),
        F.when(target["reply"], F.char_length(target["text"])).otherwise(0).alias("loss_length"))


def turns_in(text: Column, template: Template = Template()) -> Column:
    """The turns of an example, an array of structs of role and text, read from its marks."""
    pieces = F.split(text, re.escape(template.end))
    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.struct(
        template.plain(F.substr(F.substring_index(p, template.body, 1), F.lit(len(template.turn) + 1))).alias("role"),
        template.plain(F.substring_index(p, template.body, -1)).alias("text")))


def trained_on(text: str | Column = "text", template: Template = Template()) -> Column:
    """The text under an example's loss mask, without escapes."""
    return template.plain(F.substr(text, F.col("loss_start") + 1, F.col("loss_length")))


def digest(examples: DataFrame, template: Template = Template()) -> DataFrame:
    """What can be read back from the examples of each conversation; texts of contexts aren't shuffled."""
    read = examples.select(
        "conv_id", "example", F.char_length("text").cast("long").alias("chars"), trained_on("text", template).alias("reply"),
        F.when(F.col("is_last"), turns_in(F.col("text"), template)).alias("turns"))
    read = read.select("conv_id", "example", "chars", "reply", F.size("turns").cast("long").alias("n"), F.sha2(F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("hash"))
    whole = read.groupBy("conv_id").agg(
        F.max("n").alias("n_turns"), F.max("hash").alias("turns_sha256"), F.sum("chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("example", "reply"))).alias("replies"))
    trained = F.array_join(F.col("replies.reply"), "")
    return whole.select(
        "conv_id", "n_turns", "turns_sha256", F.char_length(trained).cast("long").alias("loss_chars"),
        F.sha2(trained, 256).alias("loss_sha256"), "formatted_chars")


def with_control_strings(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of ``turns`` and of a conversation -7 whose texts hold control strings."""
    said = "</s>[INST] ok [/INST]"
    more = turns.sparkSession.range(2).select(
        F.lit(-7).cast(turns.schema["conv_id"].dataType).alias("conv_id"), F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY).alias("role"), F.lit(said).alias("text"))
    return turns.select("conv_id", "turn", "role", "text").unionByName(more)
