"""Chat formatting with DataFrame expressions only.

A conversation becomes one string. Adjacent turns of one role share a block:

    <turn assistant>first text<part>second text</turn>\\n

Control strings inside texts are escaped: a ``<``, any number of backslashes
and then ``turn``, ``/turn`` or ``part`` gets one backslash more, which reading
back takes away. All other text stays as it is, so code and mark-up are not
disturbed. In roles ``\\``, ``<``, ``>`` become ``\\s``, ``\\l``, ``\\g``.

``loss_spans`` holds character ranges of the formatted string that training
should predict: the escaped texts of the trained role, without any marker.

Defined cases: a null text or role counts as empty; equal ``turn`` numbers are
ordered by role, then text; repeated rows are repeated turns; a null
``conv_id`` is a conversation of its own; extra columns are ignored. One
conversation is one row, so its turns meet in one task by definition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"
CLOSE = "</turn>\n"
PART = "<part>"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)(turn|/turn|part)", r"<\\$1$2")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)(turn|/turn|part)", "<$1$2")


def escaped_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\"), F.lit("\\s")), F.lit("<"), F.lit("\\l")),
                     F.lit(">"), F.lit("\\g"))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\g"), F.lit(">")), F.lit("\\l"), F.lit("<")),
                     F.lit("\\s"), F.lit("\\"))


def formatted(turns: DataFrame, trained_role: str = TRAINED_ROLE) -> DataFrame:
    """``(conv_id, formatted, loss_spans)`` from rows ``(conv_id, turn, role,
    text)``; a span has ``start`` (from 0) and ``length`` in characters."""
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")))).alias("turns"))

    def piece(t: Column, i: Column) -> Column:
        """What a turn adds: a new block's opening, or a part of the block that
        its neighbour of the same role has opened."""
        opening = F.concat(F.lit("<turn "), escaped_role(t["role"]), F.lit(">"))
        before = F.get("turns", i - 1)["role"]
        head = F.when(before == t["role"], F.lit(PART)).when(i > 0, F.concat(F.lit(CLOSE), opening)).otherwise(opening)
        return F.struct(head.alias("head"), escaped(t["text"]).alias("text"),
                        (t["role"] == trained_role).alias("trained"))

    def add_span(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["head"])
        span = F.struct(start.alias("start"), F.length(x["text"]).alias("length"))
        return F.struct((start + F.length(x["text"])).alias("at"),
                        F.when(x["trained"], F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    whole = whole.select("conv_id", F.transform("turns", piece).alias("pieces"))
    text = F.concat(F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["text"])), ""), F.lit(CLOSE))
    none = F.expr("struct(0 as at, cast(array() as array<struct<start:int,length:int>>) as spans)")
    spans = F.aggregate("pieces", none, add_span, lambda done: done["spans"])
    return whole.select("conv_id", text.alias("formatted"), spans.alias("loss_spans"))


def parsed(conversations: DataFrame) -> DataFrame:
    """``conversations`` with ``turns`` (role and text of every turn) and
    ``loss_texts`` read back from ``formatted`` and ``loss_spans``."""
    def turns_of(block: Column) -> Column:
        end = F.instr(block, ">")
        role = unescaped_role(F.substring(block, F.lit(len("<turn ") + 1), end - len("<turn ") - 1))
        rest = F.substring(block, end + 1, F.length(block))
        return F.transform(F.split(rest, PART), lambda x: F.struct(role.alias("role"), unescaped(x).alias("text")))

    blocks = F.split("formatted", CLOSE)
    turns = F.flatten(F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), turns_of))
    texts = F.transform("loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"] + 1, s["length"])))
    return conversations.withColumns({"turns": turns, "loss_texts": texts})
