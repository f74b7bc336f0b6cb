"""Conversations formatted for training, one example for each assistant turn.

Every turn becomes ``<s>[MARK] text`` and the end of its mark, one after the
other. Prefix-target expansion then explodes the assistant turns: an example is
the formatted text of all turns up to and with one reply, of which only that
reply is trainable. If turns follow the last reply, one more row holds the whole
conversation with nothing trainable, so no turn is lost.

Texts can't forge marks. In a text a backslash becomes ``\\b`` and a ``\\e`` is put
inside whatever would read as a mark; ``read_turns`` and ``unescape`` undo it.

Turns are ordered by turn, then role and text, nulls first and null roles and
texts as empty ones; repeated rows are turns of their own; rows without conv_id
form one conversation; an empty table gives no examples; further columns are
left out. A conversation, being one training text, is put together in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosestat.llm.shared import whole

# The template: role, its opening and closing; other roles are named in the mark.
TEMPLATE = {"system": ("<s>[SYS] ", " [/SYS]"), "user": ("<s>[INST] ", " [/INST]"), "assistant": ("<s>[OUT] ", "</s>")}
OTHER = ("<s>[ROLE ", "] ", " [/ROLE]")
MARKS = r"(<(?=/?s>)|\[(?=/?(?:SYS|INST|OUT|ROLE)))"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\b")), MARKS, r"$1\\e")


def unescape(text: Column) -> Column:
    return F.replace(F.replace(F.replace(text, F.lit("\\e"), F.lit("")), F.lit("\\r"), F.lit("]")), F.lit("\\b"), F.lit("\\"))


def opening(role: Column) -> Column:
    other = F.concat(F.lit(OTHER[0]), F.replace(escape(role), F.lit("]"), F.lit("\\r")), F.lit(OTHER[1]))
    for name, (start, _) in TEMPLATE.items():
        other = F.when(role == name, start).otherwise(other)
    return other


def closing(role: Column) -> Column:
    end = F.lit(OTHER[2])
    for name, (_, close) in TEMPLATE.items():
        end = F.when(role == name, close).otherwise(end)
    return end


def examples(df: DataFrame) -> DataFrame:
    """conv_id, example (from 0), text, loss_start and loss_end (code points, end exclusive; equal: nothing trainable), whole_text.

    whole_text marks the one example of a conversation that holds all its turns.
    """
    turns = df.select(F.col("conv_id"), F.col("turn"), whole("role").alias("role"), whole("text").alias("text"))
    made = turns.select("conv_id", F.struct("turn", "role", "text").alias("order"), F.struct(
        (F.col("role") == "assistant").alias("reply"), opening(F.col("role")).alias("open"), escape(F.col("text")).alias("body"), closing(F.col("role")).alias("close")).alias("piece"))
    rows = made.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("order", "piece"))).alias("all")).select(
        "conv_id", F.transform("all", lambda x: x["piece"]).alias("pieces"))
    rows = rows.select("conv_id", "pieces", F.transform("pieces", lambda p: F.concat(p["open"], p["body"], p["close"])).alias("parts"), F.size("pieces").alias("n"))
    last = F.filter(F.transform("pieces", lambda p, i: F.struct((p["reply"] | (i == F.col("n") - 1)).alias("take"), p["reply"].alias("reply"), i.alias("at"))), lambda x: x["take"])
    exploded = rows.select("*", F.posexplode(last).alias("example", "target"))
    text = F.array_join(F.slice("parts", F.lit(1), F.col("target.at") + 1), "")
    piece = F.get("pieces", F.col("target.at"))
    out = exploded.select("conv_id", "example", text.alias("text"), F.col("target.reply").alias("reply"), piece.alias("piece"), (F.col("target.at") == F.col("n") - 1).alias("whole_text"))
    end = F.length("text") - F.when(F.col("reply"), F.length("piece.close")).otherwise(0)
    return out.select("conv_id", "example", "text", (end - F.when(F.col("reply"), F.length("piece.body")).otherwise(0)).alias("loss_start"),
                      end.alias("loss_end"), "whole_text")


def read_turns(text: Column) -> Column:
    """The (role, text) pairs of a formatted text, read back from its marks."""
    def turn(part: Column) -> Column:
        role = F.when(part.startswith(OTHER[0]), unescape(F.regexp_extract(part, r"^<s>\[ROLE ([^\]]*)\] ", 1)))
        body = F.when(part.startswith(OTHER[0]), F.regexp_extract(part, r"(?s)^<s>\[ROLE [^\]]*\] (.*) \[/ROLE\]$", 1))
        for name, (start, close) in TEMPLATE.items():
            role = F.when(part.startswith(start), name).otherwise(role)
            body = F.when(part.startswith(start), F.substring(part, F.lit(len(start) + 1), F.length(part) - len(start) - len(close))).otherwise(body)
        return F.struct(role.alias("role"), unescape(body).alias("text"))

    return F.transform(F.filter(F.split(text, r"(?=<s>\[)"), lambda p: p != ""), turn)


def trainable(text: Column, start: Column, end: Column) -> Column:
    return unescape(F.substring(text, start + 1, end - start))
