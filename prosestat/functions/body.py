"""The body of a book: the text between its marker lines.

Three modes: ``strict`` (word frequency, sentiment), ``lenient`` (syntactic
metrics) and ``none`` for text that carries no markers. Everything is string
cutting within one row, so no line array is built and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from prosestat.constants import LENIENT_END, LENIENT_START, STRICT_END, STRICT_START
from prosestat.functions.text import let

MARKERS = {"strict": (STRICT_START, STRICT_END), "lenient": (LENIENT_START, LENIENT_END)}


def body_text(text: Column | str, mode: str) -> Column:
    """Lines after the first START line and before the next END line, else ''.

    Without a START line there is no body; without an END line the body runs to
    the end of the text. An END line above the START line has no effect.
    """
    if mode == "none":
        return F.coalesce(text, F.lit(""))
    start, end = MARKERS[mode]
    from_start = F.get(F.split(text, start, 2), F.lit(1))
    below = F.get(F.split(from_start, "\n", 2), F.lit(1))

    def above_end(cut: Column) -> Column:
        head = F.get(cut, F.lit(0))
        # The END line begins after the last line end of what stands before the marker.
        begun = F.length(F.substring_index(head, "\n", -1))
        return F.when(F.size(cut) == 2, F.left(head, F.length(head) - begun)).otherwise(head)

    return F.coalesce(let(F.split(below, end, 2), above_end), F.lit(""))


def body_lines(text: Column | str, mode: str) -> Column:
    """The body as an array of lines; only ``\\n`` ends a line."""
    body = body_text(text, mode)
    closed = F.regexp_replace(body, r"\n\z", "")
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(closed, "\n", -1))
