"""Bodies of books, from whole texts or from lines read in splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosestat.constants import MARKER_SIGN
from prosestat.functions.body import MARKERS, body_lines, body_text


def cut_body(books: DataFrame, mode: str) -> DataFrame:
    """``books`` with ``text`` replaced by its body."""
    return books.withColumn("text", body_text("text", mode))


def explode_lines(books: DataFrame, mode: str) -> DataFrame:
    """``(book_id, line_no, line)`` of each body, numbered from 0."""
    return books.select("book_id", F.posexplode(body_lines("text", mode)).alias("line_no", "line"))


def bodies_of_lines(lines: DataFrame, modes: tuple[str, ...] = ("strict", "lenient")) -> DataFrame:
    """The rows of ``scan_book_lines`` output that are in a body, in any row order, with a flag column per mode.

    The lines are read twice, whatever the number of modes: once for the few
    marker lines of all modes, which give each file its bounds, and once for the
    lines these are joined back to. The join is left to the optimizer: bounds of
    few files are broadcast by their measured size, otherwise adaptive execution
    splits a hot file.
    """
    flags = [(F.contains("text", F.lit(MARKER_SIGN)) & F.rlike("text", F.lit(pattern))).alias(f"_{end}_{mode}")
             for mode in modes for end, pattern in zip(("start", "end"), MARKERS[mode])]
    names = [f"_{end}_{mode}" for mode in modes for end in ("start", "end")]
    marks = lines.select("path", "position", *flags).where(" or ".join(names))
    of_file = Window.partitionBy("path")
    marks = marks.withColumns({f"_first_{m}": F.min(F.when(F.col(f"_start_{m}"), F.col("position"))).over(of_file)
                               for m in modes})
    at = F.col("position")
    bounds = marks.groupBy("path").agg(
        *[F.min(f"_first_{m}").alias(f"_first_{m}") for m in modes],
        *[F.min(F.when(F.col(f"_end_{m}") & (at > F.col(f"_first_{m}")), at)).alias(f"_last_{m}") for m in modes])
    # a file without a START line has null bounds, and no line is in a body of that mode
    inside = {m: F.coalesce((at > F.col(f"_first_{m}")) & (F.col(f"_last_{m}").isNull() | (at < F.col(f"_last_{m}"))),
                            F.lit(False)) for m in modes}
    tagged = lines.join(bounds, "path").select(*lines.columns, *[flag.alias(m) for m, flag in inside.items()])
    return tagged.where(" or ".join(modes))


def body_of_lines(lines: DataFrame, mode: str) -> DataFrame:
    """The body rows of ``scan_book_lines`` output for one mode, see ``bodies_of_lines``."""
    return lines if mode == "none" else bodies_of_lines(lines, (mode,)).drop(mode)
