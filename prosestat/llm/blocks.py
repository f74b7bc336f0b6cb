"""A stated set of queries against all rows, block by block.

Rows are dealt to blocks by a hash, so equal rows of different ids spread; each
block holds about ``block_rows`` of them, whatever the size of the table, and
every query is sent to every block. A task reads a block's rows first, builds one
index of them, and then lets the queries stream through it, batch by batch: its
memory is one block and one batch, and no row is sent twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prosestat.llm.shared import ship


def meet(rows: DataFrame, queries: DataFrame, blocks: int, deal: Column, group: str, build: Callable, answer: Callable, schema: str) -> DataFrame:
    """What ``answer(build(rows of a block), queries)`` yields for every block and each batch of queries.

    ``rows`` and ``queries`` have the same columns. ``deal`` is a hash of a row;
    only rows and queries that are equal in ``group`` meet. ``build`` takes a table of one
    block's rows of one group, ``answer`` gives a record batch of ``schema``.
    """
    own = rows.columns
    held = rows.select(*own, F.pmod(deal, F.lit(blocks)).cast("int").alias("part_"), F.lit(False).alias("asked_"))
    asked = queries.select(*own, F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("part_"), F.lit(True).alias("asked_"))
    both = held.unionByName(asked).repartition("part_").sortWithinPartitions("part_", group, "asked_")

    def run(batches):
        key, kept, index = None, [], None
        for at, is_query, piece in _runs(batches, group):
            if at != key:
                key, kept, index = at, [], None
            if not is_query:
                kept.append(piece)
            elif kept or index is not None:
                if index is None:
                    index, kept = build(pa.Table.from_batches(kept)), []
                yield answer(index, piece)

    return ship(both).mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], group: str) -> Iterator[tuple[tuple, bool, pa.RecordBatch]]:
    """Each batch cut where block, group or kind changes."""
    for batch in batches:
        part, own, asked = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("part_", group, "asked_"))
        if not len(part):
            continue
        change = np.flatnonzero((part[1:] != part[:-1]) | (own[1:] != own[:-1]) | (asked[1:] != asked[:-1])) + 1
        for start, end in zip([0, *change.tolist()], [*change.tolist(), len(part)]):
            yield (part[start], own[start]), bool(asked[start]), batch.slice(start, end - start)


def matrix(table: pa.Table | pa.RecordBatch, column: str, size: int) -> np.ndarray:
    """A list column of lists of one length as rows of an array."""
    lists = table.column(column)
    flat = [c.flatten().to_numpy(zero_copy_only=False) for c in (lists.chunks if isinstance(lists, pa.ChunkedArray) else [lists])]
    return np.concatenate(flat).reshape(-1, size) if flat and size else np.zeros((table.num_rows, size))
