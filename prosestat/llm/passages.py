"""Substring dedup: repeated windows of words, found by super-k-mer partitioning.

A window is ``window`` consecutive words of one document. Its minimiser is the
smallest hash among its runs of ``MINIMISER_WORDS`` words; consecutive windows of
one minimiser form a super-k-mer, which travels as one packed string (its words
joined by a space) to the bucket of that minimiser. Equal windows have equal
minimisers, so they meet in one bucket; there the windows are sorted and counted,
word for word. A word goes if it is in a window that also starts in a document of
a smaller id; windows are those of the input.

A bucket is read by one task, a row at a time, sorted by minimiser. Minimisers
are counted before anything travels, and only those of several documents send
strings, as far as a bitmap of fixed size tells them apart (``bitmaps``; it lets
others through, never holds one back). A frequent one, of more than ``HOT_LEAST``
super-k-mers and more than ``1 / HOT_MOST`` of all (so ``HOT_MOST`` at most, whatever
the size, are known to the driver), sends no strings: its windows are dealt one by
one by a 128-bit digest of their words, counted within each task first, so that
a passage in every document loads no task. Only there are windows told apart by
digests. What returns are spans of words; a document's text meets its spans once.

Words are runs of anything but ASCII white space, unchanged. Null and empty texts
have no words; a text shorter than a window keeps all; a null id counts as the
greatest long; documents of one id (repeated rows, or other texts) never remove
from each other. Every row stays; an empty table gives an empty table; columns
beyond the two named ones are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosestat.llm.bitmaps import bitmap_of, has
from prosestat.llm.shared import settled, ship, written

WINDOW, MINIMISER_WORDS = 50, 8
#: Super-k-mers of a minimiser from which it may be frequent; frequent ones at most.
HOT_LEAST, HOT_MOST = 4096, 1_000_000
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_LAST = (1 << 63) - 1
_STRINGS = "bucket long, id long, digest long, at int, packed binary"
_WINDOWS = "high long, low long, id long, digest long, at int"
_SPANS = "id long, digest long, start int, end int"


def _mixed(x: np.ndarray) -> np.ndarray:
    for m in _MIX[1:]:
        x = (x ^ x >> np.uint64(33)) * m
    return x ^ x >> np.uint64(33)


def _over(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of each run of ``n`` neighbouring hashes, in order."""
    out = hashes[:len(hashes) - n + 1].copy()
    for i in range(1, n):
        out = out * _MIX[0] + hashes[i: len(hashes) - n + 1 + i]
    return _mixed(out)


def _least(x: np.ndarray, n: int) -> np.ndarray:
    """The smallest of each run of ``n`` neighbours, by doubling."""
    width = 1
    while width * 2 <= n:
        x = np.minimum(x[:len(x) - width], x[width:])
        width *= 2
    rest = n - width
    return np.minimum(x[:len(x) - rest], x[rest:]) if rest else x


def super_kmers(words: list[bytes], window: int = WINDOW, run: int = MINIMISER_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimisers, first window, end): the super-k-mers of a document, windows [first, end)."""
    n = len(words) - window + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    run = min(run, window)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    least = _least(_over(own, run), window - run + 1)
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    return least[first], first, np.concatenate([first[1:], [n]])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """(id, digest, words) of each document; bytes.split knows ASCII white space only."""
    for batch in batches:
        for key, digest, text in zip(*(c.to_pylist() for c in batch.columns)):
            yield key, digest, (text or b"").split()


def _batches(rows: Iterator[tuple], schema: str, size: int = 1 << 14) -> Iterator[pa.RecordBatch]:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    names, types = zip(*[(a, kinds[b]) for a, b in (f.split() for f in schema.split(", "))])
    held, room = [], 0
    for row in rows:
        held.append(row)
        room += len(row[-1]) if isinstance(row[-1], bytes) else 1
        if len(held) >= size or room > 1 << 23:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))
            held, room = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=list(names))


def minimiser_counts(rows: DataFrame, window: int) -> DataFrame:
    """(bucket, n, shared): how many super-k-mers each minimiser has, and whether in several documents."""
    def run(batches):
        for key, _, words in _documents(batches):
            least = super_kmers(words, window)[0]
            if len(least):
                yield pa.RecordBatch.from_arrays([pa.array(least.view(np.int64)), pa.array(np.full(len(least), key, np.int64))], names=["bucket", "id"])

    found = ship(rows).mapInArrow(_gathered(run), "bucket long, id long")
    return found.groupBy("bucket").agg(F.count("*").alias("n"), (F.min("id") < F.max("id")).alias("shared"))


def _gathered(run):
    """``run`` with its small batches put together."""
    def out(batches):
        held, n = [], 0
        for b in run(batches):
            held.append(b)
            n += b.num_rows
            if n >= 1 << 16:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
        if held:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    return out


def frequent_and_shared(rows: DataFrame, window: int, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The frequent minimisers, sorted (``most`` at most, as each has more than that share of all), and the bitmap of the shared ones."""
    counts = written(minimiser_counts(rows, window), "minimisers")
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = counts.where((F.col("n") > least) & (F.col("n") * most > total)).select("bucket").collect()
    return np.sort(np.array([r.bucket for r in found], np.int64)), bitmap_of(counts.where("shared"), F.col("bucket"))


def _is_hot(minimisers: np.ndarray, hot: np.ndarray) -> np.ndarray:
    own = minimisers.view(np.int64)
    if not len(hot):
        return np.zeros(len(own), bool)
    return hot[np.minimum(np.searchsorted(hot, own), len(hot) - 1)] == own


def strings(rows: DataFrame, hot, shared, window: int) -> DataFrame:
    """The packed super-k-mers of the minimisers that may be shared but aren't frequent."""
    def told(batches):
        for key, digest, words in _documents(batches):
            least, first, end = super_kmers(words, window)
            keep = ~_is_hot(least, hot.value) & has(shared.value, least)
            for m, a, b in zip(least.view(np.int64)[keep].tolist(), first[keep].tolist(), end[keep].tolist()):
                yield m, key, digest, a, b" ".join(words[a: b + window - 1])

    return ship(rows).mapInArrow(settled(lambda batches: _batches(told(batches), _STRINGS)), _STRINGS)


def repeated_in_bucket(members: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(id, digest, start, end) spans of words in windows of a bucket that a smaller id has too.

    ``members`` are (id, digest, first window, packed) of one minimiser. Equal
    strings are one; the windows of different ones are sorted and counted.
    """
    by: dict[bytes, list] = {}
    for key, digest, at, packed in members:
        by.setdefault(packed, []).append((key, digest, at))
    firsts: dict[bytes, list[int]] = {}
    if len(by) > 1:
        windows = []
        for number, (packed, found) in enumerate(by.items()):
            ends = [i for i, c in enumerate(packed) if c == 32] + [len(packed)]
            begins = [0, *[e + 1 for e in ends[:-1]]]
            least = min(f[0] for f in found)
            windows += [(packed[begins[i]: ends[i + window - 1]], least, number, i) for i in range(len(ends) - window + 1)]
        windows.sort()
        firsts = {number: [0] * (packed.count(b" ") + 2 - window) for number, packed in enumerate(by)}
        before = None
        for words, least, number, i in windows:
            if words != before:
                before, first = words, least  # sorted: the first of equal windows has the least id
            firsts[number][i] = first
    for number, (packed, found) in enumerate(by.items()):
        n = packed.count(b" ") + 2 - window
        first = firsts[number] if firsts else [min(f[0] for f in found)] * n
        for key, digest, at in found:
            i = 0
            while i < n:
                if first[i] < key:
                    j = i
                    while j + 1 < n and first[j + 1] < key:
                        j += 1
                    yield key, digest, at + i, at + j + window
                    i = j
                i += 1


def spans_of_buckets(packed: DataFrame, window: int) -> DataFrame:
    """The spans that the buckets of ``packed`` (``strings``) give; a bucket is a run of sorted rows in one task."""
    def told(batches):
        key, members = None, []
        for batch in batches:
            bucket = batch.column(0).to_numpy()
            cut = np.flatnonzero(bucket[1:] != bucket[:-1]) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(bucket)]):
                if bucket[a] != key:
                    if len(members) > 1:
                        yield from repeated_in_bucket(members, window)
                    key, members = bucket[a], []
                if b - a > 1 or members or b == len(bucket):  # else it is alone in its bucket
                    members += zip(*(batch.column(i).slice(a, b - a).to_pylist() for i in (1, 2, 3, 4)))
        if len(members) > 1:
            yield from repeated_in_bucket(members, window)

    dealt = packed.repartition("bucket").sortWithinPartitions("bucket")
    return ship(dealt).mapInArrow(lambda batches: _batches(told(batches), _SPANS), _SPANS)


def spans_of_frequent(rows: DataFrame, hot, window: int) -> DataFrame:
    """The spans that windows of frequent minimisers give, window by window."""
    def run(batches):
        for key, digest, words in _documents(batches):
            least, first, end = super_kmers(words, window)
            keep = _is_hot(least, hot.value)
            if not keep.any():
                continue
            at = np.concatenate([np.arange(a, b) for a, b in zip(first[keep], end[keep])])
            digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(b" ".join(words[i: i + window])) for i in at.tolist()), ">i8").reshape(-1, 2)
            n = len(at)
            yield pa.RecordBatch.from_arrays([pa.array(digests[:, 0].astype("=i8")), pa.array(digests[:, 1].astype("=i8")), pa.array(np.full(n, key, np.int64)),
                                              pa.array(np.full(n, digest, np.int64)), pa.array(at.astype(np.int32))], names=["high", "low", "id", "digest", "at"])

    windows = written(ship(rows).mapInArrow(_gathered(run), _WINDOWS), "frequent-windows")
    shared = windows.groupBy("high", "low").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first < last")
    return windows.join(shared.select("high", "low", "first"), ["high", "low"]).where("first < id").select(
        "id", "digest", F.col("at").alias("start"), (F.col("at") + window).alias("end"))


def spans(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot_least: int = HOT_LEAST, hot_most: int = HOT_MOST) -> DataFrame:
    """(id, digest, spans): of each document with repeated windows the spans of words that go; see ``remove``."""
    rows = df.select(F.coalesce(df[key].cast("long"), F.lit(_LAST)).alias("id"), _digest(df[text]).alias("digest"), df[text].cast("binary").alias("text"))
    found, bitmap = frequent_and_shared(rows, window, hot_least, hot_most)
    hot, shared = (df.sparkSession.sparkContext.broadcast(x) for x in (found, bitmap))
    out = spans_of_buckets(strings(rows, hot, shared, window), window)
    if len(found):
        out = out.unionByName(spans_of_frequent(rows, hot, window))
    # repeated rows of one id and text have the same spans
    return out.groupBy("id", "digest").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def _digest(text):
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def remove(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot_least: int = HOT_LEAST, hot_most: int = HOT_MOST) -> DataFrame:
    """``key``, n_words, n_removed and ``kept`` (the words left, joined by a space) of every document."""
    gone = written(spans(df, key, text, window, hot_least, hot_most), "spans").withColumnsRenamed({"id": "id_", "digest": "digest_"})
    own = df.select(df[key].alias("key"), df[text].cast("binary").alias("text"), F.coalesce(df[key].cast("long"), F.lit(_LAST)).alias("id"), _digest(df[text]).alias("digest"))
    met = own.join(gone, (own["id"] == gone["id_"]) & (own["digest"] == gone["digest_"]), "left").select("key", "text", "spans")

    def run(batches):
        for batch in batches:
            n, removed, kept = [], [], []
            for value, cuts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                words = (value or b"").split()
                n.append(len(words))
                if cuts:
                    edges = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edges, [c["start"] for c in cuts], 1)
                    np.add.at(edges, [c["end"] for c in cuts], -1)
                    stays = np.cumsum(edges[:-1]) == 0
                    words = [words[i] for i in np.flatnonzero(stays).tolist()]
                removed.append(n[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())],
                                             names=[key, "n_words", "n_removed", "kept"])

    schema = T.StructType([df.schema[key], *[T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")], T.StructField("kept", T.BinaryType())])
    return ship(met).mapInArrow(settled(run), schema).withColumn("kept", F.col("kept").cast("string"))
