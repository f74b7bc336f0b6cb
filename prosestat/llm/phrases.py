"""Phrase collocations, counted by an FM-index per shard over word ids.

A shard is some texts of one language: words as numbers, pieces parted by a
separator. Its index has the suffixes of the text, and of the text reversed, in
the order of their first words (as many as the longest phrase), the words before
them (BWT), and where each of these leads. An interval of both orders stands for
a phrase; extending it to the left or right gives the intervals, and so the exact
counts, of all phrases one word longer. Extension starts from single words, goes
once to the right and from then on to the left, all intervals of a length at a time.

Counts of shards add up by language and phrase. A phrase of three words or more
can only be frequent if its word pairs are, so a first pass counts words and
pairs, and the second extends only where the two outer pairs are marked in a
bitmap of the frequent pairs (``bitmaps``). It has a fixed size and can let through
what isn't frequent, never lose what is, so results do not depend on it.

A candidate is a phrase of 2 to ``longest`` words with ``least`` occurrences. Cutting
it after k words gives scores floor(1000000 a a / (l r)); the lowest cut counts, ties
to the smallest k. Candidates inside a longer one that occurs at least half as
often are dropped. Products are 38-digit decimals, exact for counts below 10^15.

A-Z is lowered, pieces end at ``. , ; : ! ?`` and the line ends x0A-x0D, words at
spaces and tabs. Null texts count as empty, a null language as ``und``; repeated
rows count again; a table without candidates gives an empty result; columns beyond
the two named ones play no part. A text larger than a shard is cut between pieces.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from prosestat.llm.bitmaps import bitmap_of, has
from prosestat.llm.shared import settled, ship, whole, written

#: Bytes of text in the shards a task holds at a time, about.
SHARD_BYTES = 4 << 20
#: Phrases handed on at a time.
_BATCH = 1 << 15
_SEPARATED = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)]
_SCHEMA = "lang string, size int, phrase binary, n long"


class BiIndex:
    """FM-indexes of a text of word ids and of its reverse; 0 parts pieces and stands at both ends. Phrases of ``depth`` words at most can be extended."""

    def __init__(self, ids: np.ndarray, depth: int, vocabulary: int):
        self.ids, self.depth, self.vocabulary = ids, depth, vocabulary
        self.starts = np.concatenate([[0], np.cumsum(np.bincount(ids, minlength=vocabulary))])
        self._sides: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def side(self, to: str) -> tuple[np.ndarray, np.ndarray]:
        """(bwt, leads) for extension to that side: the word beyond each suffix, and the place of the suffix begun by it."""
        if to not in self._sides:
            ids = self.ids if to == "left" else self.ids[::-1]
            order = _sorted(ids)[0]
            for depth in range(2, self.depth + 1):
                ranks = np.empty(len(ids), np.int64)  # of suffixes by their first depth - 1 words
                ranks[order] = np.cumsum(np.concatenate([[0], self._changes(ids, order, depth - 1)]))
                after = np.concatenate([ranks[1:], [-1]])
                order = _sorted(ids * np.int64(len(ids) + 1) + after + 1)[0]
            bwt = ids[order - 1]  # the first suffix has the last word before it, a separator
            leads = np.empty(len(ids), np.int64)
            leads[_sorted(bwt)[0]] = np.arange(len(ids))
            self._sides[to] = bwt, leads
        return self._sides[to]

    @staticmethod
    def _changes(ids: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
        """Where neighbours in ``order`` differ in their first ``depth`` words."""
        out = np.zeros(max(0, len(order) - 1), bool)
        for d in range(depth):
            at = order + d
            own = np.where(at < len(ids), ids[np.minimum(at, len(ids) - 1)], -1)
            out |= own[1:] != own[:-1]
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(words, interval begins, counts) of all single words; the begins hold on both sides."""
        n = np.diff(self.starts)
        w = np.flatnonzero(n[1:]) + 1
        return w, self.starts[w], n[w]

    def extend(self, to: str, begin: np.ndarray, other: np.ndarray, n: np.ndarray, allowed=None) -> tuple[np.ndarray, ...]:
        """Every extension of the intervals by one word: (number of the interval, word, begin, other begin, count).

        ``begin`` are places in the order of side ``to``, ``other`` in that of the
        other one. ``allowed(intervals, words)`` tells which extensions to keep.
        """
        bwt, leads = self.side(to)
        own = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
        keys = own * np.int64(self.vocabulary) + bwt[at]
        order, keys = _sorted(keys)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
        count = np.diff(np.concatenate([first, [len(keys)]]))
        number, word = keys[first] // self.vocabulary, keys[first] % self.vocabulary
        # on the other side, extensions by smaller words come first: the sum of counts before this one in its interval
        before = first - (np.cumsum(n) - n)[number]
        keep = word > 0
        if allowed is not None:
            keep &= allowed(number, word)
        return number[keep], word[keep], leads[at[order[first]]][keep], (other[number] + before)[keep], count[keep]


def pair_hashes(lang: str, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """64-bit hashes of word pairs, from those of the words."""
    x = (left * _MIX[0] + right) ^ np.uint64(xxhash.xxh64_intdigest(lang.encode()))
    for m in _MIX[1:]:
        x = (x ^ x >> np.uint64(33)) * m
    return x ^ x >> np.uint64(33)


def _shards(batches: Iterator[pa.RecordBatch], shard_bytes: int) -> Iterator[tuple[str, np.ndarray, list[bytes]]]:
    """(language, word ids, words by id) of one shard after another."""
    held: dict[str, list[bytes]] = {}
    room = 0

    def flush():
        while held:
            lang, parts = held.popitem()
            yield lang, *_numbered(b" . ".join(parts).split())

    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = (text or b"").lower().translate(_SEPARATED)
            while text:
                end = len(text)
                if end > shard_bytes:  # at the last end of a piece below the bound, else at the first above
                    end = text.rfind(b".", 1, shard_bytes)
                    end = end if end > 0 else text.find(b".", shard_bytes)
                    end = end if end > 0 else len(text)
                held.setdefault(lang, []).append(text[:end].replace(b".", b" . "))
                room += end
                text = text[end:]
                if room >= shard_bytes:
                    yield from flush()
                    room = 0
    yield from flush()


class _Numbers(dict):
    """The next number for what has none yet."""

    def __missing__(self, key: bytes) -> int:
        self[key] = out = len(self)
        return out


def _numbered(tokens: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Word ids between two separators (0), and the words by id."""
    ids = _Numbers({b".": 0})
    out = np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens))
    return np.concatenate([[0], out, [0]]), list(ids)


def _sorted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, sorted keys) of a stable sort of keys from 0; place and key share a number where they fit."""
    room = len(keys).bit_length()
    if len(keys) and int(keys.max()).bit_length() + room < 63:
        both = np.sort(keys << room | np.arange(len(keys)))
        return both & (1 << room) - 1, both >> room
    order = np.argsort(keys, kind="stable")
    return order, keys[order]


def shard_counts(lang: str, ids: np.ndarray, names: list[bytes], longest: int, bitmap: np.ndarray | None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases as rows of word ids, counts) of a shard: words and pairs without a bitmap, else phrases of three words or more."""
    index = BiIndex(ids, longest - 1 if bitmap is not None else 1, len(names))
    word, begin, n = index.words()
    if bitmap is None:
        yield word[:, None], n
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))

    def frequent(left, right):
        return has(bitmap, pair_hashes(lang, hashes[left], hashes[right]))

    allowed = None if bitmap is None else lambda number, right: frequent(word[number], right)
    number, last, other, begin, n = index.extend("right", begin, begin, n, allowed)
    phrase = np.stack([word[number], last], axis=1)
    for size in range(2, longest + 1):
        if bitmap is None or size > 2:
            yield phrase, n
        if size == longest or bitmap is None:
            return
        number, first, begin, other, n = index.extend("left", begin, other, n, lambda number, left: frequent(left, phrase[number, 0]))
        phrase = np.concatenate([first[:, None], phrase[number]], axis=1)


def counts(rows: DataFrame, longest: int, bitmap=None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(lang, size, phrase, n) of ``rows`` (lang, text): words and pairs, or with a broadcast ``bitmap`` what is longer."""
    def run(batches):
        for lang, ids, names in _shards(batches, shard_bytes):
            for found, n in shard_counts(lang, ids, names, longest, bitmap.value if bitmap else None):
                for a in range(0, len(found), _BATCH):
                    some = [b" ".join([names[w] for w in p]) for p in found[a: a + _BATCH].tolist()]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(np.full(len(some), found.shape[1], np.int32)),
                                                      pa.array(some, pa.binary()), pa.array(n[a: a + _BATCH], pa.int64())], names=["lang", "size", "phrase", "n"])

    return ship(rows).mapInArrow(settled(run), _SCHEMA).groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))


def pair_bitmap(pairs: DataFrame) -> np.ndarray:
    """The bitmap of ``pairs`` (lang, phrase)."""
    def run(batches):
        for batch in batches:
            langs, found = (batch.column(i).to_pylist() for i in (0, 1))
            bits = np.zeros(len(found), np.uint64)
            two = [p.split(b" ") for p in found]
            left, right = (np.fromiter((xxhash.xxh64_intdigest(p[i]) for p in two), np.uint64, len(two)) for i in (0, 1))
            for lang in set(langs):
                own = np.array([x == lang for x in langs])
                bits[own] = pair_hashes(lang, left[own], right[own])
            yield pa.RecordBatch.from_arrays([pa.array(bits.view(np.int64))], names=["hash"])

    return bitmap_of(ship(pairs.select("lang", "phrase")).mapInArrow(run, "hash long"), F.col("hash"))


def frequent_phrases(df: DataFrame, text: str, lang: str, longest: int, least: int, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """(lang, size, phrase, n) of all phrases with ``least`` occurrences, and (lang, n) with all words of each language."""
    rows = df.select(F.coalesce(df[lang].cast("string"), F.lit("und")).alias("lang"), whole(df[text].cast("string")).cast("binary").alias("text"))
    short = counts(rows, 2, shard_bytes=shard_bytes)
    # a language's total rides along as a phrase of no words
    held = short.where((F.col("size") == 1) | (F.col("n") >= least))
    table = written(held, "phrases")
    sums = table.where("size = 1").groupBy("lang").agg(F.sum("n").alias("words"))
    table = table.where(F.col("n") >= least)
    if longest > 2:
        bitmap = df.sparkSession.sparkContext.broadcast(pair_bitmap(table.where("size = 2")))
        longer = written(counts(rows, longest, bitmap, shard_bytes).where(F.col("n") >= least), "phrases")
        table = table.unionByName(longer)
    return table, sums



def collocations(df: DataFrame, text: str = "text", lang: str = "lang", longest: int = 3, least: int = 10, half: int = 50, top: int | None = None,
                 shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the candidates of each language that stay, the first ``top`` if given."""
    table, sums = frequent_phrases(df, text, lang, longest, least, shard_bytes)
    table = table.withColumn("phrase", F.col("phrase").cast("string"))
    candidates = table.where("size > 1").select("lang", "size", "phrase", F.col("n").alias("a"))
    own = F.split("phrase", " ")
    part = lambda a, b: F.array_join(F.slice(own, a, b), " ")
    cut = candidates.select("lang", "phrase", "a", "size", F.explode(F.expr("sequence(1, size - 1)")).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("size") - F.col("k")).alias("right"))
    known = table.select(F.col("lang").alias("lang_"), F.col("phrase").alias("phrase_"), "n")
    for name, count in (("left", "l"), ("right", "r")):
        found = known.withColumnRenamed("n", count)
        cut = cut.join(found, (cut["lang"] == found["lang_"]) & (cut[name] == found["phrase_"])).drop("lang_", "phrase_")
    big = lambda c: F.col(c).cast("decimal(18,0)")
    score = F.call_function("div", (big("a") * big("a")).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), big("l") * big("r"))
    scored = cut.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a")).alias("s"))

    # every shorter phrase inside a candidate, with the count of the most frequent one that holds it
    places = F.expr("flatten(transform(sequence(2, size - 1), w -> transform(sequence(1, size - w + 1), i -> array_join(slice(split(phrase, ' '), i, w), ' '))))")
    inside = candidates.where("size > 2").select("lang", F.explode(places).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    kept = scored.join(inside, ["lang", "phrase"], "left").where(F.coalesce(100 * F.col("around") < half * F.col("s.a"), F.lit(True)))
    rows = kept.join(sums, "lang").select("lang", "phrase", "s.a", "s.l", "s.r", F.col("words").alias("n"), "s.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = rows.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
