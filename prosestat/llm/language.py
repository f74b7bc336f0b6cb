"""The language of a text as a mixture of languages.

Training counts, for each labelled language, the three-letter sequences of all
its texts (small letters, other signs as word ends), hashed to ``BUCKETS``. A
text is then taken as a mixture: expectation-maximisation finds the proportions
that make its sequences likeliest. Which languages belong to it is decided by
penalised likelihood: from the likeliest single language on, the next language
by proportion is added as long as the likelihood gains more than the penalty.

Null texts and texts without a letter are ``und`` with score 0, and so is all if
nothing is labelled; ties go to the language first in the alphabet; null
languages teach nothing; repeated rows count as often as they occur; an empty
table gives an empty table; further columns are left out. The model holds
``BUCKETS`` numbers a language, whatever the size of the corpus.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosestat.llm.shared import ship

BUCKETS = 1 << 16
#: Chance of a sequence no text of a language has.
UNSEEN = 1e-7
ROUNDS = 10
#: Cost of a further language per logarithm of the text's letters; sequences overlap, so more than the usual half.
PENALTY = 3.0
#: Smallest proportion of a language that is tried.
LEAST = 0.03
BLOCK_CHARS = 1_000_000
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its small letter, 0 if it is none."""
    return np.array([ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)], np.uint32)


def sequences(text: str) -> np.ndarray:
    """The bucket of each letter of ``text`` with its two neighbours."""
    codes = _letters()[np.frombuffer((" " + text + " ").encode("utf-32-le", "surrogatepass"), np.uint32)].astype(np.uint64)
    middle = np.flatnonzero(codes)
    mixed = (codes[middle - 1] * np.uint64(0x9E3779B97F4A7C15) ^ codes[middle]) * np.uint64(0xC2B2AE3D27D4EB4F) ^ codes[middle + 1]
    return ((mixed * np.uint64(0x165667B19E3779F9)) >> np.uint64(48)).astype(np.int64)


def _texts(batch: pa.RecordBatch, column: int):
    """(first row, texts) in runs of about ``BLOCK_CHARS`` characters."""
    start, texts, size = 0, [], 0
    for i, v in enumerate(batch.column(column)):
        texts.append(v.as_py() or "")
        size += len(texts[-1])
        if size >= BLOCK_CHARS:
            yield start, texts
            start, texts, size = i + 1, [], 0
    if texts:
        yield start, texts


def train(df: DataFrame, taught: Column, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """The languages and their (languages, BUCKETS) chances, from the rows where ``taught``.

    Each task sums its texts; what reaches the driver is a number per language
    and bucket.
    """
    rows = df.where(taught & F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            names = batch.column(0).to_pylist()
            for start, texts in _texts(batch, 1):
                for i, t in enumerate(texts, start):
                    own = sums.setdefault(names[i], np.zeros(BUCKETS, np.int64))
                    np.add.at(own, sequences(t), 1)
        for name, own in sums.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["lang", "bucket", "n"])

    counted = ship(rows).mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(counted.column("lang").to_pylist()))
    place = {n: i for i, n in enumerate(names)}
    counts = np.zeros((len(names), BUCKETS))
    if names:
        counts[[place[n] for n in counted.column("lang").to_pylist()], counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    shares = counts / np.maximum(counts.sum(1, keepdims=True), 1)
    return names, ((shares + UNSEEN) / (1 + UNSEEN * BUCKETS)).astype(np.float32)


def _mixture(chances: np.ndarray, counts: np.ndarray, starts: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood of each text; its sequences lie from ``starts`` on, ``allowed`` has its languages."""
    lengths = np.diff(np.r_[starts, len(counts)])
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        joint = chances * np.repeat(share, lengths, axis=0)
        joint *= (counts / joint.sum(1))[:, None]
        share = np.add.reduceat(joint, starts, axis=0)
        share /= share.sum(1, keepdims=True)
    likely = np.log((chances * np.repeat(share, lengths, axis=0)).sum(1)) * counts
    return share, np.add.reduceat(likely, starts)


def infer(texts: list[str], model: np.ndarray) -> np.ndarray:
    """(texts, languages) proportions; all zero for texts without letters."""
    out = np.zeros((len(texts), len(model)))
    found = [sequences(t) for t in texts]
    filled = np.array([i for i, s in enumerate(found) if len(s)], np.int64)
    if not len(filled) or not len(model):
        return out
    sizes = np.array([len(found[i]) for i in filled])
    keys = np.sort(np.repeat(np.arange(len(filled)), sizes) * BUCKETS + np.concatenate([found[i] for i in filled]))
    heads = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    counts = np.diff(np.r_[heads, len(keys)]).astype(np.float32)
    text, bucket = np.divmod(keys[heads], BUCKETS)
    chances = model.T[bucket]
    starts = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
    share, _ = _mixture(chances, counts, starts, np.ones((len(filled), len(model)), np.float32), ROUNDS)
    alone = np.add.reduceat(np.log(chances) * counts[:, None], starts, axis=0)
    first = alone.argmax(1)
    rows = np.arange(len(filled))
    sets = np.zeros((len(filled), len(model)), np.float32)
    sets[rows, first] = 1
    chosen, likely = sets.astype(float), alone[rows, first].astype(float)
    ends = np.r_[starts, len(counts)]
    for _ in range(len(model) - 1):  # add the next language where it pays
        rest = np.where(sets > 0, 0, share)
        nxt = rest.argmax(1)
        ask = np.flatnonzero(rest[rows, nxt] >= LEAST)
        if not len(ask):
            break
        pick = np.concatenate([np.arange(ends[i], ends[i + 1]) for i in ask])
        wider = sets[ask].copy()
        wider[np.arange(len(ask)), nxt[ask]] = 1
        lengths = ends[ask + 1] - ends[ask]
        shares, gain = _mixture(chances[pick], counts[pick], np.r_[0, np.cumsum(lengths)[:-1]], wider, ROUNDS)
        better = gain - likely[ask] > PENALTY * np.log(sizes[ask])
        won = ask[better]
        share[ask[~better]] = 0  # these are settled
        sets[won], chosen[won], likely[won] = wider[better], shares[better], gain[better]
        if not len(won):
            break
    out[filled] = chosen
    return out


def identify(df: DataFrame, languages: list[str], model: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, lang_pred, score (its proportion) and languages (the chosen set, first in the alphabet first), from the whole text alone."""
    rows = df.select(df[key].alias(key), df[text].cast("string").alias("text_"))

    def run(batches):
        for batch in batches:
            shares = [np.zeros((0, len(languages)))] + [infer(texts, model) for _, texts in _texts(batch, 1)]
            share = np.concatenate(shares)
            if not languages:
                share = np.zeros((batch.num_rows, 1))
            best, top = share.argmax(1), share.max(1)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([languages[b] if s > 0 else UNKNOWN for b, s in zip(best, top)], pa.string()), pa.array(np.minimum(top, 1.0), pa.float64()),
                pa.array([[n for n, s in zip(languages, row) if s > 0] for row in share], pa.list_(pa.string()))], names=[key, "lang_pred", "score", "languages"])

    return ship(rows).mapInArrow(run, T.StructType([df.schema[key], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
                                              T.StructField("languages", T.ArrayType(T.StringType()))]))
