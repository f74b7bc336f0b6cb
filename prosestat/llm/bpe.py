"""Byte-level BPE encoding and decoding with a pair occurrence index.

The distinct words of a block of rows are laid out as one symbol sequence with
gaps. An index maps each adjacent pair to all its positions in the block. The
active ranks are taken in ascending order from a heap; all positions of a pair
merge at once, left to right, and only the lists of the two neighbouring pairs
are updated. A word of a million characters costs no more per symbol than a
short one, and a word that occurs a thousand times is merged once.

Nulls encode and decode as the empty text; repeated rows give repeated rows;
an empty table gives an empty table; columns beyond the two named ones are left
out of the result.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from prosestat.llm.shared import settled, ship

# Fixed value: the public word pattern of the byte-level vocabulary.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text tokenized at once, and pieces whose ids are remembered; both bound memory, not results.
BLOCK_CHARS = 1_000_000
KNOWN_PIECES = 300_000
#: Ids decoded at once, in bytes.
BLOCK_BYTES = 1_000_000
#: Symbols indexed at once.
SLICE = 1 << 19
#: White space before a space or a line end.
DOUBLE = re.compile(r"\s[ \n]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself where printable, else the next free letter from 256."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class PairIndexBpe:
    """A byte-level tokenizer file, read for encoding and decoding.

    Merging all positions of a rank in a block before the next rank equals
    word-by-word merging only if a merge never enables one of a lower rank; the
    constructor checks that for the whole merge table and refuses other files.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, added = spec["model"], spec.get("added_tokens") or []
        pre, dec = spec.get("pre_tokenizer") or {}, spec.get("decoder") or {}
        if (model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or dec.get("type") != "ByteLevel" or spec.get("normalizer")
                or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("ignore_merges") or model.get("dropout")):
            raise ValueError("only plain byte-level BPE files are supported")
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            raise ValueError("added tokens that take in their surroundings are not supported")
        vocab = dict(model["vocab"])
        letters = byte_letters()
        self.byte_id = np.array([vocab[c] for c in letters], np.int64)
        self.special = {t["content"]: t["id"] for t in added}
        self.split = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if added else None
        self.words = regex.compile(WORDS)
        self.merges: list[tuple[int, int, int]] = []
        ranks: dict[tuple[int, int], int] = {}
        born: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            left, right, made = vocab[a], vocab[b], vocab[a + b]
            if born.get(left, -1) >= rank or born.get(right, -1) >= rank or made in born:
                raise ValueError("a merge enables one of a lower rank")
            born[made] = rank
            self.merges.append((left, right, made))
            ranks[left, right] = rank
        if any(born.get(x, -1) > rank for (a, b), rank in ranks.items() for x in (a, b)):
            raise ValueError("a merge enables one of a lower rank")
        keys = np.array([(a << 32) | b for a, b in ranks], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([*ranks.values()], np.int64)[order]
        self.first: dict[str, bytes] = {}  # ids of pieces at a line's start
        self.later: dict[str, bytes] = {}  # ids of pieces after a space

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair of symbols, -1 where the pair doesn't merge."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (self.pair_keys[at] == wanted), self.pair_ranks[at], -1)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The packed ids of each word, merged together over one pair occurrence index."""
        lengths = np.array([len(w) for w in words], np.int64)
        slots = np.arange(lengths.sum()) + np.repeat(np.arange(len(words)), lengths) + 1
        symbols = np.full(lengths.sum() + len(words) + 1, -1, np.int32)  # -1: a gap, part of no pair
        symbols[slots] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        after, before = np.arange(1, len(symbols) + 1, dtype=np.int32), np.arange(-1, len(symbols) - 1, dtype=np.int32)
        places: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def index(ranks: np.ndarray, at: np.ndarray) -> None:
            """Add the positions ``at`` to the lists of their pairs."""
            some = np.flatnonzero(ranks >= 0)
            if not len(some):
                return
            some = some[np.argsort(ranks[some], kind="stable")]
            ranks, at = ranks[some], at[some]
            cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(at)]
            for a, b in zip(cuts, cuts[1:]):
                rank, part = int(ranks[a]), at[a:b]
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(active, rank)
                places[rank].append(part)

        for start in range(0, len(symbols) - 1, SLICE):
            stop = min(start + SLICE, len(symbols) - 1)
            index(self.ranks_of(symbols[start:stop], symbols[start + 1:stop + 1]), np.arange(start, stop, dtype=np.int32))
        while active:
            rank = heapq.heappop(active)
            left, right, made = self.merges[rank]
            at = places.pop(rank)
            at = at[0] if len(at) == 1 else np.unique(np.concatenate(at))
            at = at[symbols[at] == left]
            at = at[symbols[after[at]] == right]
            if left == right and len(at) > 1:  # overlapping positions: leftmost first
                kept, taken = [], -1
                for i, j in zip(at.tolist(), after[at].tolist()):
                    if i != taken:
                        kept.append(i)
                        taken = j
                at = np.array(kept, np.int32)
            gone = after[at]
            rest = after[gone]
            symbols[at], symbols[gone] = made, -2
            after[at], before[rest] = rest, at
            ahead = before[at]
            own = symbols[at]
            index(self.ranks_of(np.concatenate((symbols[ahead], own)), np.concatenate((own, symbols[rest]))), np.concatenate((ahead, at)))
        alive = symbols >= 0
        ends = np.cumsum(alive)[np.cumsum(lengths + 1) - 1].tolist()
        packed = symbols[alive].astype("<u4").tobytes()
        return [packed[4 * i: 4 * j] for i, j in zip([0, *ends], ends)]

    def pieces(self, text: str) -> list[tuple[bool, list[str]]]:
        """The text cut where no word can span: (whether the pieces but the first had a space before them, pieces).

        A word never runs from a visible character into white space. So a text
        without white space before a space or line end is cut before each; any
        other part is cut by the word pattern.
        """
        out = []
        for k, part in enumerate(self.split.split(text) if self.split else [text]):
            if k % 2:
                out.append((False, [part]))
            elif DOUBLE.search(part):
                out.append((False, self.words.findall(part)))
            else:
                lines = part.split("\n")
                out.append((True, lines[0].split(" ")))
                out += [(True, ("\n" + line).split(" ")) for line in lines[1:]]
        return out

    def encode_block(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, packed as little-endian unsigned 32-bit integers."""
        if len(self.first) + len(self.later) > KNOWN_PIECES:
            self.first.clear()
            self.later.clear()
        first, later = self.first, self.later
        new_first: set[str] = set()
        new_later: set[str] = set()
        cut = [self.pieces(text) for text in texts]
        for parts in cut:
            for spaced, pieces in parts:
                if spaced:
                    new_first.add(pieces[0])
                    new_later.update(pieces[1:])
                else:
                    new_first.update(pieces)
        unknown = [(known, {p: self.words.findall(lead + p) for p in new if p not in known and p not in self.special})
                   for known, new, lead in ((first, new_first, ""), (later, new_later, " "))]
        distinct = list({w for _, words in unknown for ws in words.values() for w in ws})
        ids_of = dict(zip(distinct, self.merge([w.encode() for w in distinct])))
        for known, words in unknown:
            known.update((p, b"".join(map(ids_of.__getitem__, ws))) for p, ws in words.items())
        first.update((s, i.to_bytes(4, "little")) for s, i in self.special.items())
        out = []
        for parts in cut:
            ids = []
            for spaced, pieces in parts:
                if spaced:
                    ids.append(first[pieces[0]])
                    ids.extend(map(later.__getitem__, pieces[1:]))
                else:
                    ids.extend(map(first.__getitem__, pieces))
            out.append(b"".join(ids))
        return out


@lru_cache(maxsize=4)
def load(path: str) -> PairIndexBpe:
    return PairIndexBpe(path)


@lru_cache(maxsize=4)
def token_bytes(path: str) -> list[bytes]:
    """The bytes of each id; decoding needs no more of the file."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    back = {c: b for b, c in enumerate(byte_letters())}
    ids = [*spec["model"]["vocab"].items(), *((t["content"], t["id"]) for t in spec.get("added_tokens") or [])]
    out = [b""] * (1 + max(i for _, i in ids))
    for text, i in ids:
        out[i] = bytes(back[c] for c in text) if all(c in back for c in text) else text.encode()
    return out


def text_of(packed: bytes, table: list[bytes]) -> str:
    return b"".join(map(table.__getitem__, np.frombuffer(packed, "<u4").tolist())).decode("utf-8", "replace")


def blocks(batch: pa.RecordBatch, column: int, most: int):
    """The batch in runs of about ``most`` characters or bytes of a column: (run, its values, null as None)."""
    start, block, size = 0, [], 0
    for i, v in enumerate(batch.column(column), 1):
        block.append(v.as_py())
        size += len(block[-1] or "") + 1
        if size >= most or i == batch.num_rows:
            yield batch.slice(start, i - start), block
            start, block, size = i, [], 0


def encode(df: DataFrame, tokenizer: str, text: str = "text", key: str = "doc_id", decoded: bool = False) -> DataFrame:
    """``key``, n_tokens and ids of every whole text; ids are packed little-endian unsigned 32-bit integers.

    With ``decoded`` also the text that they decode to, as ``decode`` gives it, from the same Python worker.
    """
    rows = df.select(df[key].alias(key), df[text].cast("string").alias("text_"))
    names = [key, "n_tokens", "ids", *(["decoded"] if decoded else [])]

    def run(batches):
        bpe, table = load(tokenizer), token_bytes(tokenizer) if decoded else []
        for batch in batches:
            for part, texts in blocks(batch, 1, BLOCK_CHARS):
                ids = bpe.encode_block([t or "" for t in texts])
                back = [pa.array([text_of(x, table) for x in ids], pa.string())] if decoded else []
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *back], names=names)

    fields = [df.schema[key], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
    return ship(rows).mapInArrow(settled(run), T.StructType(fields[:len(names)]))


def decode(df: DataFrame, tokenizer: str, ids: str = "ids", keep: tuple[str, ...] = ("doc_id", "n_tokens", "ids")) -> DataFrame:
    """The columns ``keep`` and ``decoded``, the text of the packed ids (null: empty)."""
    rows = df.select(*[df[c] for c in keep], df[ids].alias("ids_"))

    def run(batches):
        table = token_bytes(tokenizer)
        for batch in batches:
            for part, ids in blocks(batch, len(keep), BLOCK_BYTES):
                texts = [text_of(x or b"", table) for x in ids]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(texts, pa.string())], names=[*keep, "decoded"])

    return ship(rows).mapInArrow(settled(run), T.StructType([*(df.schema[c] for c in keep), T.StructField("decoded", T.StringType())]))
