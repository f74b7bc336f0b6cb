"""Secrets in texts: fixed patterns, and a battery of randomness tests for other tokens.

A candidate is a maximal run of 20 or more token characters whose encoding can be
told (hexadecimal, base 32 and base 36 in one case, base 64 and its URL form): it
holds a digit and a letter. Runs without a digit are left out, because the tests
below do not tell random letters of both cases from names of short words
(setMaxNumRowsPerPageSize) and letters of one case pass as ordinary. Digits alone are
of the kind hex. A candidate counts as a secret if

* it passes as random: neither its alphabet's chi-squared uniformity, nor the
  runs above and below the middle of the alphabet, nor the serial correlation of
  neighbouring symbols is rejected (Bonferroni over the three tests), and
* it does not pass as ordinary: ordinary tokens seldom change between small
  letters, capitals, digits and signs, so the number of changes has a binomial
  p-value, which falls with the token's length. The p-values of a document's
  candidates go through Benjamini-Hochberg, weighted by length.

Null and empty texts have no spans; repeated rows give repeated rows; an empty
table gives an empty table; columns beyond the two named ones are left out of
``find`` and kept by ``redact``.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from prosestat.llm.shared import settled, ship

# The kinds and patterns of the base, in the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(
    r"(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
LEAST_ASSIGNED = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
HEX_SIGNS, BASE32_SIGNS = "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36_SIGNS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BASE64_SIGNS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
#: Share of neighbours of another class in ordinary tokens, level of the battery, rate of false discoveries.
ORDINARY_CHANGES, BATTERY_LEVEL, DISCOVERY_RATE = 0.15, 0.003, 0.01

SPANS = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding(token: str) -> np.ndarray | None:
    """Symbol values and alphabet size (last entry) under the encoding the token can be, else None."""
    signs = token.rstrip("=")
    upper, lower, digit = (any(f(c) for c in signs) for f in (str.isupper, str.islower, str.isdigit))
    if not digit or not (upper or lower) or UUID.fullmatch(signs):
        return None
    if not (upper and lower) and set(signs.lower()) <= set(HEX_SIGNS):
        table = HEX_SIGNS
        signs = signs.lower()
    elif not (upper and lower) and set(signs.upper()) <= set(BASE36_SIGNS):
        signs = signs.upper()
        table = BASE32_SIGNS if set(signs) <= set(BASE32_SIGNS) else BASE36_SIGNS
    elif upper and lower and not (set("+/") & set(signs) and set("-_") & set(signs)):
        table = BASE64_SIGNS + ("-_" if set("-_") & set(signs) else "+/")
    else:
        return None
    value = {c: i for i, c in enumerate(table)}
    return np.array([*(value[c] for c in signs), len(table)])


def battery(values: np.ndarray, size: int) -> float:
    """The smallest p-value, times three, of uniformity, runs and serial correlation."""
    n = len(values)
    chi2 = float(((np.bincount(values, minlength=size) - n / size) ** 2).sum() * size / n)
    freedom = size - 1
    uniform = _normal_tail(((chi2 / freedom) ** (1 / 3) - (1 - 2 / (9 * freedom))) / math.sqrt(2 / (9 * freedom)))
    high = values >= size / 2
    up = int(high.sum())
    down = n - up
    if not up or not down:
        return 0.0
    mean = 2 * up * down / n + 1
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    runs = 2 * _normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / spread)
    centred = values - values.mean()
    serial = 2 * _normal_tail(abs(float((centred[1:] * centred[:-1]).sum() / max((centred ** 2).sum(), 1e-9))) * math.sqrt(n))
    return min(1.0, 3 * min(uniform, runs, serial))


def ordinary(token: str) -> float:
    """The chance that an ordinary token of this length changes character class as often."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "s" for c in token]
    n, k, q = len(token) - 1, sum(a != b for a, b in zip(kinds, kinds[1:])), ORDINARY_CHANGES
    log = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(q) + (n - i) * math.log1p(-q) for i in range(k, n + 1)]
    top = max(log)
    return min(1.0, math.exp(top) * math.fsum(math.exp(x - top) for x in log))


def spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all spans in code points, by start, then kind in the order of ``KINDS``."""
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGNED]
    out += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    out += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    tokens, at, base = [], 0, sorted((s, e) for s, e, _ in out)
    last = 0  # where the spans that begin before the candidate's end reach
    for m in CANDIDATE.finditer(text):
        while at < len(base) and base[at][0] < m.end():
            last = max(last, base[at][1])
            at += 1
        if m.start() < last:
            continue
        values = encoding(m.group())
        if values is not None:
            tokens.append((m, values))
    if tokens:  # weighted Benjamini-Hochberg over the document's candidates
        mean = sum(len(v) for _, v in tokens) / len(tokens)
        ranked = sorted((ordinary(m.group().rstrip("=")) * mean / len(v), m.start()) for m, v in tokens)
        bound = max((p for i, (p, _) in enumerate(ranked, 1) if p <= DISCOVERY_RATE * i / len(ranked)), default=-1)
        found = {at for p, at in ranked if p <= bound}
        out += [(m.start(), m.end(), "random") for m, v in tokens if m.start() in found and battery(v[:-1], int(v[-1])) >= BATTERY_LEVEL]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def find(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``spans``: kind, start and end (exclusive, code points) of every secret in the whole text."""
    rows = df.select(df[key].alias(key), df[text].cast("string").alias("text_"))
    schema = T.StructType([df.schema[key], T.StructField("spans", SPANS)])

    def run(batches):
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for s, e, k in spans(v.as_py() or "")] for v in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=[key, "spans"])

    return ship(rows).mapInArrow(settled(run), schema)


def mask(text: str, found: list[tuple[int, int, str]], mark: str) -> str:
    """``text`` with every stretch of overlapping spans replaced by one ``mark``."""
    out, at = [], 0
    for start, end, _ in found:
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact(df: DataFrame, text: str = "text", chars: str | None = "n_chars", mark: str = "[SECRET]") -> DataFrame:
    """``df`` with the secrets of ``text`` replaced and, where something was, ``chars`` counted anew; other rows and columns stay as they are."""
    names = df.columns
    t, c = names.index(text), names.index(chars) if chars in names else None

    def run(batches):
        for batch in batches:
            columns, texts = list(batch.columns), batch.column(t).to_pylist()
            counts = batch.column(c).to_pylist() if c is not None else None
            for i, old in enumerate(texts):
                if old and (found := spans(old)):
                    texts[i] = mask(old, found, mark)
                    if counts:
                        counts[i] = len(texts[i])
            columns[t] = pa.array(texts, batch.schema.field(t).type)
            if counts:
                columns[c] = pa.array(counts, batch.schema.field(c).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return ship(df).mapInArrow(settled(run), df.schema)
