"""SimHash near-duplicate groups through a byte-position inverted index with count filtering.

Two 64-bit fingerprints within 2 bits differ in at most 2 of their 8 positional
bytes, so they share at least 6. The index has a posting for each of six sets of
four byte positions; whichever two bytes differ, one of the sets avoids both, so
every linked pair meets in a posting. A pair that meets is tallied (positional
bytes in common), kept from 6 on, and verified by its differing bits.

Exact copies of a fingerprint are one entry. A posting of more than
``posting_cap`` different fingerprints emits no pairs; its members take the
exact way for hot postings: each lists itself and its 64 one-bit neighbours, and
fingerprints that list the same value (65 at most) are within 2 bits. Two
fingerprints within 2 bits always list a common value, so no link is lost and
work stays linear in the group.

Null and empty texts have fingerprint zero and are linked like any other; rows
with a null id stay and are in the group of the ids with their fingerprint, a
fingerprint of null ids alone links to none and has a null component; repeated
rows stay; an empty table gives an empty table; columns beyond the two named
ones are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from prosestat.llm.components import smallest_reachable
from prosestat.llm.shared import settled, ship, written

BYTES = 8
#: Most bits by which linked fingerprints differ, and so the most positional bytes.
MOST_BITS = 2
LEAST_SHARED = BYTES - MOST_BITS
#: For any two byte positions one of these sets holds neither.
POSITION_SETS = ((0, 1, 2, 3), (0, 1, 4, 5), (2, 3, 4, 5), (0, 1, 6, 7), (2, 3, 6, 7), (4, 5, 6, 7))
#: Different fingerprints in a posting up to which its pairs are emitted.
POSTING_CAP = 64
_BLOCK = 1 << 16


def shingle_majority(text: str | None, words_in_shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of a whole text, as an unsigned number."""
    # bytes.lower and bytes.split know ASCII letters and the white space x20, x09-x0D only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest, k = xxhash.xxh64_intdigest, words_in_shingle
    n = max(1, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, _BLOCK):  # in blocks, so that a huge text needs little beside itself
        stop = min(n, start + _BLOCK)
        block = words[start: stop + k - 1]
        shingles = map(b" ".join, zip(*(block[i:] for i in range(k)))) if len(words) >= k else [b" ".join(words)]
        hashes = np.fromiter((digest(s, seed) for s in shingles), np.uint64, stop - start)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words_in_shingle: int = 3, digest: bool = False) -> DataFrame:
    """``key`` and ``bits``, the 64-bit fingerprint as a signed long, of every whole text; with ``digest`` also ``digest_`` of the text."""
    told = [text_digest(df[text]).alias("digest_")] if digest else []
    rows = df.select(df[key].alias(key), df[text].cast("string").alias("text_"), *told)

    def run(batches):
        for batch in batches:
            bits = np.fromiter((shingle_majority(v.as_py(), words_in_shingle) for v in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64)), *batch.columns[2:]], names=[key, "bits", "digest_"][:batch.num_columns])

    return ship(rows).mapInArrow(settled(run), T.StructType([df.schema[key], T.StructField("bits", T.LongType()), *rows.schema.fields[2:]]))


def text_digest(text: Column) -> Column:
    """64 bits that tell apart the texts of rows with one id."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _bytes_at(bits: Column, positions: tuple[int, ...]) -> Column:
    mask = sum(0xFF << (8 * p) for p in positions)
    return bits.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many positional bytes two fingerprints share."""
    x = a.bitwiseXOR(b)
    return sum((_bytes_at(x, (p,)) == 0).cast("int") for p in range(BYTES))


def postings(prints: DataFrame) -> DataFrame:
    """(slots, part, bits): each fingerprint under each of its position sets."""
    sets = F.array(*[F.struct(F.lit(i).alias("slots"), _bytes_at(F.col("bits"), s).alias("part")) for i, s in enumerate(POSITION_SETS)])
    return prints.select("bits", F.explode(sets).alias("at")).select("at.slots", "at.part", "bits")


def links(prints: DataFrame, posting_cap: int = POSTING_CAP) -> DataFrame:
    """(a, b): links between different fingerprints of ``prints`` (column bits, distinct) that give its groups.

    Every pair within the bound in a small posting is a link. Those of a hot
    posting are replaced by links to the smallest fingerprint that lists the same
    neighbour, which are fewer and join the same fingerprints.
    """
    posted = postings(prints)
    sizes = posted.groupBy("slots", "part").agg(F.count("*").alias("size")).where("size > 1")
    placed = posted.join(sizes, ["slots", "part"])
    few = placed.where(F.col("size") <= posting_cap).select("slots", "part", "bits")
    a, b = few.alias("a"), few.alias("b")
    close = a.join(b, (F.col("a.slots") == F.col("b.slots")) & (F.col("a.part") == F.col("b.part")) & (F.col("a.bits") < F.col("b.bits"))
                   & (shared_bytes(F.col("a.bits"), F.col("b.bits")) >= LEAST_SHARED)
                   & (F.bit_count(F.col("a.bits").bitwiseXOR(F.col("b.bits"))) <= MOST_BITS))
    pairs = close.select(F.col("a.bits").alias("a"), F.col("b.bits").alias("b"))

    hot = placed.where(F.col("size") > posting_cap).select("bits").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64) if i == 63 else 1 << i).cast("long") for i in range(64)])
    listed = hot.select("bits", F.explode(F.transform(flips, lambda f: F.col("bits").bitwiseXOR(f))).alias("value"))
    least = listed.groupBy("value").agg(F.min("bits").alias("least"), F.count("*").alias("size")).where("size > 1").select("value", "least")
    stars = listed.join(least, "value").where("bits != least").select(F.col("least").alias("a"), F.col("bits").alias("b"))
    return pairs.unionByName(stars).distinct()


def _grouped(marked: DataFrame, key: str, posting_cap: int) -> DataFrame:
    """``marked`` (written fingerprints) with ``component_id``."""
    prints = written(marked.groupBy("bits").agg(F.min(key).alias("node")), "prints")
    found = links(prints.select("bits"), posting_cap)
    named = (found.join(prints.withColumnsRenamed({"bits": "a", "node": "x"}), "a")
             .join(prints.withColumnsRenamed({"bits": "b", "node": "y"}), "b").select("x", "y"))
    groups = smallest_reachable(named)
    own = prints.join(groups, "node", "left").select("bits", F.coalesce("least", "node").alias("component_id"))
    return marked.join(own, "bits")


def near_groups(df: DataFrame, key: str = "doc_id", text: str = "text", words_in_shingle: int = 3, posting_cap: int = POSTING_CAP) -> DataFrame:
    """``key``, ``fingerprint`` (16 hexadecimal digits), ``component_id``: the smallest id reachable over links."""
    grouped = _grouped(written(fingerprints(df, key, text, words_in_shingle), "fingerprints"), key, posting_cap)
    return grouped.select(key, F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, key: str = "doc_id", text: str = "text", words_in_shingle: int = 3, posting_cap: int = POSTING_CAP) -> DataFrame:
    """``df`` with one row of each group: that of the smallest ``key``, all columns as they are.

    Of rows with that key but different texts the least digest stays, of repeated rows
    one. Rows with a null key go if their group has another, else one stays for each
    fingerprint. Only keys and digests are grouped; the texts meet the rows to drop once.
    """
    marked = written(fingerprints(df, key, text, words_in_shingle, digest=True), "fingerprints")
    rows = _grouped(marked, key, posting_cap).withColumn("alone", F.when(F.col("component_id").isNull(), F.col("bits"))).groupBy(
        "component_id", "alone", key, "digest_").agg(F.count("*").alias("times"))  # of null keys alone a group is a fingerprint
    rank = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "digest_")
    first = rows.groupBy(F.col("component_id").alias("c"), F.col("alone").alias("a")).agg(F.min(rank).alias("first"))
    told = written(rows.join(first, F.col("component_id").eqNullSafe(F.col("c")) & F.col("alone").eqNullSafe(F.col("a"))).select(
        F.col(key).alias("id_"), F.col("digest_").alias("asked_"), "times", (rank != F.col("first")).alias("copy")), "told")
    at = df[key].eqNullSafe(F.col("id_")) & (text_digest(df[text]) == F.col("asked_"))
    kept = df.join(told.where("copy or times > 1"), at, "left_anti")
    repeated = told.where("not copy and times > 1")
    if repeated.isEmpty():
        return kept
    again = df.join(repeated, at).dropDuplicates(["id_", "asked_"]).select(*[df[c] for c in df.columns])
    return kept.unionByName(again)
