"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.llm import bpe, chat, language, mixing, negatives, neighbours, pages, passages, phrases, quality, secrets, sharding, simhash
from prosestat.llm.shared import read, whole

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24


def sha_of(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded from its ids."""
    ids = bpe.encode(read(spark, sf_dir, "documents"), TOKENIZER, decoded=True)
    return ids.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), sha_of(F.col("decoded")).alias("decoded_sha256"))


# The tree of the mixture: a domain groups sources by their digest, then language, then source.
DOMAIN_WEIGHTS = {"web": 4, "books": 3, "forum": 2, "code": 1}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 2, "es": 1}
EPOCHS, MIX_PERCENT, MIX_SEED = 3, 80, 11


def _weight_of(node: Column, weights: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for name, w in weights.items():
        out = F.when(node == name, w).otherwise(out)
    return out


def mixture_levels() -> list[mixing.Level]:
    digit = F.substring(F.md5(whole("source")), 1, 1)
    domain = F.when(digit < "4", "web").when(digit < "8", "books").when(digit < "c", "forum").otherwise("code")
    return [mixing.Level("domain", domain, _weight_of(domain, DOMAIN_WEIGHTS, 1)), mixing.Level("lang", F.col("lang"), _weight_of(F.col("lang"), LANG_WEIGHTS, 1)),
            mixing.Level("source", F.col("source"), F.lit(1))]


def token_estimate() -> Column:
    """A token for every four bytes, begun ones included."""
    return F.call_function("div", F.octet_length(whole("text")) + 3, F.lit(4))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is drawn for the target mixture."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", token_estimate().alias("n"))
    mixed = mixing.mix(docs, mixture_levels(), F.col("n"), budget_percent=MIX_PERCENT, max_epochs=EPOCHS, seed=MIX_SEED)
    return mixed.select("doc_id", "domain", "lang", "source", "tokens", "copies")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes; a null text has no checksum."""
    docs = read(spark, sf_dir, "documents").select("doc_id", F.col("text"), F.crc32("text").alias("text_crc32"))
    sharded = sharding.histogram_shards(docs, F.col("text"), F.col("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)) + 8, SHARDS, keep=("doc_id", "text_crc32"))
    return sharded.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures and verdict of every document."""
    judged = quality.assess(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The secrets of every document."""
    def told(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    found = secrets.find(read(spark, sf_dir, "documents"))
    return found.select("doc_id", count("assign"), count("access"), count("hex"), sha_of(told(F.filter("spans", lambda s: s["kind"] != "random"))).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


def op6_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(read(spark, sf_dir, "pages"))


def _with_forged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts hold marks of the template."""
    forged = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-1, 0, "user", forged), (-1, 1, "assistant", forged)], "conv_id long, turn long, role string, text string")
    return read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the examples of each conversation hold, read back from them."""
    made = chat.examples(_with_forged(spark, sf_dir))
    turns = F.when(F.col("whole_text"), chat.read_turns(F.col("text")))
    told = made.select("conv_id", F.length("text").cast("long").alias("chars"), F.struct("example", chat.trainable(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("text")).alias("loss"),
                       F.size(turns).cast("long").alias("n"), sha_of(F.array_join(F.transform(turns, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")).alias("sha"))
    by = told.groupBy("conv_id").agg(F.max(F.when(F.col("sha").isNotNull(), F.col("n"))).alias("n_turns"), F.max("sha").alias("turns_sha256"),
                                     F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("loss")).alias("losses"))
    loss = F.array_join(F.transform("losses", lambda x: x["text"]), "")
    return by.select("conv_id", "n_turns", "turns_sha256", loss.alias("loss"), "formatted_chars").select(
        "conv_id", "n_turns", "turns_sha256", F.length("loss").cast("long").alias("loss_chars"), sha_of(F.col("loss")).alias("loss_sha256"), "formatted_chars")


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from four fifths of them."""
    docs = read(spark, sf_dir, "documents")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    names, model = language.train(docs, ~held)
    return language.identify(docs, names, model).select("doc_id", held.alias("held_out"), "lang_pred", "score", F.array_join("languages", ",").alias("languages"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest vectors found for each hundredth."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), lambda i: i % 100 == 0)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    return simhash.near_groups(read(spark, sf_dir, "documents"))


TOP_PHRASES = 2000


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of two and three words of each language."""
    return phrases.collocations(read(spark, sf_dir, "documents"), top=TOP_PHRASES)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector; every seventh label is one too high."""
    rows = read(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, lambda i: i % 100 == 0)


def op13_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without the windows of 50 words that an earlier one has."""
    left = passages.remove(read(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_words", "n_removed", sha_of(F.col("kept")).alias("kept_sha256"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_mixing, op3_sharding, op4_quality, op5_secrets, op6_html, op7_chat, op8_language, op9_neighbours, op10_simhash,
                                   op11_phrases, op12_negatives, op13_passages)}
