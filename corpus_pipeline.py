"""A training corpus from raw documents: quality, near copies, secrets, mixture, tokens."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from prosestat.llm import bpe, mixing, quality, secrets, simhash
from prosestat.llm.queries import EPOCHS, MIX_SEED, TOKENIZER, mixture_levels, sha_of, token_estimate
from prosestat.llm.shared import read, written

#: Tokens drawn, as a share of those that are left before the mixture.
PERCENT = 90


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.passing(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of fingerprints (three-word shingles, 2 bits) stays: that of the smallest id."""
    return simhash.one_of_each(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; every document stays."""
    return secrets.redact(docs)


def source_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn for the target weights; one drawn in several epochs is there as often."""
    own = docs.columns
    held = docs.select(F.struct(*own).alias("row_"), "doc_id", "lang", "source", token_estimate().alias("n"))
    drawn = mixing.mix(held, mixture_levels(), F.col("n"), budget_percent=PERCENT, max_epochs=EPOCHS, seed=MIX_SEED)
    return drawn.where("copies > 0").select("row_", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("row_.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each drawn text (packed 32-bit integers), with their digest and that of the text decoded from them."""
    told = bpe.encode(docs, TOKENIZER, decoded=True)
    return told.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), sha_of(F.col("decoded")).alias("decoded_sha256"))


STAGES = [("quality rules", quality_rules), ("near copies", near_dedup), ("secrets", secret_scan), ("mixture", source_mixture), ("tokens", tokens)]

#: Fingerprint groups, randomness tests and tokens are not SQL; the tests hold the run against a plain version of the five stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; each stage but the last is written to the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
