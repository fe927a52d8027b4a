"""The registered queries of this subpackage, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, decontaminate, jaccard_join, language_id, mixing, pii, suffix_dedup, token_counts, token_store, warc
from .shared_store import importable

VOCABULARY = "byte_bpe_50k.json"
CONTEXT_TOKENS = 1024


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return importable(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.replicate(_table(spark, sf_dir, "documents"), temperature=0.5, seed=7)
    return mixed.withColumnsRenamed({"__mix_copy": "copy", "__mix_n": "n_copies"})


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(_table(spark, sf_dir, "pages"), min_revisit_bytes=0)
    return warc.read_records(index).select(F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(pii.joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), pii.joined(F.col("spans")).alias("spans"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"), threshold=0.8, size=5)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY))
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > CONTEXT_TOKENS).alias("over_limit"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn_profiles(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, profiles, keep=["doc_id"])
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score")


def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_store.write_shards(_table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), end_id=2)
    return token_store.read_digests(manifest)


QUERIES = {
    "op1_ann": op1_ann,
    "op2_mixing": op2_mixing,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_counts": op7_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_language_id": op9_language_id,
    "op10_token_store": op10_token_store,
}

#: The others are beyond SQL (codes, indexes, models, tokenizers); their tests compare with brute force.
SQL: dict[str, str] = {"op2_mixing": mixing.REPLICATE_SQL}
