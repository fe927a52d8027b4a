"""A training corpus from raw documents, in five stages, each a DataFrame of the one before.

language_id drops documents whose language can't be told; near_duplicates keeps one document of each group;
decontamination drops documents that hold a benchmark item; mixing repeats or drops documents towards the target
weights of the sources; token_store writes the rest to token shards and returns what the shards hold.

All but the last return the columns of their input. Null and empty texts have no language, so the first stage drops
them. Column names that clash with working columns don't occur: those start with two underscores.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeline.llm import decontaminate, jaccard_join, language_id, mixing, token_store
from treeline.llm.shared_store import importable, new_folder

VOCABULARY = "byte_bpe_50k.json"
LEAST_SCORE = 0.1  #: a text further from every profile is in none of the languages


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    profiles = language_id.learn_profiles(docs.filter(~language_id.held_out()))
    found = language_id.identify(docs, profiles, names=("__language", "__language_score"))
    known = (F.col("__language") != language_id.UNKNOWN) & (F.col("__language_score") >= LEAST_SCORE)
    return found.filter(known).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard_join.keep_one(docs, threshold=0.8, size=5)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.replicate(docs, temperature=0.5, seed=7).select(*docs.columns)


def store_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    manifest = token_store.write_shards(docs, public_tokenizers.path(VOCABULARY), end_id=2)
    return token_store.read_digests(manifest)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_store", store_tokens),
]

#: The profiles, signatures, latent basis and tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
