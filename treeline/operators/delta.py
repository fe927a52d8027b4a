"""Differences of two indexes, first versions, and what goes into which archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TIERS = ["original", "large", "preview"]


def delta(current: DataFrame, previous: DataFrame | None, key: str = "skin_id", tiers: list[str] = TIERS) -> DataFrame:
    """key, change (added, changed, removed). A tier's hash may be null; null equals null. Without a previous index all are added."""
    if previous is None:
        return current.select(key, F.lit("added").alias("change"))
    c = current.select(key, F.struct(*tiers).alias("__c"))
    p = previous.select(key, F.struct(*tiers).alias("__p"))
    differs = F.lit(False)
    for t in tiers:
        differs = differs | ~F.col(f"__c.{t}").eqNullSafe(F.col(f"__p.{t}"))
    change = F.when(F.col("__p").isNull(), "added").when(F.col("__c").isNull(), "removed").when(differs, "changed")
    return c.join(p, key, "full_outer").select(key, change.alias("change")).filter("change is not null")


def since_version(current: DataFrame, previous: DataFrame | None, version: str, key: str = "skin_id") -> DataFrame:
    """current with since_version: inherited, also by changed entries, or this version."""
    bare = current.drop("since_version")
    if previous is None:
        return bare.withColumn("since_version", F.lit(version))
    p = previous.select(key, F.col("since_version").alias("__since"))
    return bare.join(p, key, "left").withColumn("since_version", F.coalesce("__since", F.lit(version))).drop("__since")


def by_tier(index: DataFrame, columns: list[str], tiers: list[str] = TIERS) -> DataFrame:
    """One row per entry and tier."""
    return index.select(*columns, F.explode(F.array(*map(F.lit, tiers))).alias("tier"))


def shard_inventory(index: DataFrame, shard: str = "shard", size: str = "bytes", tiers: list[str] = TIERS) -> DataFrame:
    """Files and bytes of each ``<shard>-<tier>`` archive; one without files has no row."""
    return by_tier(index, [shard, size], tiers).groupBy(F.concat_ws("-", F.col(shard), F.col("tier")).alias("shard_key")).agg(F.count("*").alias("files"), F.sum(size).cast("long").alias("total_bytes"))


def delta_files(index: DataFrame, changes: DataFrame, files: DataFrame, key: str = "skin_id", tiers: list[str] = TIERS) -> DataFrame:
    """key, tier, file, found for all tiers of added and changed entries. files: file. Missing files are reported, not passed over."""
    some = index.join(changes.filter(F.col("change").isin("added", "changed")).select(key), key, "left_semi")
    wanted = by_tier(some, [key], tiers).withColumn("file", F.concat(F.col(key), F.lit("."), F.col("tier"), F.lit(".png")))
    return wanted.join(files.select("file", F.lit(True).alias("__f")).distinct(), "file", "left").select(key, "tier", "file", F.coalesce("__f", F.lit(False)).alias("found"))


def package_counts(changes: DataFrame) -> DataFrame:
    """Changes by kind, as one row."""
    n = lambda kind: F.count_if(F.col("change") == kind).alias(kind)
    return changes.agg(n("added"), n("changed"), n("removed"))


def is_empty(changes: DataFrame) -> bool:
    """Whether there is nothing to release; removals alone are nothing."""
    return not changes.filter(F.col("change").isin("added", "changed")).limit(1).count()
