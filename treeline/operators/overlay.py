"""Laying a fresh snapshot over the accumulated one. Nothing is ever deleted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ADDED, CHANGED, UNCHANGED, KEPT = "added", "changed", "unchanged", "kept"
SHOWN = 50  #: paths in the report


def overlay(base: DataFrame, fresh: DataFrame, key: str = "path", digest: str = "sha256", size: str | None = None) -> DataFrame:
    """All keys of both, with the fresh row where there is one, and ``status``. Carry hashes, not contents: one shuffle of both sides by key."""
    rest = [c for c in base.columns if c != key]
    b = base.select(key, F.struct(*rest).alias("__b"))
    f = fresh.select(key, F.struct(*rest).alias("__f"))
    equal = F.col(f"__b.{digest}").eqNullSafe(F.col(f"__f.{digest}"))
    if size:
        equal = F.col(f"__b.{size}").eqNullSafe(F.col(f"__f.{size}")) & equal
    status = F.when(F.col("__b").isNull(), ADDED).when(F.col("__f").isNull(), KEPT).when(equal, UNCHANGED).otherwise(CHANGED)
    row = F.coalesce("__f", "__b")
    return b.join(f, key, "full_outer").select(key, status.alias("status"), *[row[c].alias(c) for c in rest])


def merge_stats(merged: DataFrame) -> DataFrame:
    """Rows by status, as one row."""
    n = lambda s: F.count_if(F.col("status") == s)
    return merged.agg(n(ADDED).alias("added"), n(CHANGED).alias("changed"), n(UNCHANGED).alias("unchanged"), n(KEPT).alias("kept_from_baseline"))


def first_paths(merged: DataFrame, key: str = "path", limit: int = SHOWN) -> DataFrame:
    """The first paths of each kind of change; each task hands on that many of each at most."""
    order = Window.partitionBy("status").orderBy(key)
    changed = merged.filter(F.col("status").isin(ADDED, CHANGED)).select("status", key)
    return changed.withColumn("__n", F.row_number().over(order)).filter(F.col("__n") <= limit).drop("__n")


def kept_from_baseline(base: DataFrame, fresh: DataFrame, key: str = "path") -> DataFrame:
    return base.join(fresh.select(key), key, "left_anti")


def normalize_layout(tree: DataFrame, server: str, target: str = "zh_CN", excluded: list[str] | None = None) -> DataFrame:
    """``<server>/gamedata/**`` as ``<target>/gamedata/**``, without paths that match a glob; ``*`` crosses directories."""
    out = tree.filter(F.col("path").startswith(f"{server}/gamedata/")).withColumn("path", F.concat(F.lit(f"{target}/"), F.substring("path", len(server) + 2, 1 << 30)))
    for glob in excluded or []:
        out = out.filter(~_globbed(F.col("path"), glob))
    return out


def _globbed(path: Column, glob: str) -> Column:
    import fnmatch

    return path.rlike("^" + fnmatch.translate(glob).replace(r"\Z", "").replace(r"\z", "") + "$")


POLICY = {"version": "normalization/v1", "layouts": ["<server>/gamedata -> zh_CN/gamedata"], "exclusions": []}
