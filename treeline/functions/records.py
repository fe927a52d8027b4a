"""Content hashes and JSON record counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Tables whose records lie under a key of their own.
WRAPPED = {"stage_table.json": "stages", "item_table.json": "items", "enemy_handbook_table.json": "enemyData"}


def sha256_hex(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def same_content(size_a: Column, sha_a: Column, size_b: Column, sha_b: Column) -> Column:
    """Sizes first: they differ for most changed files."""
    return size_a.eqNullSafe(size_b) & sha_a.eqNullSafe(sha_b)


def record_count(json: Column, wrapper: str | None = None) -> Column:
    """Distinct keys of an object (of the one under ``wrapper``, if it is there), or elements of an array; null for anything else."""
    own = F.coalesce(F.size(F.array_distinct(F.json_object_keys(json))), F.json_array_length(json))
    if wrapper is None:
        return own
    inner = F.get_json_object(json, f"$.{wrapper}")
    return F.coalesce(F.size(F.array_distinct(F.json_object_keys(inner))), own)
