"""Build state of the artwork pipeline, and what to fetch next from it.

State is three relations: bundle_hash(bundle, hash), bundle_candidate(bundle, skin_id), valid_skin(skin_id).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VERSION = "images-build-state/v1"


def bundle_actions(current: DataFrame, previous: DataFrame, name: str = "bundle", digest: str = "hash") -> DataFrame:
    """name, action: ``download`` unless the previous hash is equal."""
    p = previous.select(name, F.col(digest).alias("__p"), F.lit(True).alias("__had"))
    same = F.col("__had").isNotNull() & F.col(digest).eqNullSafe(F.col("__p"))
    return current.join(p, name, "left").select(name, F.when(same, "unchanged").otherwise("download").alias("action"))


def forced(required: DataFrame, changed: DataFrame, known: DataFrame, cached: DataFrame | None = None, name: str = "bundle") -> DataFrame:
    """Required bundles beyond the changed ones, that exist, and (given ``cached``) aren't there already."""
    out = required.select(name).distinct().join(changed.select(name), name, "left_anti").join(known.select(name), name, "left_semi")
    return out if cached is None else out.join(cached.select(name), name, "left_anti")


def removed(previous: DataFrame, known: DataFrame, name: str = "bundle") -> DataFrame:
    return previous.select(name).distinct().join(known.select(name), name, "left_anti")


def saved_hashes(current: DataFrame, failed: DataFrame, name: str = "bundle") -> DataFrame:
    """Current hashes less failed downloads, so that those are tried again."""
    return current.join(failed.select(name), name, "left_anti")


def stale(cached: DataFrame, valid: DataFrame, name: str = "bundle") -> DataFrame:
    return cached.join(valid.select(name), name, "left_anti")


def valid_skins(skins: DataFrame, characters: DataFrame) -> DataFrame:
    """Skins (skin_id, char_id) of known ``char_*`` characters (key), but for ``token_*`` skins."""
    known = characters.select(F.col("key").alias("char_id")).filter(F.col("char_id").startswith("char_"))
    return skins.filter(~F.col("skin_id").startswith("token_")).join(known, "char_id", "left_semi").select("skin_id")


def bundles_for(candidates: DataFrame, skins: DataFrame) -> DataFrame:
    return candidates.join(skins.select("skin_id"), "skin_id", "left_semi").select("bundle").distinct()


def candidates_for(candidates: DataFrame, bundles: DataFrame) -> DataFrame:
    return candidates.join(bundles.select("bundle"), "bundle", "left_semi").select("skin_id").distinct()


def affected(partial: DataFrame, candidates: DataFrame, processed: DataFrame, gone: DataFrame, was_valid: DataFrame, valid: DataFrame) -> DataFrame:
    """Skins whose entries can't be carried over: extracted again, of touched bundles, or no longer valid."""
    touched = candidates_for(candidates, processed.select("bundle").union(gone.select("bundle")))
    return partial.select("skin_id").union(touched).union(was_valid.join(valid, "skin_id", "left_anti").select("skin_id")).distinct()


def uncovered(new: DataFrame, partial: DataFrame) -> DataFrame:
    """New skins that the partial extraction lacks: a release must not go on with any."""
    return new.join(partial.select("skin_id"), "skin_id", "left_anti")


def merge_incremental(previous: DataFrame, partial: DataFrame, valid: DataFrame, touched: DataFrame, key: str = "skin_id") -> DataFrame:
    """The previous index less touched and invalid entries, with the valid ones of the partial index."""
    fresh = partial.join(valid.select(key), key, "left_semi")
    kept = previous.join(valid.select(key), key, "left_semi").join(touched.select(key), key, "left_anti").join(partial.select(key), key, "left_anti")
    return kept.unionByName(fresh)


def next_candidates(previous: DataFrame, extracted: DataFrame, current: DataFrame, processed: DataFrame) -> DataFrame:
    """Candidates of bundles that still exist, those of processed bundles anew."""
    kept = previous.join(processed.select("bundle"), "bundle", "left_anti").select("bundle", "skin_id")
    return kept.union(extracted.select("bundle", "skin_id")).join(current.select("bundle"), "bundle", "left_semi").distinct()


def checked_state(raw: object, may_be_empty: bool = False) -> dict | None:
    """A state as read from JSON, or None (build everything) if any part isn't as it must be. A saved one ``may_be_empty``: no bundles, no valid skins."""
    if not isinstance(raw, dict) or raw.get("schemaVersion") != VERSION or not (isinstance(raw.get("versionId"), str) and raw["versionId"]):
        return None
    hashes, candidates, valid = raw.get("bundleHashes"), raw.get("bundleCandidates"), raw.get("validSkinIds")
    text = lambda x: isinstance(x, str) and x != ""
    if not isinstance(hashes, dict) or not (hashes or may_be_empty) or not all(text(k) and text(v) for k, v in hashes.items()):
        return None
    if not isinstance(candidates, dict) or not all(text(k) and isinstance(v, list) and all(map(text, v)) for k, v in candidates.items()):
        return None
    return raw if isinstance(valid, list) and (valid or may_be_empty) and all(map(text, valid)) else None


def matches_index(state: dict | None, index_version: str | None) -> bool:
    return bool(state and index_version) and state["versionId"] == index_version
