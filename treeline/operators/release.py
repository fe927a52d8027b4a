"""Release discovery and verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed value: assets of a complete data release.
REQUIRED_ASSETS = ["zh_CN-excel.zip", "zh_CN-levels.zip", "zh_CN.zip", "manifest.json"]


def bundle_count(hot_update: DataFrame) -> DataFrame:
    """versionId, manifestVersion, abCount of hot-update lists (one JSON text a row, content)."""
    j = F.from_json("content", "struct<versionId:string,manifestVersion:string,abInfos:array<struct<name:string,hash:string>>>")
    return hot_update.select(j.alias("j")).select("j.versionId", "j.manifestVersion", F.coalesce(F.size("j.abInfos"), F.lit(0)).alias("abCount"))


def version_changed(remote: Column, published: Column, force: Column | bool = False) -> Column:
    return (F.lit(force) if isinstance(force, bool) else force) | ~remote.eqNullSafe(published)


def complete(releases: DataFrame, required: list[str] = REQUIRED_ASSETS) -> DataFrame:
    """Releases (tag, is_draft, assets) that are out and have all required assets."""
    names = F.transform("assets", lambda a: a["name"])
    return releases.filter(~F.col("is_draft") & (F.size(F.array_except(F.array(*map(F.lit, required)), names)) == 0))


def latest(rows: DataFrame, order: list[Column], limit: int = 1) -> DataFrame:
    """The newest rows: a top-k, without a sort of all."""
    return rows.orderBy(*order).limit(limit)


def is_image_delta(tag: Column) -> Column:
    return tag.startswith("images-") & ~tag.startswith("images-baseline-")


def latest_image_version(releases: DataFrame) -> DataFrame:
    """version of the newest image release with an index. releases: tag, is_draft, created, assets."""
    has_index = F.exists("assets", lambda a: a["name"] == "index.json")
    some = releases.filter(is_image_delta(F.col("tag")) & ~F.col("is_draft") & has_index)
    return latest(some, [F.desc("created"), F.desc("tag")]).select(F.expr("substring(tag, 8)").alias("version"))


def mismatched_assets(local: DataFrame, remote: DataFrame, name: str = "name") -> DataFrame:
    """Local assets (name, size, digest) that are missing, or differ in size or digest, on the other side."""
    r = remote.select(name, F.col("size").alias("__size"), F.col("digest").alias("__digest"))
    same = F.coalesce((F.col("size") == F.col("__size")) & (F.col("digest") == F.col("__digest")), F.lit(False))
    return local.join(r, name, "left").filter(~same).select(*local.columns)


def asset_url(base: Column, platform: Column, version: Column, path: Column) -> Column:
    return F.concat_ws("/", base, platform, F.lit("assets"), version, path)


def upload_order(assets: DataFrame) -> DataFrame:
    """Smallest first."""
    return assets.orderBy("size", "name")


def verify_manifest(manifest: dict | None, tag: str, contract: object, contents: dict[str, bytes]) -> None:
    """Raise unless the manifest is of this contract and tag and has every content's size and hash. No manifest is tolerated."""
    if manifest is None:
        return
    if manifest.get("contractVersion") != contract:
        raise ValueError(f"contract {manifest.get('contractVersion')} is not {contract}")
    source = manifest["source"] if "source" in manifest else (manifest.get("merge") or {}).get("source") or {}
    if not isinstance(source, dict):
        raise ValueError("the manifest's source is no object")
    if tag.startswith("data-") and tag != f"data-{source.get('versionId')}":
        raise ValueError(f"{tag} holds version {source.get('versionId')}")
    for name, content in sorted(contents.items()):
        wanted = (manifest.get("assets") or {}).get(name) or {}
        verify_asset(name, content, wanted.get("size"), f"sha256:{wanted.get('sha256')}")


def verify_asset(name: str, content: bytes, size: object, digest: object) -> None:
    """Raise unless the content has the size and the ``sha256:`` digest that the registry gives."""
    import hashlib

    if not isinstance(size, int) or isinstance(size, bool):
        raise ValueError(f"{name} has no valid size")
    if not isinstance(digest, str) or not digest.startswith("sha256:"):
        raise ValueError(f"{name} has no valid digest")
    if len(content) != size or f"sha256:{hashlib.sha256(content).hexdigest()}" != digest:
        raise ValueError(f"{name} differs from its size or digest")
