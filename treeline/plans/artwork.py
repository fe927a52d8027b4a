"""The artwork chain over a working directory: plan, extract, index, variants, package, publish.

Bundles lie in ``bundles/``, PNG files in ``images/``, the excel tables in ``candidate/``; the index and state of the last
release in ``images-prev/``, those of this one in ``images-dist/``. A failed step leaves all of them as they were.
"""

from __future__ import annotations

import json
import shutil
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.text import cache_name
from ..operators import art, delta, state
from ..sources import archives, tables, tree
from ..sources.registry import Registry
from .factory import ROOT, Work, images_index, images_package, images_plan, write_tree

T = "struct<file:string,w:int,h:int,bytes:bigint,sha256:string>"
ENTRIES = f"skin_id string, kind string, shard string, original {T}, large {T}, preview {T}, since_version string"
Decoder = Callable[[bytes], Iterable[tuple[str, str, bytes]]]


def _json(path: Path) -> dict:
    return json.loads(path.read_text("utf-8")) if path.exists() else {}


def entries(spark, index: dict) -> DataFrame:
    """The artworks of an index file as rows."""
    rows = [(k, a["kind"], a["shard"], *[a.get(t) and tuple(a[t][x] for x in ("file", "w", "h", "bytes", "sha256")) for t in delta.TIERS], a.get("sinceVersion")) for k, a in sorted(index.get("artworks", {}).items())]
    return spark.createDataFrame(rows, ENTRIES)


def as_index(rows: DataFrame, **head: object) -> dict:
    """An index file from rows, sorted by skin."""
    out = {}
    for r in rows.orderBy("skin_id").toLocalIterator():
        a = {"kind": r["kind"], "shard": r["shard"], "sinceVersion": r["since_version"]} | {t: r[t].asDict() for t in delta.TIERS if r[t]}
        out[r["skin_id"]] = {k: v for k, v in a.items() if v is not None}
    return {**head, "artworks": out}


def valid(work: Work) -> DataFrame:
    """The skins that the tables name; a directory of tables that was named and isn't there is an error."""
    if work.excel and not work.excel.is_dir():
        raise FileNotFoundError(work.excel)
    excel, own = ("", tree.scan(work.spark, str(work.excel))) if work.excel else (f"{ROOT}/gamedata/excel/", work.tree("candidate"))
    table = lambda name: own.filter(F.col("path") == excel + name)
    skins = tables.keyed_records(table("skin_table.json"), wrapper="charSkins").select(F.col("key").alias("skin_id"), F.get_json_object("value", "$.charId").alias("char_id"))
    return state.valid_skins(skins, tables.keyed_records(table("character_table.json")))


def _hot_list(work: Work) -> tuple[str | None, DataFrame]:
    found = tables.hot_update(work.tree("extract"))
    row = found.select("versionId").first()
    return row and row["versionId"], found.select(F.explode("abInfos").alias("i")).select(F.col("i.name").alias("bundle"), F.col("i.hash").alias("hash"))


def fetch(work: Work) -> int:
    """Write the plan: what to download, what is gone, and whether the last state can be built on. Downloading is not of this engine; bundles that aren't in ``bundles/`` afterwards count as failed and are planned again."""
    version, hot = _hot_list(work)
    saved = work.spark.createDataFrame(sorted(work.record("images-hashes").items()), "bundle string, hash string")
    old = state.checked_state(_json(work.path / "images-prev/build-state.json"), may_be_empty=True)
    plan = images_plan(hot, saved, old, valid(work), _json(work.path / "images-prev/index.json").get("currentVersion"))
    names = lambda d, c: [r[c] for r in d.orderBy(c).toLocalIterator()]
    work.keep("images-plan", {"versionId": version, "incremental": plan["incremental"], "downloadedBundles": names(plan["downloads"], "bundle"), "removedBundles": names(plan["removed"], "bundle"), "newSkinIds": names(plan["new_skins"], "skin_id"), "currentValidSkinIds": names(valid(work), "skin_id")})
    return 0


def extract(work: Work, decode: Decoder) -> int:
    """Decode the planned bundles; a bundle that is missing or fails is recorded and tried again at the next plan."""
    plan, spark = work.record("images-plan"), work.spark
    wanted = spark.createDataFrame([(b,) for b in plan["downloadedBundles"]], "bundle string").withColumn("path", cache_name(F.col("bundle")))
    files = wanted.join(work.tree("bundles").filter("not is_dir").select("path", "content"), "path", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                try:
                    if row["content"] is None:
                        raise FileNotFoundError(row["path"])
                    found = [(row["bundle"], name, kind, i, png, None) for i, (name, kind, png) in enumerate(decode(row["content"]))]
                except Exception as e:  # noqa: BLE001  one bundle's failure is its own
                    found = [(row["bundle"], None, None, 0, None, f"{type(e).__name__}: {e}")]
                kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.binary(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], k) for i, k in enumerate(kinds)], ["bundle", "name", "kind", "pos", "content", "error"])

    decoded = files.mapInArrow(run, "bundle string, name string, kind string, pos int, content binary, error string").persist(StorageLevel.DISK_ONLY)
    best = art.extracted(decoded.filter("name is not null"))
    target = work.path / "images"
    shutil.rmtree(target, ignore_errors=True)
    target.mkdir(parents=True)
    first = Window.partitionBy("skin_id").orderBy("bundle")
    chosen = best.join(valid(work), "skin_id", "left_semi").withColumn("n", F.row_number().over(first)).filter("n = 1")
    write_tree(chosen.select(F.concat("skin_id", F.lit(".original.png")).alias("path"), F.lit(False).alias("is_dir"), "content"), target)
    pairs: dict[str, list[str]] = {b: [] for b in plan["downloadedBundles"]}
    for r in best.select("bundle", "skin_id").distinct().orderBy("bundle", "skin_id").toLocalIterator():
        pairs[r["bundle"]].append(r["skin_id"])
    failed = {r["bundle"]: r["error"] for r in decoded.filter("error is not null").toLocalIterator()}
    version, hot = _hot_list(work)
    good = state.saved_hashes(hot, spark.createDataFrame([(b,) for b in failed], "bundle string"))
    work.keep("images-hashes", {r["bundle"]: r["hash"] for r in good.orderBy("bundle").toLocalIterator()})
    work.keep("images-extract", {"bundleCandidates": {b: s for b, s in pairs.items() if b not in failed}, "failed": dict(sorted(failed.items())[:20])})
    decoded.unpersist()
    return 1 if failed else 0


def _pngs(work: Work) -> DataFrame:
    return work.tree("images").filter("not is_dir").select(F.col("path").alias("file"), "content")


def make_variants(work: Work, resize: Callable[[bytes, int, int], bytes] = art.pillow_resize) -> int:
    """Both scaled tiers, or neither."""
    originals = _pngs(work).filter(F.col("file").endswith(".original.png"))
    made = art.variants(originals, art.LARGE, "large", resize).union(art.variants(originals, art.PREVIEW, "preview", resize)).persist(StorageLevel.DISK_ONLY)
    try:
        write_tree(art.all_or_nothing(made).select(F.col("file").alias("path"), F.lit(False).alias("is_dir"), "content"), work.path / "images")
    except ValueError as e:
        work.keep("images-variants", {"error": str(e)})
        return 1
    finally:
        made.unpersist()
    return 0


def build_index(work: Work) -> int:
    """The index of the pictures that are there, in ``images-index/``, and what it lacks or passes over."""
    files, skins = _pngs(work), valid(work)
    rows = images_index(files, skins).withColumn("since_version", F.lit(None).cast("string"))
    archives.write_json(work.path / "images-index/index.json", as_index(rows, schemaVersion="images/v1", currentVersion=work.record("images-plan").get("versionId") or ""))
    gaps: dict[str, list[str]] = {"skipped": [], "missing": []}
    for r in art.index_gaps(files, skins).orderBy("skin_id").toLocalIterator():
        gaps[r["problem"]].append(r["skin_id"])
    work.keep("images-index", {"entries": rows.count(), **gaps})
    return 0


def package(work: Work) -> int:
    """Merge what was extracted into the last index, advance the state, and package all shards or a delta."""
    plan, spark, version = work.record("images-plan"), work.spark, work.record("images-plan").get("versionId") or ""
    previous = _json(work.path / "images-prev/index.json")
    files, skins = _pngs(work), spark.createDataFrame([(s,) for s in plan.get("currentValidSkinIds", [])], "skin_id string")
    partial = images_index(files, skins).withColumn("since_version", F.lit(None).cast("string"))
    index, before, dist = partial, entries(spark, previous) if previous else None, work.path / "images-dist"
    next_state = None
    if plan.get("currentValidSkinIds"):
        candidates = work.record("images-extract").get("bundleCandidates", {})
        flat = lambda d: spark.createDataFrame([(b, s) for b, ids in d.items() for s in ids], "bundle string, skin_id string")
        names = lambda x: spark.createDataFrame([(b,) for b in x], "bundle string")
        old = state.checked_state(_json(work.path / "images-prev/build-state.json"), may_be_empty=True) if plan["incremental"] else None
        old = old or {"bundleCandidates": {}, "validSkinIds": []}  # a full build carries nothing over from the last state
        lost = state.uncovered(spark.createDataFrame([(s,) for s in plan["newSkinIds"]], "skin_id string"), partial).limit(5).collect() if plan["incremental"] else []
        if lost:
            work.keep("images-package", {"error": f"new skins were not extracted: {[r['skin_id'] for r in lost]}"})
            return 1
        if before is not None:
            touched = state.affected(partial, flat(old["bundleCandidates"]), names(candidates), names(plan["removedBundles"]), spark.createDataFrame([(s,) for s in old["validSkinIds"]], "skin_id string"), skins)
            index = state.merge_incremental(before, partial.select(before.columns), skins, touched)
        hashes = work.record("images-hashes")
        pairs = state.next_candidates(flat(old["bundleCandidates"]), flat(candidates), names(hashes), names(candidates))
        grouped: dict[str, list[str]] = {b: [] for b in sorted(hashes)}
        for r in pairs.orderBy("bundle", "skin_id").toLocalIterator():
            grouped.setdefault(r["bundle"], []).append(r["skin_id"])
        next_state = {"schemaVersion": state.VERSION, "versionId": version, "bundleHashes": hashes, "bundleCandidates": grouped, "validSkinIds": plan["currentValidSkinIds"]}
    result = images_package(index, before, version, files, dist)
    head = {"schemaVersion": "images/v1", "baselineVersion": previous.get("baselineVersion", version), "currentVersion": version, "shards": previous.get("shards") or {a["name"].removesuffix(".zip"): a["name"] for a in result["assets"] if not a["name"].startswith("images-delta")}}
    archives.write_json(dist / "index.json", as_index(delta.since_version(index, before, version), **head))
    if next_state:
        archives.write_json(dist / "build-state.json", next_state)
    work.keep("images-package", result)
    return 0


def publish(work: Work, execute: bool = False) -> int:
    """Publish under image tags; only after that does this index become the previous one. An empty delta publishes nothing."""
    result, dist = work.record("images-package"), work.path / "images-dist"
    if result.get("mode") not in ("baseline", "delta"):
        return 1
    if result["empty"]:
        return 0
    registry, version = Registry(work.path / "registry"), result["version"]
    assets = [dist / a["name"] for a in result["assets"]]
    if result["mode"] == "baseline":
        registry.publish(work.spark, f"images-baseline-{version}", [a for a in assets if not a.name.startswith("images-delta")], execute)
    registry.publish(work.spark, f"images-{version}", [a for a in assets if a.name.startswith("images-delta")] + [dist / "index.json"], execute)
    if execute:
        staged = work.path / ".images-prev"
        shutil.rmtree(staged, ignore_errors=True)
        staged.mkdir(parents=True)
        for name in ("index.json", "build-state.json"):
            if (dist / name).exists():
                shutil.copyfile(dist / name, staged / name)
        archives.activate(staged, work.path / "images-prev")
    return 0


def run(work: Work, decode: Decoder, resize: Callable[[bytes, int, int], bytes] = art.pillow_resize, release_it: bool = False, force: bool = False) -> int:
    """All steps; a version that the last index has already ends the chain at once, unless forced."""
    version, _ = _hot_list(work)
    if not force and version and version == _json(work.path / "images-prev/index.json").get("currentVersion"):
        return 0
    steps = [fetch, lambda w: extract(w, decode), lambda w: make_variants(w, resize), package, *([lambda w: publish(w, True)] if release_it else [])]
    return next((code for step in steps if (code := step(work))), 0)
