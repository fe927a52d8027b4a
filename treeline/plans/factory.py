"""The data and artwork pipelines as chains of steps over a working directory.

Each step reads what the one before left, writes its own record beside it, and returns an exit code: 0 goes on, 1
stops the chain. Trees and indexes are DataFrames; records are small JSON files.
"""

from __future__ import annotations

import json
import shutil
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ..functions.text import is_art_bundle
from ..operators import art, delta, digest, gates, overlay, release, state, story
from ..sources import archives, tables, tree
from ..sources.attempts import retried
from ..sources.registry import Registry
from ..sources.settings import tool_versions
from .workers import importable

ROOT, CONTRACT = "zh_CN", "treeline-data/v1"
#: Files at the root that go with the stories.
INDEX_FILES = ["extrastory.json", "chardict.json", "wordcount.json", "storyinfo.json", "summaries.json", "event_summaries.json"]


@dataclass
class Work:
    """A working directory: baseline/, extract/, candidate/, dist/, images/, registry/ and the records."""

    spark: SparkSession
    path: Path
    server: str = "cn"
    probes: dict[str, list[str]] = field(default_factory=dict)
    excel: Path | None = None  #: the tables of the artwork steps, where they aren't the candidate's
    parse: Callable[[str], list[dict]] = story.parse_script
    tools: list[str] = field(default_factory=list)  #: packages or programs whose versions belong to a release
    held: list[DataFrame] = field(default_factory=list)

    def __post_init__(self) -> None:
        importable(self.spark)
        self.path = Path(self.path)

    def record(self, name: str) -> dict:
        file = self.path / f"{name}.json"
        return json.loads(file.read_text("utf-8")) if file.exists() else {}

    def keep(self, name: str, value: dict) -> None:
        """Write a step's record; the trees that it read are let go."""
        archives.write_json(self.path / f"{name}.json", value)
        while self.held:
            self.held.pop().unpersist()

    def tree(self, name: str) -> DataFrame:
        """A directory below as it is now; its files are read once, however often the step uses it."""
        self.held.append(tree.scan(self.spark, str(self.path / name)).persist(StorageLevel.DISK_ONLY))
        return self.held[-1]


def write_tree(files: DataFrame, target: Path) -> None:
    """Put a tree on a file system that all executors share, from them; any store that pyarrow knows will do. A repeated task leaves one whole file."""
    root = str(target)

    def put(batches):
        store, top = tree.store_of(root)
        for batch in batches:
            for row in batch.to_pylist():
                file = f"{top.rstrip('/')}/{row['path']}"
                if row["is_dir"]:
                    store.create_dir(file, recursive=True)
                    continue
                folder, _, name = file.rpartition("/")
                store.create_dir(folder, recursive=True)
                part = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with store.open_output_stream(part, compression=None) as out:
                    out.write(row["content"] or b"")
                store.move(part, file)
            yield batch.select(["path"])

    files.select("path", "is_dir", "content").mapInArrow(put, "path string").count()


def loaded_probes(work: Work, config: Path | None = None, more: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """A config file, overridden key by key by the directory's own, with given values appended."""
    out: dict[str, list[str]] = {}
    for file in (config, work.path / "probes.json"):
        if file and Path(file).exists():
            out |= json.loads(Path(file).read_text("utf-8"))
    for k, v in (more or {}).items():
        out[k] = [*out.get(k, []), *v]
    return out


def check(work: Work) -> tuple[dict, bool]:
    """The extraction's version, and whether it differs from the latest complete release."""
    lists = work.tree("extract").filter(F.col("path").endswith("hot_update_list.json")).orderBy("path").limit(1)
    found = release.bundle_count(lists.select(F.col("content").cast("string").alias("content"))).first()
    remote = found.asDict() if found else {}
    done = release.complete(Registry(work.path / "registry").releases(work.spark)).orderBy(F.desc("created")).limit(1)
    tags = done.select(F.regexp_extract("tag", r"(?:data|upstream|gamedata)-(.+?)(?:-v\d+)?$", 1).alias("v")).collect()
    return remote, remote.get("versionId") != (tags[0]["v"] if tags else None)


def fetch(work: Work, extractor: Callable[[Path], object] | None = None, attempts: int = 5, wait: float = 30.0) -> int:
    """Look over the landed extraction. Downloading it is not of this engine; an ``extractor`` that is given fills the directory first, in some attempts."""
    if extractor:
        retried(lambda: extractor(work.path / "extract"), attempts, wait, Exception)
    problems = [r["problem"] for r in gates.extraction_problems(work.tree("extract"), work.server).collect()]
    work.keep("fetch", {"problems": problems})
    return 1 if problems else 0


def fetch_baseline(work: Work, clobber: bool = False) -> int:
    """Unpack the latest complete release as the baseline, after its digests are verified. One that is there stays: it has all
    files of the contract, or as many files as the verified release that it was unpacked from."""
    target = work.path / "baseline"
    required = [*(f"gamedata/excel/{f}" for f in gates.REQUIRED_EXCEL), *gates.REQUIRED_LEVELS, *gates.REQUIRED_STORY]
    count = lambda: sum(f.is_file() for f in target.rglob("*"))
    if not clobber and (all((target / ROOT / f).is_file() for f in required) or 0 < count() == work.record("baseline").get("files")):
        return 0
    registry = Registry(work.path / "registry")
    found = release.complete(registry.releases(work.spark)).orderBy(F.desc("created")).limit(1).collect()
    if not found:
        return 0
    tag, names = found[0]["tag"], release.REQUIRED_ASSETS[:3]
    contents = {n: (registry.root / tag / n).read_bytes() for n in names}
    manifest = registry.root / tag / release.REQUIRED_ASSETS[3]
    release.verify_manifest(json.loads(manifest.read_text("utf-8")), tag, CONTRACT, contents)
    packed = work.spark.createDataFrame([(i, bytearray(contents[n])) for i, n in enumerate(names)], "ord int, content binary")
    staged = work.path / ".baseline"
    shutil.rmtree(staged, ignore_errors=True)
    staged.mkdir(parents=True)
    write_tree(archives.read_archives(packed).withColumn("is_dir", F.lit(False)), staged)
    archives.activate(staged, target)
    work.keep("baseline", {"tag": tag, "files": count()})
    return 0


def provenance(tools: list[str]) -> dict:
    """The versions that made a release."""
    import platform
    import subprocess

    import pyspark

    def git(*args: str) -> str | None:
        try:
            return subprocess.run(["git", "-C", str(Path(__file__).parent), *args], capture_output=True, text=True, check=True).stdout.strip()
        except (OSError, subprocess.CalledProcessError):
            return None

    return {"python": platform.python_version(), "spark": pyspark.__version__, "pyarrow": pa.__version__, "commit": git("rev-parse", "HEAD"), "dirty": bool(git("status", "--porcelain")), "tools": tool_versions(tools, tools)}


def merge(work: Work) -> int:
    """Normalize the extraction, lay it over the baseline, write the candidate."""
    fresh = overlay.normalize_layout(work.tree("extract"), work.server, ROOT)
    base = work.tree("baseline")
    slim = lambda t: t.filter("not is_dir").select("path", "size", "sha256")  # noqa: E731  contents stay out of the join
    merged = overlay.overlay(slim(base), slim(fresh), size="size").cache()
    stats = overlay.merge_stats(merged).first().asDict()
    for name in (overlay.ADDED, overlay.CHANGED):
        stats[f"{name}_paths"] = [r["path"] for r in overlay.first_paths(merged).filter(F.col("status") == name).orderBy("path").collect()]
    content = lambda t: t.filter("not is_dir").select("path", "content")
    new = content(fresh).join(merged.filter("status <> 'kept'").select("path"), "path", "left_semi")
    kept = content(base).join(merged.filter("status = 'kept'").select("path"), "path", "left_semi")
    shutil.rmtree(work.path / "candidate", ignore_errors=True)
    write_tree(new.union(kept).withColumn("is_dir", F.lit(False)), work.path / "candidate")
    source = tables.hot_update(work.tree("extract")).select("versionId", "manifestVersion").first()
    work.keep("merge", {"source": source.asDict() if source else {}, "policy": overlay.POLICY, "stats": stats})
    merged.unpersist()
    return 0


def _tables(candidate: DataFrame) -> DataFrame:
    excel = f"{ROOT}/gamedata/excel/"
    return candidate.filter(F.col("path").startswith(excel) & ~F.col("is_dir")).select(F.substring("path", len(excel) + 1, 1 << 30).alias("table"), "content")


def convert_stories(work: Work) -> int:
    """Repair cases, convert stories that have none yet, and rebuild what is derived."""
    candidate, prefix = work.tree("candidate"), f"{ROOT}/gamedata/story/"
    named = lambda suffix: candidate.filter(F.col("path").startswith(prefix) & F.col("path").endswith(suffix) & ~F.col("is_dir")).select(F.expr(f"substring(path, {len(prefix) + 1}, length(path) - {len(prefix) + len(suffix)})").alias("ref"), "content")
    source = _tables(candidate)
    refs = story.story_references(source).select("ref").distinct()
    texts, done = named(".txt"), named(".json")
    fixes = story.case_fixes(refs, texts.select("ref"))
    fixed = texts.join(fixes, F.col("ref") == F.col("actual"), "left").select(F.coalesce("expected", "ref").alias("ref"), "content")
    todo = story.pending_conversions(refs, done, fixed)
    chapters = story.chapters_of(source).filter("storyTxt is not null")
    events = chapters.groupBy(F.col("storyTxt").alias("ref")).agg(F.min("event_id").alias("event_id"), F.min_by("storyInfo", "event_id").alias("info"))
    scripts = todo.filter("not missing_source").select("ref").join(fixed, "ref").join(events, "ref", "left")
    converted = story.convert(scripts, parse=work.parse).cache()
    bodies = converted.filter("error is null").select(F.concat(F.lit(prefix), F.col("ref"), F.lit(".json")).alias("path"), F.lit(False).alias("is_dir"), F.col("story").cast("binary").alias("content"))
    write_tree(bodies, work.path / "candidate")
    counts = {}
    for r in story.word_counts(chapters, converted).orderBy("event_id", "story_key").toLocalIterator():
        counts.setdefault(r["event_id"], {})
        if r["story_key"]:
            counts[r["event_id"]][r["story_key"]] = r["words"]
    out = work.path / "candidate" / ROOT
    old = json.loads((out / "wordcount.json").read_text("utf-8")) if (out / "wordcount.json").exists() else {}
    for event, words in counts.items():
        old.setdefault(event, {}).update(words)
    archives.write_json(out / "wordcount.json", old)
    infos = json.loads((out / "storyinfo.json").read_text("utf-8")) if (out / "storyinfo.json").exists() else {}
    infos |= {r["ref"]: r["info"] or "" for r in converted.filter("error is null").select("ref", F.get_json_object("story", "$.storyInfo").alias("info")).toLocalIterator()}
    archives.write_json(out / "storyinfo.json", infos)
    ready = done.select("ref").union(converted.filter("error is null").select("ref")).distinct()
    extra = story.extra_stories(story.archive_entries(source), ready).orderBy("pos")
    archives.write_json(out / "extrastory.json", {"extra": [{"storyName": r["storyName"], "storyTxt": r["storyTxt"]} for r in extra.toLocalIterator()]})
    people = story.character_dictionary(tables.keyed_records(source.filter("table = 'character_table.json'")))
    archives.write_json(out / "chardict.json", {r["key"]: {"name": r["name"], "id": r["id"]} for r in people.orderBy("key").toLocalIterator()})
    stats = {
        "converted": converted.filter("error is null").count(),
        "failed": [r.asDict() for r in converted.filter("error is not null").select("ref", "error").orderBy("ref").toLocalIterator()],
        "missing_source": todo.filter("missing_source").count(),
        "case_fixes": [r.asDict() for r in fixes.orderBy("expected").toLocalIterator()],
    }
    work.keep("story", stats)
    converted.unpersist()
    return 1 if stats["failed"] else 0


def summarize(work: Work, model: Callable[[str], str] = digest.extractive) -> int:
    """Summaries of new chapters, then of the events that they touch."""
    candidate, prefix = work.tree("candidate"), f"{ROOT}/gamedata/story/"
    stories = candidate.filter(F.col("path").startswith(prefix) & F.col("path").endswith(".json") & F.col("path").contains("/") & ~F.col("is_dir")).select(F.expr(f"substring(path, {len(prefix) + 1}, length(path) - {len(prefix) + 5})").alias("ref"), F.col("content").cast("string").alias("story"))
    chapters = digest.chapter_order(story.chapters_of(_tables(candidate)), stories)
    if not chapters.limit(1).count():
        return 0
    spark, folder = work.spark, work.path / "candidate" / ROOT
    read = lambda name: json.loads((folder / name).read_text("utf-8")) if (folder / name).exists() else {}
    caches = [spark.createDataFrame(list(read(f"{n}.json").items()), f"{k} string, summary string") for n, k in (("summaries", "storyTxt"), ("event_summaries", "event_id"))]
    todo = digest.pending(chapters, caches[0], "storyTxt").select("storyTxt").distinct()
    texts = todo.join(stories.withColumnRenamed("ref", "storyTxt"), "storyTxt").select("storyTxt", digest.dialogue(F.col("story")).alias("t"))
    new = digest.summarize(texts, "storyTxt", "t", model).cache()
    dirty = digest.dirty_events(chapters, caches[0], caches[1], "event_id", "storyTxt").select("event_id")
    parts = chapters.join(dirty, "event_id", "left_semi").join(stories.withColumnRenamed("ref", "storyTxt"), "storyTxt")
    parts = parts.select("event_id", "ord", F.coalesce("storyCode", F.lit("")).alias("code"), F.coalesce("avgTag", F.lit("")).alias("tag"), F.coalesce("storyName", F.lit("")).alias("name"), digest.dialogue(F.col("story")).alias("text"))
    inputs = digest.event_texts(parts).cache()
    short = inputs.filter("parts <= 1").select("event_id", F.col("text").alias("summary"), F.lit(None).cast("string").alias("error"))
    events = short.unionByName(digest.summarize(inputs.filter("parts > 1"), "event_id", "text", model))
    kept = digest.pruned(caches[0], chapters, "storyTxt")
    merged = lambda old, rows, key: dict(sorted({**{r[key]: r["summary"] for r in old.toLocalIterator()}, **{r[key]: r["summary"] for r in rows.filter("error is null").toLocalIterator()}}.items()))
    archives.write_json(folder / "summaries.json", merged(kept, new, "storyTxt"))
    archives.write_json(folder / "event_summaries.json", merged(caches[1], events, "event_id"))
    lost = new.filter("error is not null").select(F.col("storyTxt").alias("key"), "error").union(events.filter("error is not null").select("event_id", "error"))
    failed = [r.asDict() for r in lost.orderBy("key").toLocalIterator()]
    work.keep("summarize", {k: v for k, v in {"generated": new.filter("error is null").count(), "reused": kept.count(), "failed_details": failed}.items() if v})
    new.unpersist()
    inputs.unpersist()
    return 1 if failed else 0


def validate(work: Work) -> int:
    """All gates; the record holds every row, and the records of each table."""
    candidate = work.tree("candidate")
    results = gates.validate(candidate, work.tree("baseline") if (work.path / "baseline").exists() else None, work.probes)
    rows = [r.asDict() for r in results.orderBy("gate", "severity", "subject").toLocalIterator()]
    errors = [r for r in rows if r["severity"] == "error"]
    counts = {r["table"]: r["n"] for r in gates.table_counts(_tables(candidate).filter(F.col("table").isin(*gates.REQUIRED_EXCEL))).collect()}
    work.keep("validation", {"ok": not errors, "errors": errors, "warnings": [r for r in rows if r["severity"] != "error"], "recordCounts": dict(sorted(counts.items()))})
    return 1 if errors else 0


def package(work: Work) -> int:
    """Three archives and the manifest, from the candidate and the records of the steps."""
    files = work.tree("candidate").filter("not is_dir")
    part = lambda name: files.filter(F.col("path").startswith(f"{ROOT}/gamedata/{name}/"))
    dist = work.path / "dist"
    assets = [
        archives.write_archive(part("excel"), dist / release.REQUIRED_ASSETS[0]),
        archives.write_archive(part("levels"), dist / release.REQUIRED_ASSETS[1]),
        archives.write_archive(part("excel").union(part("story").filter(F.col("path").endswith(".json"))).union(files.filter(F.col("path").isin(*[f"{ROOT}/{n}" for n in INDEX_FILES]))), dist / release.REQUIRED_ASSETS[2]),
    ]
    manifest = {"contractVersion": CONTRACT, "source": work.record("merge").get("source", {}), "pipeline": provenance(work.tools), **{n: work.record(n) for n in ("merge", "story", "summarize", "validation")}, "assets": {a["name"]: {"size": a["size"], "sha256": a["sha256"]} for a in assets}}
    archives.write_json(dist / "manifest.json", manifest)
    return 0


def publish(work: Work, execute: bool = False) -> int:
    version = work.record("merge").get("source", {}).get("versionId") or "manual"
    files = [work.path / "dist" / n for n in release.REQUIRED_ASSETS]
    Registry(work.path / "registry").publish(work.spark, f"data-{version}", files, execute)
    return 0


def run(work: Work, force: bool = False, release_it: bool = False, extractor: Callable[[Path], object] | None = None, attempts: int = 5) -> int:
    """The data chain. An unchanged version ends it at once, with success; an extractor runs before that is known."""
    if extractor and (code := fetch(work, extractor, attempts)):
        return code
    _, changed = check(work)
    if not (changed or force):
        return 0
    steps: list[Callable[[Work], int]] = [fetch_baseline, *([] if extractor else [fetch]), merge, convert_stories, summarize, validate, package]
    for step in [*steps, *([lambda w: publish(w, True)] if release_it else [])]:
        if code := step(work):
            return code
    return 0


# --- artwork -------------------------------------------------------------------------------------------------------------


def images_plan(hot_update: DataFrame, saved: DataFrame, old: dict | None, valid: DataFrame, index_version: str | None) -> dict[str, DataFrame | bool]:
    """What to fetch. hot_update and saved: bundle, hash; old: a checked state."""
    spark = valid.sparkSession
    hot_update = hot_update.filter(is_art_bundle(F.col("bundle")))
    actions = state.bundle_actions(hot_update, saved)
    changed = actions.filter("action = 'download'").select("bundle")
    incremental = state.matches_index(old, index_version) and bool(valid.limit(1).count())
    required = spark.createDataFrame([], "bundle string")
    new = valid
    if incremental and old:
        pairs = spark.createDataFrame([(b, s) for b, ids in old["bundleCandidates"].items() for s in ids], "bundle string, skin_id string")
        new = valid.join(spark.createDataFrame([(s,) for s in old["validSkinIds"]], "skin_id string"), "skin_id", "left_anti")
        required = state.forced(state.bundles_for(pairs, new), changed, hot_update)
    return {"incremental": incremental, "downloads": changed.union(required).distinct(), "removed": state.removed(saved, hot_update), "new_skins": new}


def images_package(index: DataFrame, previous: DataFrame | None, version: str, files: DataFrame, dist: Path) -> dict:
    """Since-versions, the difference to the previous index, and the archives: all shards first, then a delta. files: file, content."""
    current = delta.since_version(index, previous, version)
    changes = delta.delta(*(x if x is None else x.select("skin_id", *[F.col(f"{t}.sha256").alias(t) for t in delta.TIERS]) for x in (current, previous))).cache()
    made = []
    if previous is None:
        for shard in ("chararts", "skinpack"):
            for tier in delta.TIERS:
                own = current.filter(F.col("shard") == shard).select(F.concat("skin_id", F.lit(f".{tier}.png")).alias("file"))
                lost = own.join(files.select("file"), "file", "left_anti").limit(3).collect()
                if lost:
                    raise FileNotFoundError(", ".join(r["file"] for r in lost))
                if own.limit(1).count():
                    made.append(archives.write_archive(files.join(own, "file", "left_semi").withColumnRenamed("file", "path"), dist / f"{shard}-{tier}.zip"))
    wanted = delta.delta_files(current, changes if previous is not None else changes.limit(0), files)
    part = files.join(wanted.filter("found").select("file"), "file", "left_semi").withColumnRenamed("file", "path")
    made.append(archives.write_archive(part, dist / f"images-delta-{version}.zip"))
    count = {r["change"]: r["count"] for r in changes.groupBy("change").count().collect()}
    result = {"mode": "baseline" if previous is None else "delta", "version": version, **{k: count.get(k, 0) for k in ("added", "changed", "removed")}, "empty": previous is not None and delta.is_empty(changes), "skipped": wanted.filter("not found").count(), "assets": made}
    changes.unpersist()
    return result


def images_index(files: DataFrame, valid: DataFrame) -> DataFrame:
    """The index of all three tiers, from the PNG files."""
    out = art.index(files, valid)
    for tier in delta.TIERS[1:]:
        suffix = f".{tier}.png"
        own = art.measured(files.filter(F.col("file").endswith(suffix))).select(F.expr(f"substring(file, 1, length(file) - {len(suffix)})").alias("skin_id"), F.struct("file", "w", "h", "bytes", "sha256").alias(tier))
        out = out.join(own, "skin_id", "left")
    return out
