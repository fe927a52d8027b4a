"""Validation gates. Each gives rows (gate, severity, subject, message); any error blocks a release."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import WRAPPED, record_count

SCHEMA = "gate string, severity string, subject string, message string"
PROBE_ROWS = 10_000  #: probes that are matched by substring in one pass
#: Fixed values of the release contract.
REQUIRED_EXCEL = ["character_table.json", "handbook_info_table.json", "charword_table.json", "story_review_table.json", "enemy_handbook_table.json", "stage_table.json", "zone_table.json", "item_table.json"]
REQUIRED_LEVELS = ["gamedata/levels/enemydata/enemy_database.json"]
REQUIRED_STORY = ["gamedata/excel/story_review_table.json", "storyinfo.json"]
TRACKED = ["character_table.json", "stage_table.json", "item_table.json", "enemy_handbook_table.json", "story_review_table.json"]
ROOTS = ["gamedata/excel", "gamedata/levels", "gamedata/story"]
DROP_RATIO = 0.05
LISTED = 10  #: files or ids that a gate names


def _rows(df: DataFrame, gate: str, subject: str, message: Column, severity: str = "error") -> DataFrame:
    return df.select(F.lit(gate).alias("gate"), F.lit(severity).alias("severity"), F.col(subject).cast("string").alias("subject"), message.alias("message"))


def missing(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Required keys that aren't there."""
    return required.join(present.select(key), key, "left_anti")


def strict_json(tree: DataFrame, path: str = "path", content: str = "content") -> DataFrame:
    """path, valid: whether a file is strict UTF-8 and JSON. Spark's own parsers accept trailing garbage, so this is Python's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for raw in batch["c"].to_pylist():
                try:
                    json.loads((raw or b"").decode("utf-8"))
                    ok.append(True)
                except (ValueError, RecursionError):
                    ok.append(False)
            yield pa.RecordBatch.from_arrays([batch["p"], pa.array(ok, pa.bool_())], ["p", "valid"])

    return tree.select(F.col(path).cast("string").alias("p"), F.col(content).cast("binary").alias("c")).mapInArrow(run, "p string, valid boolean").withColumnRenamed("p", path)


def extraction_problems(tree: DataFrame, server: str) -> DataFrame:
    """problem: what an extraction lacks to be merged."""
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    path = F.col("path")
    found = tree.agg(
        has(path.startswith(f"{server}/gamedata/")).alias("no gamedata directory"),
        has(path.rlike(f"^{server}/gamedata/excel/[^/]+\\.json$")).alias("no excel tables"),
        has(path.endswith("hot_update_list.json")).alias("no hot-update list"),
    )
    listed = F.array(*[F.when(~F.col(c), F.lit(c)) for c in found.columns])
    return found.select(F.explode(F.array_compact(listed)).alias("problem"))


def invalid_enum(records: DataFrame, key: str, value: str, prefixes: list[str]) -> DataFrame:
    """Records with a value that starts with none of the prefixes. Null is no value."""
    good = F.lit(False)
    for p in prefixes:
        good = good | F.col(value).startswith(p)
    return records.filter(F.col(value).isNotNull() & ~good).select(key, value)


def invalid_rarity(records: DataFrame) -> DataFrame:
    """``char_*`` records whose rarity isn't a string TIER_*. records: key, value (JSON text), pos."""
    kind = F.schema_of_variant(F.variant_get(F.try_parse_json("value"), "$.rarity", "variant"))
    text = F.get_json_object("value", "$.rarity")
    bad = kind.isNotNull() & (kind != "VOID") & ~((kind == "STRING") & text.startswith("TIER_"))
    return records.filter(F.col("key").startswith("char_") & F.col("value").startswith("{") & F.coalesce(bad, F.lit(False))).select("pos", "key")


def record_regression(baseline: DataFrame, candidate: DataFrame, key: str, n: str = "n", ratio: float = DROP_RATIO) -> DataFrame:
    """Tables that lost more than the ratio of their records; an equal share passes."""
    b = baseline.select(key, F.col(n).alias("baseline_n"))
    c = candidate.select(key, F.col(n).alias("candidate_n"))
    return c.join(b, key).filter((F.col("baseline_n") != 0) & (F.col("candidate_n") < F.col("baseline_n") * F.lit(1 - ratio))).select(key, "baseline_n", "candidate_n")


def accumulation(tree: DataFrame, root: str = "root", path: str = "path") -> DataFrame:
    """Files and directories below each root. path is relative to the root's parent; directories come from the paths."""
    parts = F.split(path, "/")
    entries = F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, 1, i), "/"))
    below = tree.filter(F.size(parts) > 1).select(root, F.explode(entries).alias("__entry"))
    return below.distinct().groupBy(root).agg(F.count("*").alias("entries"))


def shrunk(baseline: DataFrame, candidate: DataFrame, root: str = "root") -> DataFrame:
    """Roots with fewer entries than before; a root that is gone has none."""
    c = candidate.select(root, F.col("entries").alias("candidate_entries"))
    return baseline.join(c, root, "left").filter(F.coalesce("candidate_entries", F.lit(0)) < F.col("entries"))


def absent_probes(probes: DataFrame, present: DataFrame, probe: str, value: str) -> DataFrame:
    return probes.join(present.select(F.col(value).alias(probe)), probe, "left_anti")


def absent_substrings(probes: DataFrame, texts: DataFrame, probe: str, columns: list[str]) -> DataFrame:
    """Probes that no text contains. The probes are broadcast only if there are few; else they go in passes over the texts."""
    n = probes.count()
    passes = max(1, -(-n // PROBE_ROWS))
    hit = lambda: F.greatest(*[F.contains(F.col(c), F.col("__p")) for c in columns]) if len(columns) > 1 else F.contains(F.col(columns[0]), F.col("__p"))
    found = None
    for i in range(passes):
        part = probes.select(F.col(probe).alias("__p")) if passes == 1 else probes.filter(F.pmod(F.xxhash64(probe), F.lit(passes)) == i).select(F.col(probe).alias("__p"))
        some = texts.join(F.broadcast(part), hit()).select("__p").distinct()
        found = some if found is None else found.union(some)
    return probes.join(found.withColumnRenamed("__p", probe), probe, "left_anti")


def story_coverage(refs: DataFrame, texts: DataFrame, converted: DataFrame) -> DataFrame:
    """ref, status of references without a converted story: ``unconverted`` if a text matches in any case, else ``source_missing``. All take one column, ref."""
    lower = texts.select(F.lower("ref").alias("__low")).distinct()
    open_refs = refs.distinct().join(converted, "ref", "left_anti")
    return open_refs.join(lower, F.lower("ref") == F.col("__low"), "left").select("ref", F.when(F.col("__low").isNotNull(), "unconverted").otherwise("source_missing").alias("status"))


def table_counts(tables: DataFrame) -> DataFrame:
    """table, n of keyed JSON tables (table, content), the wrapped ones by what they wrap."""
    n = F.lit(None).cast("int")
    text = F.col("content").cast("string")
    for name in sorted(WRAPPED):
        n = F.when(F.col("table") == name, record_count(text, WRAPPED[name])).otherwise(n)
    return tables.select("table", F.when(F.col("table").isin(*WRAPPED), n).otherwise(record_count(text)).cast("long").alias("n"))


def validate(candidate: DataFrame, baseline: DataFrame | None, probes: dict[str, list[str]] | None = None, root: str = "zh_CN", ratio: float = DROP_RATIO) -> DataFrame:
    """All gates over trees (path, is_dir, size, sha256, content), as result rows. Nothing raises: a table that can't be read is an error row."""
    from .story import story_references

    spark = candidate.sparkSession
    inside = candidate.filter(F.col("path").startswith(f"{root}/"))
    if not inside.limit(1).count():
        return spark.createDataFrame([("root", "error", root, "missing root directory")], SCHEMA)
    excel = f"{root}/gamedata/excel/"
    rel = inside.withColumn("rel", F.substring("path", len(root) + 2, 1 << 30))
    required = spark.createDataFrame([(f"gamedata/excel/{f}",) for f in REQUIRED_EXCEL] + [(f,) for f in REQUIRED_LEVELS], "rel string")
    out = [_rows(missing(required, rel, "rel"), "contract", "rel", F.lit("required file is missing"))]
    json_files = inside.filter(F.col("path").endswith(".json") & ~F.col("is_dir"))
    checked = strict_json(json_files)
    broken = checked.filter("not valid")
    out.append(_rows(broken.orderBy("path").limit(LISTED), "json", "path", F.lit("not strict UTF-8 JSON")))
    total = broken.agg(F.count("*").cast("string").alias("n")).filter("n <> '0'")
    out.append(_rows(total, "json_total", "n", F.lit("invalid JSON files in all")))
    tables = inside.join(checked.filter("valid").select("path"), "path").filter(F.col("path").startswith(excel)).withColumn("table", F.substring("path", len(excel) + 1, 1 << 30))
    counts = table_counts(tables)
    scalar = counts.filter(F.col("n").isNull() & F.col("table").isin(*REQUIRED_EXCEL))
    out.append(_rows(scalar, "contract", "table", F.lit("unparseable excel file")))
    out.append(_rows(broken.filter(F.col("path").isin(*[excel + f for f in REQUIRED_EXCEL])), "contract", "path", F.lit("unparseable excel file")))
    from ..sources.tables import keyed_records

    records = keyed_records(tables.filter(F.col("table") == "character_table.json"))
    out.append(_rows(invalid_rarity(records).orderBy("pos").limit(LISTED), "rarity", "key", F.lit("invalid operator rarity")))
    if baseline is not None:
        before = baseline.filter(F.col("path").startswith(f"{root}/"))
        old = before.filter(F.col("path").startswith(excel)).withColumn("table", F.substring("path", len(excel) + 1, 1 << 30))
        lost = record_regression(table_counts(old.filter(F.col("table").isin(*TRACKED))), counts.filter(F.col("table").isin(*TRACKED)), "table", ratio=ratio)
        out.append(_rows(lost, "records", "table", F.concat(F.lit("record regression: "), F.col("baseline_n"), F.lit(" -> "), F.col("candidate_n"))))
        rooted = lambda t: t.withColumn("root", F.concat_ws("/", F.slice(F.split("path", "/"), 1, 3))).filter(F.col("root").isin(*[f"{root}/{r}" for r in ROOTS])).withColumn("path", F.substring("path", F.length("root") - F.length(F.element_at(F.split("root", "/"), -1)) + 1, F.lit(1 << 30)))
        less = shrunk(accumulation(rooted(before)), accumulation(rooted(inside)))
        out.append(_rows(less, "accumulation", "root", F.lit("fewer entries than the baseline")))
    probes = probes or {}
    if probes.get("operators"):
        names = records.select(F.get_json_object("value", "$.name").alias("name"))
        wanted = spark.createDataFrame([(p,) for p in probes["operators"]], "probe string")
        out.append(_rows(absent_probes(wanted, names, "probe", "name"), "probe", "probe", F.lit("operator probe is absent")))
    if probes.get("events"):
        wanted = spark.createDataFrame([(p,) for p in probes["events"]], "probe string")
        events = keyed_records(tables.filter(F.col("table") == "story_review_table.json")).select("key")
        stages = keyed_records(tables.filter(F.col("table") == "stage_table.json"), wrapper="stages").select("key")
        out.append(_rows(absent_probes(wanted, events, "probe", "key"), "probe", "probe", F.lit("event probe is absent")))
        out.append(_rows(absent_substrings(wanted, stages, "probe", ["key"]), "probe", "probe", F.lit("event probe has no stage")))
    story = f"{root}/gamedata/story/"
    files = inside.filter(F.col("path").startswith(story) & ~F.col("is_dir")).select(F.substring("path", len(story) + 1, 1 << 30).alias("f"))
    if files.limit(1).count():
        named = lambda suffix: files.filter(F.col("f").endswith(suffix)).select(F.expr(f"substring(f, 1, length(f) - {len(suffix)})").alias("ref"))
        open_refs = story_coverage(story_references(tables), named(".txt"), named(".json"))
        out.append(open_refs.select(F.lit("story").alias("gate"), F.when(F.col("status") == "unconverted", "error").otherwise("warning").alias("severity"), F.col("ref").alias("subject"), F.col("status").alias("message")))
    result = out[0]
    for o in out[1:]:
        result = result.unionByName(o)
    return result
