"""Story references, conversion of scripts, and what is derived from them."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

REVIEW = "map<string,struct<entryType:string,name:string,infoUnlockDatas:array<struct<storyCode:string,avgTag:string,storyName:string,storyInfo:string,storyTxt:string,storySort:int>>>>"
META = "struct<actArchiveResData:struct<avgs:map<string,struct<id:string,desc:string,breifPath:string,contentPath:string,rawBrief:string>>>>"
STORY = "struct<lang:string,eventid:string,storyInfo:string,storyList:array<struct<id:int,prop:string,attributes:map<string,string>>>>"


def chapters_of(tables: DataFrame) -> DataFrame:
    """Every chapter of every event: event_pos, event_id, event_name, pos and the chapter's fields. tables: table, content."""
    review = tables.filter(F.col("table") == "story_review_table.json").select(F.from_json(F.col("content").cast("string"), REVIEW).alias("m"))
    events = review.select(F.posexplode(F.map_entries("m")).alias("event_pos", "e"))
    name = F.coalesce(F.nullif(F.col("e.value.name"), F.lit("")), F.col("e.key"))
    rows = events.select("event_pos", F.col("e.key").alias("event_id"), name.alias("event_name"), F.posexplode_outer("e.value.infoUnlockDatas").alias("pos", "c"))
    return rows.select("event_pos", "event_id", "event_name", "pos", "c.*")


def story_references(tables: DataFrame) -> DataFrame:
    """ref of every story that the tables name, repeats included; empty ones are none."""
    archive = tables.filter(F.col("table") == "story_review_meta_table.json").select(F.from_json(F.col("content").cast("string"), META).alias("m"))
    avgs = archive.select(F.explode("m.actArchiveResData.avgs").alias("id", "a")).select(F.col("a.contentPath").alias("ref"))
    return chapters_of(tables).select(F.col("storyTxt").alias("ref")).union(avgs).filter("ref is not null and ref <> ''")


def archive_entries(tables: DataFrame) -> DataFrame:
    """pos, storyName, storyTxt of the archive's entries that have a text."""
    archive = tables.filter(F.col("table") == "story_review_meta_table.json").select(F.from_json(F.col("content").cast("string"), META).alias("m"))
    rows = archive.select(F.posexplode(F.map_entries("m.actArchiveResData.avgs")).alias("pos", "e"))
    return rows.select("pos", F.col("e.value.desc").alias("storyName"), F.col("e.value.contentPath").alias("storyTxt")).filter("storyTxt is not null and storyTxt <> ''")


def case_fixes(refs: DataFrame, texts: DataFrame) -> DataFrame:
    """expected, actual: references that no text has, with the first text (by name) that has it in another case."""
    index = texts.groupBy(F.lower("ref").alias("__low")).agg(F.min("ref").alias("actual"))
    wanted = refs.distinct().join(texts.select("ref"), "ref", "left_anti")
    return wanted.join(index, F.lower("ref") == F.col("__low")).filter("actual <> ref").select(F.col("ref").alias("expected"), "actual")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; each task hands on one row of a key."""
    w = Window.partitionBy(key).orderBy(F.desc(order))
    return rows.withColumn("__n", F.row_number().over(w)).filter("__n = 1").drop("__n")


def character_dictionary(records: DataFrame) -> DataFrame:
    """key, id, name from ``char_<id>_<key>...`` records (pos, key, value), the last in file order of each key."""
    parts = F.split("key", "_")
    rows = records.filter(F.col("key").startswith("char_") & (F.size(parts) >= 3)).select("pos", parts[2].alias("key"), parts[1].alias("id"), F.get_json_object("value", "$.name").alias("name"))
    return last_wins(rows, "key", "pos").select("key", "id", "name")


_NAMED = re.compile(r'^\[name="(?P<name>[^"]*)"[^\]]*\](?P<text>.*)$', re.S)
_PROP = re.compile(r"^\[(?P<prop>[A-Za-z][A-Za-z0-9_.]*)(?:\((?P<args>.*)\))?\](?P<text>.*)$", re.S)
_ARG = re.compile(r'\s*([A-Za-z0-9_]+)\s*=\s*(?:"([^"]*)"|([^,]*))\s*(?:,|$)')


def parse_script(text: str) -> list[dict]:
    """The lines of a script, by a minimal grammar: ``[name="X"]text``, ``[Prop(k=v, ...)]text``, and plain text."""
    out = []
    for line in text.splitlines():
        line = line.strip()
        if not line:
            continue
        if m := _NAMED.match(line):
            out.append({"prop": "name", "attributes": {"name": m["name"], "content": m["text"]}})
        elif m := _PROP.match(line):
            args = {k: a or b.strip() for k, a, b in _ARG.findall(m["args"] or "")}
            out.append({"prop": m["prop"], "attributes": args | ({"content": m["text"]} if m["text"] else {})})
        else:
            out.append({"prop": "", "attributes": {"content": line}})
    return [{"id": i, **x} for i, x in enumerate(out)]


def convert(scripts: DataFrame, lang: str = "zh_CN", parse: Callable[[str], list[dict]] = parse_script) -> DataFrame:
    """ref, story (JSON text), words (characters of content), error. scripts: ref, event_id, info, content. A script that ``parse`` fails on is a row with an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    lines = parse((r["content"] or b"").decode("utf-8"))
                    story = {"lang": lang, "eventid": r["event_id"], "storyInfo": r["info"] or "", "storyList": lines}
                    rows.append((r["ref"], json.dumps(story, ensure_ascii=False), sum(len(x["attributes"].get("content", "")) for x in lines), None))
                except Exception as e:  # noqa: BLE001  the parser is anyone's
                    rows.append((r["ref"], None, None, f"{type(e).__name__}: {e}"))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.string()))], ["ref", "story", "words", "error"])

    return scripts.select("ref", "event_id", "info", F.col("content").cast("binary").alias("content")).mapInArrow(run, "ref string, story string, words long, error string")


def pending_conversions(refs: DataFrame, converted: DataFrame, texts: DataFrame) -> DataFrame:
    """ref, missing_source: references without a story yet. A script that changed under a kept story isn't converted again."""
    todo = refs.select("ref").distinct().join(converted.select("ref"), "ref", "left_anti")
    return todo.join(texts.select("ref", F.lit(True).alias("__there")).distinct(), "ref", "left").select("ref", F.col("__there").isNull().alias("missing_source"))


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both; the new one where both have a key."""
    return old.join(new.select(*key), key, "left_anti").unionByName(new)


def word_counts(chapters: DataFrame, converted: DataFrame) -> DataFrame:
    """event_id, story_key, words: a row for every event, even one without a converted story (its key is null)."""
    events = chapters.select("event_id").distinct()
    done = chapters.join(converted.filter("error is null").select(F.col("ref").alias("storyTxt"), "words"), "storyTxt").select("event_id", F.col("storyTxt").alias("story_key"), "words")
    return events.join(done, "event_id", "left")


def extra_stories(archive: DataFrame, converted: DataFrame) -> DataFrame:
    """Archive entries (storyName, storyTxt) whose story exists."""
    return archive.join(converted.select(F.col("ref").alias("storyTxt")), "storyTxt", "left_semi")
