"""Dialogue texts of stories and the incremental plan of their summaries."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_rich_text
from .story import STORY

#: Fixed values of the dialogue form.
NOBODY, OPTION, COLON = "？？？", "【选项】", "："
NO_DIALOGUE = "（无对话内容）"
SHORT = 800  #: characters of an event of one part, which needs no model
MAX_CONCURRENT = 8


def dialogue(story: Column) -> Column:
    """The dialogue of a story (JSON text), a line for each spoken line, caption and option that isn't empty before it is cleaned."""
    items = F.from_json(story, STORY)["storyList"]

    def lines(item: Column) -> Column:
        a, prop = item["attributes"], F.lower(item["prop"])
        content = F.coalesce(a["content"], F.lit(""))
        who = F.coalesce(clean_rich_text(F.nullif(a["name"], F.lit(""))), F.lit(NOBODY))
        caption = F.coalesce(F.nullif(a["content"], F.lit("")), a["text"], F.lit(""))
        options = F.coalesce(F.from_json(a["options"], "array<string>"), F.array().cast("array<string>"))
        texts = F.transform(options, lambda o: F.when(o.startswith("{"), F.coalesce(F.get_json_object(o, "$.text"), F.lit(""))).otherwise(o))
        none = F.array().cast("array<string>")
        return (
            F.when(prop == "name", F.when(content != "", F.array(F.concat(who, F.lit(COLON), clean_rich_text(content)))).otherwise(none))
            .when(prop.isin("sticker", "subtitle", "animtext"), F.when(caption != "", F.array(F.concat(F.lit("*"), clean_rich_text(caption), F.lit("*")))).otherwise(none))
            .when(prop == "decision", F.transform(F.filter(texts, lambda x: x != ""), lambda x: F.concat(F.lit(OPTION), clean_rich_text(x))))
            .otherwise(none)
        )

    return F.array_join(F.flatten(F.transform(items, lines)), "\n")


def chapter_order(chapters: DataFrame, stories: DataFrame) -> DataFrame:
    """Chapters that have a story, with ``ord``, their order in the event: by storySort (0 if none), then as listed."""
    kept = chapters.join(stories.select(F.col("ref").alias("storyTxt")), "storyTxt", "left_semi")
    return kept.withColumn("ord", F.struct(F.coalesce("storySort", F.lit(0)).alias("sort"), F.col("pos").alias("pos")))


def pending(chapters: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    """Chapters without a cached summary."""
    return chapters.join(cache.select(key), key, "left_anti")


def pruned(cache: DataFrame, chapters: DataFrame, key: str) -> DataFrame:
    """Cached chapter summaries that still have their chapter. Summaries of events are never pruned."""
    return cache.join(chapters.select(key), key, "left_semi")


def dirty_events(chapters: DataFrame, cache: DataFrame, event_cache: DataFrame, event: str, key: str) -> DataFrame:
    """Events with a pending chapter or no summary: event, pending_chapters, missing_event_summary."""
    done = cache.select(key, F.lit(True).alias("__done")).distinct()
    have = event_cache.select(event, F.lit(True).alias("__have")).distinct()
    counted = chapters.join(done, key, "left").groupBy(event).agg(F.count_if(F.col("__done").isNull()).alias("pending_chapters"))
    out = counted.join(have, event, "left").select(event, "pending_chapters", F.col("__have").isNull().cast("int").alias("missing_event_summary"))
    return out.filter((F.col("pending_chapters") > 0) | (F.col("missing_event_summary") == 1))


def ordered_text(rows: DataFrame, group: str, order: Column, text: Column, separator: str = "\n") -> DataFrame:
    """The texts of each group in order, joined. A group is one row of the result, so its texts fit a row."""
    return rows.groupBy(group).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order.alias("o"), text.alias("t")))), lambda x: x["t"]), separator).alias("text"))


def event_texts(parts: DataFrame) -> DataFrame:
    """event_id, parts, text: the input of an event's summary. parts: event_id, ord, code, tag, name, text. One part alone is its own text, cut to SHORT."""
    some = parts.filter("text is not null and text <> ''")
    tag = F.when(F.coalesce("tag", F.lit("")) != "", F.concat(F.lit(" ["), F.col("tag"), F.lit("]"))).otherwise("")
    head = F.concat(F.lit("--- "), F.coalesce("code", F.lit("")), tag, F.lit(" "), F.coalesce("name", F.lit("")), F.lit(" ---\n"), F.col("text"))
    grouped = some.groupBy("event_id").agg(F.count("*").alias("parts"), F.array_sort(F.collect_list(F.struct(F.col("ord"), head.alias("part"), F.col("text").alias("body")))).alias("p"))
    joined = F.array_join(F.transform("p", lambda x: x["part"]), "\n\n")
    return grouped.select("event_id", "parts", F.when(F.col("parts") <= 1, F.substring(F.col("p")[0]["body"], 1, SHORT)).otherwise(joined).alias("text"))


def chapter_prompt(event: Column, code: Column, name: Column, tag: Column, text: Column) -> Column:
    """What a model is asked about a chapter; a chapter without dialogue asks nothing."""
    head = F.concat(F.lit("Event: "), event, F.lit("\nChapter: "), F.concat_ws(" ", F.nullif(code, F.lit("")), name), F.lit("\nPart: "), F.coalesce(F.nullif(tag, F.lit("")), F.lit("-")))
    return F.when(F.trim(text) != "", F.concat(F.lit("Summarise this chapter in its own language.\n"), head, F.lit("\n\n"), text))


def event_prompt(event: Column, text: Column) -> Column:
    """What a model is asked about an event, from the texts of its chapters."""
    return F.concat(F.lit("Summarise this event in its own language.\nEvent: "), event, F.lit("\n\n"), text)


def extractive(text: str) -> str:
    """The summariser without a model: the first lines, up to SHORT characters."""
    out = ""
    for line in text.splitlines():
        if out and len(out) + len(line) + 1 > SHORT:
            break
        out += ("\n" if out else "") + line
    return out[:SHORT]


def summarize(rows: DataFrame, key: str, text: str, model: Callable[[str], str] = extractive, attempts: int = 4, wait: float = 0.0) -> DataFrame:
    """key, summary, error. A failure is retried after ``wait`` seconds, twice as many each time, then a row of its own; at most MAX_CONCURRENT tasks call the model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, errors = [], []
            for t in batch["t"].to_pylist():
                result = error = None
                if not (t or "").strip():
                    result = NO_DIALOGUE
                for attempt in range(attempts if result is None else 0):
                    try:
                        result, error = model(t), None
                        break
                    except Exception as e:  # noqa: BLE001  the model is anyone's
                        error = f"{type(e).__name__}: {e}"
                        if attempt < attempts - 1:
                            time.sleep(wait * 2**attempt)
                out.append(result)
                errors.append(error)
            yield pa.RecordBatch.from_arrays([batch["k"], pa.array(out, pa.string()), pa.array(errors, pa.string())], ["k", "summary", "error"])

    slim = rows.select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).repartition(MAX_CONCURRENT)
    return slim.mapInArrow(run, "k string, summary string, error string").withColumnRenamed("k", key)


def sparse_object(*counts: str) -> Column:
    """A JSON text of counts, without zeros."""
    return F.to_json(F.struct(*[F.nullif(F.col(c), F.lit(0)).alias(c) for c in counts]), {"ignoreNullFields": "true"})


def sparse_stats(stats: DataFrame) -> DataFrame:
    """One JSON text without zero counts."""
    return stats.select(sparse_object(*stats.columns).alias("stats"))
