"""Release polling as a stream: each new hot-update list in a folder is a row, and a run follows only a change.

A file source with ``availableNow`` handles what has arrived since the last run and stops, as a scheduled job does; the
checkpoint remembers which lists were seen, so none is handled twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.release import version_changed

LIST = "struct<versionId:string,manifestVersion:string,abInfos:array<struct<name:string,hash:string>>>"


def version_stream(spark: SparkSession, folder: str) -> DataFrame:
    """versionId, bundles, seen (the file's time) of every list that lands in the folder."""
    raw = spark.readStream.format("text").option("wholetext", "true").load(folder)
    j = F.from_json("value", LIST)
    return raw.select(j.alias("j"), F.col("_metadata.file_modification_time").alias("seen")).select("j.versionId", F.coalesce(F.size("j.abInfos"), F.lit(0)).alias("bundles"), "seen").filter("versionId is not null")


def poll(spark: SparkSession, folder: str, checkpoint: str, published: Callable[[], str | None], run: Callable[[str], None], force: bool = False) -> list[str]:
    """Handle the lists that are new since the last poll; returns the versions that were run."""
    done: list[str] = []

    def handle(batch: DataFrame, _: int) -> None:
        newest = batch.orderBy(F.desc("seen"), F.desc("versionId")).limit(1)
        for row in newest.select("versionId", version_changed(F.col("versionId"), F.lit(published()), force).alias("go")).collect():
            if row["go"]:
                run(row["versionId"])
                done.append(row["versionId"])

    query = version_stream(spark, folder).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(handle).start()
    query.awaitTermination()
    return done


def event_counts(events: DataFrame, time: str = "ts", kind: str = "event_type", window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events per window and kind, of a stream or a table; a stream drops what comes later than ``late``."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, window).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
