"""Keyed JSON tables: one object whose keys are record ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keyed_records(tables: DataFrame, wrapper: str | None = None, content: str = "content") -> DataFrame:
    """pos, key, value (JSON text) of every record, in file order. A key that repeats keeps its last value and place."""
    text = F.col(content).cast("string")
    if wrapper:
        text = F.coalesce(F.get_json_object(text, f"$.{wrapper}"), text)
    rows = tables.select(F.posexplode(F.map_entries(F.from_json(text, "map<string,string>"))).alias("pos", "e")).select("pos", F.col("e.key").alias("key"), F.col("e.value").alias("value"))
    last = Window.partitionBy("key").orderBy(F.desc("pos"))
    return rows.withColumn("__n", F.row_number().over(last)).filter("__n = 1").drop("__n")


def default_content(tree: DataFrame, paths: list[str], default: str = "{}") -> DataFrame:
    """path, content of the named files, with a default where one isn't there."""
    wanted = tree.sparkSession.createDataFrame([(p,) for p in paths], "path string")
    return wanted.join(tree.select("path", "content"), "path", "left").select("path", F.coalesce(F.col("content").cast("string"), F.lit(default)).alias("content"))


def hot_update(tree: DataFrame) -> DataFrame:
    """The fields of the first (by path) hot-update list that can be read; no row if there is none."""
    schema = "struct<versionId:string,manifestVersion:string,abInfos:array<struct<name:string,hash:string>>>"
    lists = tree.filter(F.col("path").endswith("hot_update_list.json")).select("path", F.from_json(F.col("content").cast("string"), schema).alias("j"))
    return lists.filter("j.versionId is not null or j.abInfos is not null").orderBy("path").limit(1).select("j.*")
