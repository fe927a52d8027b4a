"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared_store import written

HUB = 256  #: rows of a key that may always be in one task
HUBS = 10_000  #: keys with more than HUB rows and more than a HUBS-th of all are broadcast: fewer than HUBS


def joined(rows: DataFrame, each: DataFrame, key: str, total: int) -> DataFrame:
    """The rows and the columns of ``each``, which has one row a key and in ``n`` at least the number of its rows among ``rows``.

    ``total`` is the sum of ``n``, or more. The keys of many rows are broadcast and theirs stay where they are, so no key lands in one task.
    """
    most = max(HUB, total // HUBS)
    hubs = each.filter(F.col("n") > most)
    others = rows.join(F.broadcast(hubs.select(key)), key, "left_anti").join(each.filter(F.col("n") <= most), key)
    return others.unionByName(rows.join(F.broadcast(hubs), key))


def _with_least(edges: DataFrame, total: int) -> tuple[DataFrame, DataFrame]:
    """The edges (u, v) with the least m of u and its neighbours; and u, m, n for each node."""
    low = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"), F.count("*").alias("n"))
    return joined(edges, low, "u", total), low


def components(edges: DataFrame) -> DataFrame:
    """node, component (the least node of each), from rows (u, v) of longs. Nodes without an edge have no row.

    Each round writes the edges to the shared folder. Nodes with many neighbours get theirs by broadcast, of a bounded
    number of them. Rounds grow with the logarithm of the longest path.
    """
    held = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        now = held.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if now == mark or not now["n"]:
            return held.select(F.col("u").alias("node"), F.col("v").alias("component")).union(held.select("v", "v").distinct())
        mark, total = now, 2 * now["n"]
        both = held.union(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, total)[0].filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down, low = _with_least(large.filter("u <> v"), total)
        small = down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        held = written(small.filter("u <> v").distinct(), "edges")
