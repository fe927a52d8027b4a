"""Descriptive statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_statistics(rows: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """group, n, mn, mx and, for each name, the value at index floor(n * share) of the sorted ones.

    Values are counted first, so each distinct value of a group is one row, however often it repeats; exact, without
    interpolation.
    """
    from pyspark.sql import Window

    counted = rows.groupBy(group, value).agg(F.count("*").alias("__c"))
    upto = Window.partitionBy(group).orderBy(value)
    all_rows = Window.partitionBy(group)
    ranked = counted.withColumns({"__upto": F.sum("__c").over(upto), "__n": F.sum("__c").over(all_rows)})
    at = lambda s: F.floor(F.col("__n") * F.lit(float(s)))
    picks = [F.max(F.when((at(s) < F.col("__upto")) & (at(s) >= F.col("__upto") - F.col("__c")), F.col(value))).alias(name) for name, s in shares.items()]
    return ranked.groupBy(group).agg(F.max("__n").alias("n"), F.min(value).alias("mn"), F.max(value).alias("mx"), *picks)


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(column).agg(F.count("*").alias("n"))


def ratio_by(rows: DataFrame, group: str, part: str, whole: str) -> DataFrame:
    """group, ratio of the sums; 0 where the whole is empty."""
    return rows.groupBy(group).agg(F.coalesce(F.try_divide(F.sum(part), F.sum(whole)), F.lit(0.0)).alias("ratio"))


def top_by(rows: DataFrame, order: list, limit: int = 10) -> DataFrame:
    return rows.orderBy(*order).limit(limit)


def top_per(rows: DataFrame, group: list[str], order: list, limit: int = 10) -> DataFrame:
    """The first rows of each group; each task hands on that many of a group at most."""
    from pyspark.sql import Window

    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("__n") <= limit).drop("__n")


def totals(rows: DataFrame, group: str, size: str) -> DataFrame:
    """group, n, total."""
    return rows.groupBy(group).agg(F.count("*").alias("n"), F.sum(size).alias("total"))
