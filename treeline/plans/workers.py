"""Python workers need this package too."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession


def importable(spark: SparkSession) -> SparkSession:
    """Let workers find the package where it lies at the same path for them; otherwise ship it with --py-files."""
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if root not in paths:
        env["PYTHONPATH"] = ":".join([root, *paths])
    return spark
