"""The Spark session of the engine."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(app: str = "treeline", master: str | None = None, **conf: str) -> SparkSession:
    """Settings that results depend on are fixed here; sizes are left to the cluster and to adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    fixed = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for k, v in (fixed | conf).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
