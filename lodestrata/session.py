"""The session settings that the operators assume."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(master: str | None = None, **more: str) -> SparkSession:
    """A session with SETTINGS; ``more`` are further settings with _ for the dots."""
    builder = SparkSession.builder.appName("lodestrata")
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in more.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def table(spark: SparkSession, sf_dir: str, name: str):
    """One of the input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
