"""One builder for all entry points: UTC, ANSI mode, adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the engine's settings; conf keys use underscores for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    } | {k.replace("_", "."): v for k, v in conf.items()}
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
