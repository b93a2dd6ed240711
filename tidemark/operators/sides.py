"""Sides of joins that are broadcast only after they were counted, and tables between steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 200_000


def sized(df: DataFrame, limit: int = ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most limit rows, else as it is, for a shuffled join."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def spread(df: DataFrame, each: int = 1) -> DataFrame:
    """df over all cores, if it has fewer than so many partitions for each: a few compressed megabytes are one task of a scan, though
    what is made of their rows may be large. Its rows are shuffled then, so it is for narrow ones."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < each * cores else df


def kept(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: it is computed once, and lost executors do not matter."""
    from tidemark.sources.lake import scratch

    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
