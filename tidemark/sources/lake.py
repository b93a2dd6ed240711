"""Zones of the lake: reading by schema, partitioned and quarantined writes, versioned publishing."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def relative(path: str) -> str:
    """path, if it stays inside its zone; absolute paths and parent steps are refused."""
    if not path or path.startswith("/") or re.match(r"^[a-zA-Z][\w+.-]*:", path) or ".." in path.split("/"):
        raise ValueError(f"not a relative path: {path!r}")
    return path


@dataclass(frozen=True)
class Lake:
    """A root URI (local, HDFS, or an object store that Spark has a connector for) and its zones."""

    root: str

    def path(self, zone: str, name: str = "") -> str:
        if zone not in ("bronze", "silver", "gold", "checkpoints", "quarantine"):
            raise ValueError(f"unknown zone: {zone!r}")
        return "/".join([self.root.rstrip("/"), zone, *([relative(name)] if name else [])])


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder that all executors share: under spark.checkpoint.dir, or a temporary one where that is unset."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def read_json(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines, plain or compressed, in any folder depth, by a fixed schema; other fields are ignored."""
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(paths)


def write_json(df: DataFrame, path: str, partition: list[str] | None = None, rows_per_file: int | None = None) -> None:
    """Compressed JSON lines."""
    out = df.write.mode("append").option("compression", "gzip")
    if rows_per_file:
        out = out.option("maxRecordsPerFile", rows_per_file)
    (out.partitionBy(*partition) if partition else out).json(path)


@contextmanager
def settings(spark: SparkSession, **conf: str) -> Iterator[None]:
    """Session settings for as long as the block runs; underscores stand for dots."""
    names = {k.replace("_", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_partitioned(df: DataFrame, path: str, partition: str, file_mb: int = 128, mode: str = "overwrite") -> None:
    """Parquet with one folder per value; only folders that occur are replaced.

    Rows are rebalanced by value: small values share a task, and the rows of a large one are dealt to as many tasks, and so
    files, as hold about file_mb of shuffled rows each.
    """
    with settings(df.sparkSession, **{"spark_sql_adaptive_advisoryPartitionSizeInBytes": f"{file_mb}m"}):
        df.hint("rebalance", partition).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)


def write_valid(df: DataFrame, path: str, partition: str, quarantine: str | None = None) -> None:
    """Valid rows to their place; invalid ones, if a place is given, beside it."""
    write_partitioned(df.filter("is_valid"), path, partition)
    if quarantine:
        df.filter("is_valid is not true").write.mode("append").parquet(quarantine)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("encoding", "UTF-8").csv(path)


def manifest(df: DataFrame, date: str, label: str | None = None) -> DataFrame:
    """One row about a snapshot: rows, first and last date, rows by label, and a checksum that does not depend on order."""
    row = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    out = [F.count("*").alias("rows"), F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.coalesce(F.sum(row.cast("decimal(38,0)")), F.lit(0)).cast("string").alias("checksum")]
    if label:
        out.append(F.map_from_entries(F.array_sort(F.collect_set(F.struct(F.coalesce(F.col(label).cast("string"), F.lit("")).alias("k"), F.col("_n").alias("n"))))).alias("labels"))
        per = df.groupBy(label).agg(F.count("*").alias("_n"))
        return df.agg(*out[:-1]).crossJoin(per.agg(out[-1]))
    return df.agg(*out)


class PublishConflict(Exception):
    """Another run was published in between."""


def _files(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[tuple[int, int]]:
    """Numbers of the published manifests with the times they were written at (milliseconds), oldest first."""
    at, fs = _files(spark, f"{root}/manifests")
    names = [(x.getPath().getName(), x.getModificationTime()) for x in fs.listStatus(at)] if fs.exists(at) else []
    return sorted((int(n[:-5]), when) for n, when in names if re.fullmatch(r"\d{20}\.json", n))


def claim(spark: SparkSession, root: str, number: int, facts: str) -> None:
    """Write the manifest of a number, unless there is one: a file beside it is renamed, which fails where the name is taken."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    target, fs = _files(spark, f"{root}/manifests/{number:020d}.json")
    beside = hadoop.Path(f"{root}/manifests/.{uuid.uuid4().hex}")
    stream = fs.create(beside)
    stream.write(bytearray(facts.encode("utf-8")))
    stream.close()
    plain = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    plain[0] = getattr(hadoop, "Options$Rename").NONE
    try:
        hadoop.FileContext.getFileContext(target.toUri(), conf).rename(beside, target, plain)
    except Exception as e:
        fs.delete(beside, False)
        if "FileAlreadyExists" in str(e) or fs.exists(target):
            raise PublishConflict(f"version {number} was published by another writer") from e
        raise


def publish(df: DataFrame, root: str, run_id: str, date: str, partition: str | None = None, based_on: int | None = None) -> dict:
    """Write a run beside the earlier ones, compare what can be read with what was written, then publish it as the next version.

    based_on: the version that the rows were made from (0: none); the one that is current at the start, if it is not given. If
    there is another by the end, nothing is published, the run's files go and PublishConflict is raised.
    """
    spark, path, written = df.sparkSession, f"{root}/run_id={relative(run_id)}", Observation()
    if based_on is None:
        based_on = max((n for n, _ in versions(spark, root)), default=0)
    out = df.observe(written, F.count(F.lit(1)).alias("n")).write.mode("error")
    (out.partitionBy(partition) if partition else out).parquet(path)
    facts = manifest(spark.read.parquet(path).select(*df.columns), date).withColumns({"run_id": F.lit(run_id), "date": F.lit(date), "columns": F.array(*[F.lit(c) for c in df.columns])}).toJSON().first()
    if json.loads(facts)["rows"] != written.get["n"]:
        raise ValueError(f"FAILED rows={json.loads(facts)['rows']} instead of {written.get['n']}")
    try:
        claim(spark, root, based_on + 1, facts)
    except PublishConflict:
        at, fs = _files(spark, path)
        fs.delete(at, True)
        raise
    return json.loads(facts) | {"version": based_on + 1}


def manifest_of(spark: SparkSession, root: str, version: int | None = None) -> dict:
    """What is known of a version, the last one without a number."""
    number = version or max((n for n, _ in versions(spark, root)), default=None)
    if number is None:
        raise ValueError(f"nothing is published in {root}")
    return json.loads(spark.read.text(f"{root}/manifests/{number:020d}.json", wholetext=True).first()[0]) | {"version": number}


def published(spark: SparkSession, root: str, version: int | None = None, verify: bool = False) -> DataFrame:
    """The rows of a version, the last one without a number. verify reads them once and compares rows and checksum with the manifest."""
    facts = manifest_of(spark, root, version)
    rows = spark.read.parquet(f"{root}/run_id={facts['run_id']}").select(*facts["columns"])
    if verify:
        now = json.loads(manifest(rows, facts["date"]).toJSON().first())
        wrong = {k: (facts.get(k), now.get(k)) for k in ("rows", "checksum") if facts.get(k) != now.get(k)}
        if wrong:
            raise ValueError(f"FAILED version {facts['version']}: " + ", ".join(f"{k}={b} instead of {a}" for k, (a, b) in wrong.items()))
    return rows


def expire(spark: SparkSession, root: str, older_than_ms: int) -> list[int]:
    """Delete versions written before a time (milliseconds), but never the last one; their numbers."""
    gone = [n for n, when in versions(spark, root)[:-1] if when < older_than_ms]
    for n in gone:
        run = manifest_of(spark, root, n)["run_id"]
        for path in (f"{root}/manifests/{n:020d}.json", f"{root}/run_id={run}"):  # first out of sight, then the rows
            at, fs = _files(spark, path)
            fs.delete(at, True)
    return gone


# Event types and states of raw rows.
COLLECTED, EXPORTED, DAILY = "news.collected", "news.historical.exported", "market.daily.collected"


def bronze_news(df: DataFrame, collected_at: Column, event_type: str = COLLECTED) -> DataFrame:
    """Stored news (id, title, summary, content, url, source, published, tickers) as raw events."""
    from tidemark.functions.text import FULL_TEXT_CHARS, event_key, local_text, utc_text

    body = F.trim(F.coalesce("content", F.lit("")))
    return df.filter(F.size("tickers") > 0).select(
        event_key(F.col("url"), F.col("source"), F.col("title")).alias("event_id"), F.lit(1).alias("schema_version"), F.lit(event_type).alias("event_type"), "source", "url", "title", "summary", body.alias("content"),
        F.col("tickers").alias("merged_tickers"), F.length(body).alias("content_length"), F.when(F.length(body) >= FULL_TEXT_CHARS, "success").otherwise("metadata_only").alias("article_enrichment_status"),
        F.col("published").alias("published_at_raw"), utc_text(F.col("published")).alias("published_at_utc"), local_text(F.col("published")).alias("published_at_vn"), collected_at.alias("collected_at_utc"),
        F.substring(collected_at, 1, 10).alias("ingest_date"),
    )


def bronze_market(df: DataFrame, provider: str, collected_at: Column) -> DataFrame:
    """Provider rows (ticker, date, open, high, low, close, volume) as raw bars; the date is taken before any zone change."""
    from tidemark.functions.text import market_key

    day = F.substring(F.col("date").cast("string"), 1, 10)
    return df.select(
        market_key(F.col("ticker"), day, F.lit(provider)).alias("event_id"), F.lit(1).alias("schema_version"), F.lit(DAILY).alias("event_type"), "ticker", day.alias("session_date"), F.lit("1d").alias("interval"),
        "open", "high", "low", "close", F.col("volume").cast("double").alias("volume"), F.lit("VND").alias("currency"), F.lit("split_dividend_adjusted" if provider == "yahoo" else "provider_default").alias("price_adjustment"),
        F.lit(provider).alias("source"), collected_at.alias("collected_at_utc"), F.substring(collected_at, 1, 10).alias("ingest_date"),
    )
