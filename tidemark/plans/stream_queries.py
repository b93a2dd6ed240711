"""Registered queries of the collector's streams: events come in files, and the streams are stopped and started in between."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.plans.fixtures import sql, table
from tidemark.sources import lake
from tidemark.streaming import collector

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


SCHEMA = "key string, at timestamp, turn long, status string"


def in_quarters(rows: DataFrame, at: str) -> list[DataFrame]:
    """The rows in four parts by time; the borders lie between first and last."""
    low, high = rows.agg(F.min(F.unix_micros(at)), F.max(F.unix_micros(at))).first()
    part = F.least(F.lit(3), ((F.unix_micros(at) - low) * 4 / max(1, high - low)).cast("int"))
    return [rows.filter(part == i) for i in range(4)]


EVENTS = """e AS (SELECT CAST(user_id AS VARCHAR) AS key, date_trunc('millisecond', TIMESTAMP '2024-01-01' + to_microseconds(epoch_us(ts) % 86400000000)) AS tm, event_id AS turn,
  CASE WHEN event_type = 'purchase' THEN 'success' WHEN value > 80 THEN 'failed' WHEN value > 40 THEN 'rate_limited' ELSE 'seen' END AS status FROM events)"""
#: Up to its first success or fifth failure an item lives; a pause ends with it, or with the next outcome before it is over.
LEDGER = [
    EVENTS,
    "n AS (SELECT *, count(*) FILTER (status = 'failed') OVER w AS fails, count(*) FILTER (status = 'rate_limited') OVER w AS limits, count(*) FILTER (status = 'success') OVER w AS wins, row_number() OVER w AS i FROM e WINDOW w AS (PARTITION BY key ORDER BY tm, turn))",
    "live AS (SELECT *, max(tm) OVER (PARTITION BY key) AS last_tm FROM n WHERE (wins = 0 OR (wins = 1 AND status = 'success')) AND (fails < 5 OR (fails = 5 AND status = 'failed')))",
    "turns AS (SELECT *, lead(tm) OVER (PARTITION BY key ORDER BY i) AS next_tm FROM live WHERE status <> 'seen')",
    "due AS (SELECT *, CASE WHEN status = 'rate_limited' THEN tm + to_seconds(CAST(least(120 * power(2, least(limits - 1, 10)), 900) AS BIGINT)) WHEN status = 'failed' AND fails < 5 THEN tm + to_seconds(3) END AS due FROM turns)",
    "top AS (SELECT max(tm) - INTERVAL 1 HOUR AS mark FROM e)",
]


def crawl_events(spark, sf_dir) -> DataFrame:
    """All events, laid over one day."""
    v = F.col("value")
    day = F.lit("2024-01-01").cast("timestamp")
    at = F.date_trunc("millisecond", F.timestamp_micros(F.unix_micros(day) + F.unix_micros(F.col("ts").cast("timestamp")) % 86_400_000_000))
    status = F.when(F.col("event_type") == "purchase", "success").when(v > 80, "failed").when(v > 40, "rate_limited").otherwise("seen")
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("key"), at.alias("at"), F.col("event_id").alias("turn"), status.alias("status"))


@query(sql(*LEDGER, """SELECT key, tm AS "at", 'publish' AS action, CAST(0 AS INT) AS attempts, CAST(0 AS INT) AS pauses FROM n WHERE i = 1
  UNION ALL SELECT key, tm, 'give_up', CAST(fails AS INT), CAST(limits AS INT) FROM live WHERE status = 'failed' AND fails = 5
  UNION ALL SELECT key, due, 'fetch', CAST(fails AS INT), CAST(limits AS INT) FROM due, top WHERE due <= coalesce(next_tm, greatest(mark, last_tm))"""))  # fmt: skip
def collector_requests(spark, sf_dir):
    """The state of a crawl as a stream, stopped and started again after each quarter of the events."""
    source, sink, checkpoint = (lake.scratch(spark, n) for n in ("events", "requests", "collector"))
    for quarter in in_quarters(crawl_events(spark, sf_dir), "at"):
        quarter.repartition(2).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        collector.collect(stream, sink, checkpoint).awaitTermination()
    return spark.read.schema(collector.REQUESTS).parquet(sink).withColumn("at", F.col("at").cast("timestamp_ntz"))


@query("SELECT o_custkey AS event_id, count(*) AS sent, 0::BIGINT AS lost FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY ALL")
def delivered_once(spark, sf_dir):
    """Each customer of the orders is sent once, though it comes in several batches and one delivery fails half-way."""
    source, sink, ledger, checkpoint = (lake.scratch(spark, n) for n in ("messages", "sent", "ledger", "deliveries"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("event_id"), "o_orderkey")
    failing = [1]

    def send(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").json(f"{sink}/batch={number}")
        if failing and number == failing[0]:
            failing.clear()
            raise ConnectionError("broker is gone")

    for i in range(3):
        o.filter(f"o_orderkey % 3 = {i}").write.mode("append").parquet(source)
        stream = spark.readStream.schema(o.schema).parquet(source)
        q = collector.deliver(stream, send, ledger, checkpoint, interval="1 second" if i == 2 else None)
        try:
            q.processAllAvailable() if i == 2 else q.awaitTermination()
        except Exception as e:
            if "broker is gone" not in str(e):
                raise
        finally:
            q.stop()
    noted = spark.read.schema("event_id long").parquet(f"{ledger}/batch=*").groupBy("event_id").agg(F.count("*").alias("noted"))
    sent = spark.read.schema("event_id long").json(f"{sink}/batch=*").groupBy("event_id").agg(F.count("*").alias("sent"))
    return sent.join(noted, "event_id", "full").select("event_id", "sent", F.when(F.col("noted") == F.col("sent"), 0).otherwise(1).cast("long").alias("lost"))
