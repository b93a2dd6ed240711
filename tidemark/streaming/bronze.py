"""News messages to the raw zone with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import NEWS


def kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest") -> DataFrame:
    """Needs Spark's Kafka connector on the class path."""
    return spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting).option("failOnDataLoss", "false").load()


def files(spark: SparkSession, path: str) -> DataFrame:
    """Text files as a stream of messages with the columns of a broker's."""
    lines = spark.readStream.text(path)
    return lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"), F.lit("files").alias("topic"), F.lit(0).alias("partition"), F.lit(None).cast("long").alias("offset"), F.current_timestamp().alias("timestamp"))


def parsed(messages: DataFrame, schema=NEWS) -> DataFrame:
    """News fields, the payload and where it came from; dead marks payloads that are no event."""
    payload = F.col("value").cast("string")
    out = messages.withColumn("raw_payload", payload).withColumn("news", F.from_json(payload, schema))
    out = out.select("news.*", "raw_payload", F.col("topic").alias("kafka_topic"), F.col("partition").alias("kafka_partition"), F.col("offset").alias("kafka_offset"), F.col("timestamp").cast("string").alias("kafka_timestamp"))
    return out.withColumn("dead", F.col("event_id").isNull())


def stream_bronze(messages: DataFrame, sink: str, dead_letters: str, checkpoint: str, interval: str | None = None, strict: bool = True):
    """Start the query: each batch goes to a folder named by its number, so that a repeated batch replaces itself.

    Payloads that are no event go to dead_letters (strict), or along with the others. interval: a processing-time trigger;
    without it all that is there is read once.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # looked at three times; spills to disk
        if not batch.isEmpty():
            good = batch.filter(~F.col("dead")) if strict else batch
            good.drop("dead").write.mode("overwrite").option("compression", "gzip").json(f"{sink}/batch={number:020d}")
            if strict:
                batch.filter("dead").select("raw_payload", "kafka_timestamp").write.mode("overwrite").json(f"{dead_letters}/batch={number:020d}")
        batch.unpersist()

    out = parsed(messages).writeStream.queryName("bronze_news").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()


def first_seen(events: DataFrame, time: str, key: str, delay: str = "1 day") -> DataFrame:
    """An extension: repeated keys within the delay are dropped while streaming, with bounded state."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def messages_out(df: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows as keyed JSON messages for a broker."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))
