"""The collector as a stream with state: which items were seen, how often each was tried, and when it may be tried again.

Time is the events' own, so a run can be repeated: timers fire as the watermark passes them, and an event that comes after a timer
was due finds it done. The same requests come out however the events are cut into batches, as long as none is later than the
watermark allows. State is one small row per item, which ends with the item.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, LongType, StructField, StructType

from tidemark.operators.state import MAX_ATTEMPTS, unseen

#: Seconds that a rate limit holds an item back at first, and at most; after a failure it may be tried again at once.
FIRST_PAUSE, LONGEST_PAUSE, RETRY_PAUSE = 120, 900, 3
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
REQUESTS = "key string, at timestamp, action string, attempts int, pauses int"
STATE = StructType([StructField("attempts", IntegerType()), StructField("pauses", IntegerType()), StructField("due", LongType()), StructField("over", BooleanType())])


def pause(pauses: int) -> int:
    """Seconds of the pause after so many earlier ones: doubled each time."""
    return min(FIRST_PAUSE * 2 ** min(pauses, 10), LONGEST_PAUSE)


def frame(rows: list[tuple]) -> list[pd.DataFrame]:
    """Requests (times in microseconds) as a table; none, if there are none."""
    if not rows:
        return []
    key, at, action, attempts, pauses = zip(*rows, strict=True)
    return [pd.DataFrame({"key": list(key), "at": np.array(at, "datetime64[us]"), "action": list(action), "attempts": list(attempts), "pauses": list(pauses)})]


class Collector(StatefulProcessor):
    """Rows (key, at, status): status is seen, success, failed, rate_limited or skipped.

    Requests: publish when an item is first met; fetch when a pause is over; give_up with the last attempt. A rate limit uses no
    attempt; success, skipped and giving up end the item, and what comes for it later is passed over.
    """

    def __init__(self, limit: int = MAX_ATTEMPTS):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("item", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        name, out = key[0], []
        parts = [(r["at"].to_numpy("datetime64[us]").astype("int64"), r["turn"].to_numpy("int64"), r["status"].to_numpy(object)) for r in rows]
        micros, turn, status = (np.concatenate(c) if len(parts) > 1 else c[0] for c in zip(*parts, strict=True))
        order = np.lexsort((turn, micros))
        old = self.state.get()  # a call out of the process: each is made only where it changes something
        attempts, pauses, due, over = before = old or (0, 0, 0, False)
        new, armed = old is None, due
        for at, what in zip(micros[order].tolist(), status[order].tolist(), strict=True):
            now = at // 1000
            if new:
                out.append((name, at, "publish", 0, 0))
                new = False
            if over:
                break
            if due and due <= now:
                out.append((name, due * 1000, "fetch", attempts, pauses))
                due = 0
            if what == "rate_limited":
                due, pauses = now + 1000 * pause(pauses), pauses + 1
            elif what == "failed":
                attempts, due = attempts + 1, now + 1000 * RETRY_PAUSE
                if attempts >= self.limit:
                    over, due = True, 0
                    out.append((name, at, "give_up", attempts, pauses))
            elif what in ("success", "skipped"):
                over, due = True, 0
        if armed and armed != due:
            self.handle.deleteTimer(armed)
        if due and armed != due:
            self.handle.registerTimer(due)
        if old is None or (attempts, pauses, due, over) != tuple(before):
            self.state.update((attempts, pauses, due, over))
        yield from frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        attempts, pauses, due, over = self.state.get()
        if due == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((attempts, pauses, 0, over))
            yield from frame([(key[0], due * 1000, "fetch", attempts, pauses)])

    def close(self) -> None:
        pass


def requests(events: DataFrame, delay: str = "1 hour", limit: int = MAX_ATTEMPTS) -> DataFrame:
    """A stream of requests from a stream of events (key, at, turn, status); turn settles the order of one moment. Events may be
    late by delay. Needs the RocksDB state store."""
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS)
    rows = events.select(F.col("key").cast("string").alias("key"), F.col("at").cast("timestamp").alias("at"), "turn", "status").withWatermark("at", delay)
    return rows.groupBy("key").transformWithStateInPandas(Collector(limit), REQUESTS, "Append", "EventTime")


def collect(events: DataFrame, sink: str, checkpoint: str, interval: str | None = None, **options):
    """Start the collector: requests go to Parquet files that are listed once, so a restart repeats nothing and loses nothing."""
    out = requests(events, **options).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint).outputMode("append")
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()


def deliver(messages: DataFrame, send: Callable[[DataFrame, int], None], ledger: str, checkpoint: str, key: str = "event_id", interval: str | None = None):
    """Start a query that sends each key once and notes it in the ledger only after send has returned.

    send gets the new rows of a batch and the batch's number. If it fails, nothing is noted and the batch is tried again when
    the query is started again; a repeated batch has its number, so that send can replace what it left. The ledger is Parquet with
    one folder for each batch; a batch that it holds is over.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine, noted = f"{ledger}/batch={number:020d}", f"{ledger}/batch=*"
        fs = spark._jvm.org.apache.hadoop.fs.Path(ledger)
        files = fs.getFileSystem(spark._jsc.hadoopConfiguration())
        if files.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{mine}/_SUCCESS")):
            return
        rows = batch.dropDuplicates([key])
        # the ledger is narrowed to this batch's keys by the join; folders without _SUCCESS never finished
        done = [str(x.getPath().getParent()) for x in files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{noted}/_SUCCESS")) or []]
        if done:
            rows = unseen(rows, [spark.read.schema(batch.select(key).schema).parquet(*done)], key)
        rows = rows.persist()
        try:
            send(rows, number)
            rows.select(key).write.mode("overwrite").parquet(mine)
        finally:
            rows.unpersist()

    out = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=interval) if interval else out.trigger(availableNow=True)).start()
