"""Averages, streams, publishing and writing in cases that the queries do not reach."""

import datetime as dt
import glob
import os
import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.operators import indicators as ind
from tidemark.operators import market
from tidemark.sources import lake
from tidemark.streaming import collector


def averages(values, span):
    out, y = [], None
    for x in values:
        if x is not None:
            y = x if y is None else y + (x - y) * 2 / (span + 1)
        out.append(y)
    return out


@pytest.mark.parametrize("block", [4, 64])
def test_ema_is_the_recursion(spark, monkeypatch, block):
    monkeypatch.setattr(ind, "BLOCK", block)
    rng, start = np.random.default_rng(7), dt.date(2020, 1, 1)
    series = {"long": (100 + rng.standard_normal(700).cumsum()).tolist(), "gaps": [None, None, *[None if i % 5 == 0 else float(i % 11) for i in range(90)]], "one": [3.0], "none": [None, None], "far": [1e12] + [1.0] * 300}
    rows = [(t, start + dt.timedelta(days=i // 2), "b" if i % 2 else "a", v) for t, x in series.items() for i, v in enumerate(x)]  # two bars a day
    df = spark.createDataFrame(rows, "ticker string, session_date date, source string, close double").repartition(3)

    @ind.in_turn
    def run(d):
        return ind.ema(ind.ema(ind.ema(d, "close", 12, "e12"), "close", 1, "e1"), "close", 40, "e40")

    got = run(df).orderBy("ticker", "session_date", "source").toPandas()
    assert list(got.columns) == ["ticker", "session_date", "source", "close", "e12", "e1", "e40"]
    for t, x in series.items():
        for c, span in (("e12", 12), ("e1", 1), ("e40", 40)):
            own = got[got.ticker == t][c]
            np.testing.assert_allclose(own.astype(float), np.array(averages(x, span), float), rtol=1e-9, atol=1e-9)


def test_macd_keeps_its_rows(spark):
    rows = [("x", dt.date(2024, 1, 1 + i), s, 10.0 + i + (s == "b")) for i in range(20) for s in "ab"]
    out = ind.macd(spark.createDataFrame(rows, "ticker string, session_date date, source string, close double")).toPandas()
    assert len(out) == 40
    e = out.sort_values(["session_date", "source"])["close"].ewm(span=12, adjust=False).mean()
    np.testing.assert_allclose(out.sort_values(["session_date", "source"])["ema_fast"], e, rtol=1e-12)


def test_session_returns_follow_the_source(spark):
    rows = [("x", dt.date(2024, 1, d), s, c) for d, s, c in ((2, "a", 10.0), (2, "b", 12.0), (3, "a", 11.0), (3, "b", 12.1))]
    for order in (rows, rows[::-1]):
        out = market.session_returns(spark.createDataFrame(order, "ticker string, session_date date, source string, close double"))
        assert [r.session_return and round(r.session_return, 4) for r in out.orderBy("session_date", "source").collect()] == [None, 0.2, -0.0833, 0.1]


def test_correlation_of_what_never_moves(spark):
    rows = [(dt.date(2024, 1, d), t, float(d) if t == "m" else 1.0) for d in range(1, 9) for t in ("m", "flat", "b")]
    bars = spark.createDataFrame(rows, "session_date date, ticker string, daily_return double")
    out = market.correlation_with(bars, spark.createDataFrame([("b",)], "ticker string"), least=2)
    assert {(r.a, r.correlation) for r in out.collect()} == {("m", None), ("flat", None)}


def test_one_of_two_publishers_wins(spark):
    root = lake.scratch(spark, "two-writers")
    df = spark.range(10).selectExpr("id", "current_date() AS d")
    lake.publish(df, root, "base", "d")
    outcomes = {}

    def write(name):
        try:
            outcomes[name] = lake.publish(df.filter(f"id < {len(name)}"), root, name, "d", based_on=1)["version"]
        except lake.PublishConflict:
            outcomes[name] = "conflict"

    threads = [threading.Thread(target=write, args=(n,)) for n in ("a", "bb")]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(map(str, outcomes.values())) == ["2", "conflict"]
    winner = next(n for n, v in outcomes.items() if v == 2)
    assert lake.published(spark, root, verify=True).count() == len(winner) and lake.published(spark, root, version=1).count() == 10
    assert lake.publish(df, root, "next", "d")["version"] == 3
    assert lake.expire(spark, root, older_than_ms=0) == [] and lake.expire(spark, root, older_than_ms=1 << 60) == [1, 2]
    assert lake.published(spark, root).count() == 10


def test_changed_rows_are_found(spark):
    root = lake.scratch(spark, "tampered")
    lake.publish(spark.range(10).selectExpr("id", "current_date() AS d"), root, "r", "d")
    spark.range(3).selectExpr("id", "current_date() AS d").write.mode("overwrite").parquet(f"{root}/run_id=r")
    with pytest.raises(ValueError, match="rows=3 instead of 10"):
        lake.published(spark, root, verify=True)
    with pytest.raises(ValueError, match="nothing is published"):
        lake.published(spark, lake.scratch(spark, "empty"))


def test_hot_value_is_written_in_several_files(spark):
    path = lake.scratch(spark, "hot")
    rows = spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s"), F.when(F.col("id") % 50 == 0, F.col("id") % 7).otherwise(0).alias("k"))
    lake.write_partitioned(rows.repartition(8), path, "k", file_mb=2)
    files = {k: len(glob.glob(f"{path.removeprefix('file://')}/k={k}/*.parquet")) for k in range(7)}
    assert files[0] >= 4 and all(1 <= files[k] <= files[0] + 1 for k in range(1, 7))
    assert max(os.path.getsize(f) for f in glob.glob(f"{path.removeprefix('file://')}/k=0/*.parquet")) < 8e6  # of some 26 MB
    assert spark.read.parquet(path).count() == 400_000


def test_pauses():
    assert [collector.pause(i) for i in range(6)] == [120, 240, 480, 900, 900, 900]


def test_collector_in_any_batches(spark):
    """The same requests whether the events come at once or in three batches with stops between."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    events = [("a", at(0), 1, "seen"), ("a", at(5), 2, "rate_limited"), ("a", at(60), 3, "rate_limited"), ("a", at(400), 4, "failed"), ("a", at(400), 5, "seen"), ("a", at(5000), 6, "success"), ("a", at(5001), 7, "failed")]
    events += [("b", at(10 * i), 10 + i, "failed") for i in range(7)] + [("c", at(9000), 30, "rate_limited"), ("d", at(9001), 31, "skipped"), ("e", at(20000), 32, "seen")]
    want = {("a", 0, "publish", 0, 0), ("a", 300, "fetch", 0, 2), ("a", 403, "fetch", 1, 2), ("b", 0, "publish", 0, 0), ("b", 40, "give_up", 5, 0), ("c", 9000, "publish", 0, 0), ("c", 9120, "fetch", 0, 1), ("d", 9001, "publish", 0, 0), ("e", 20000, "publish", 0, 0)}
    want |= {("b", 10 * i + 3, "fetch", i + 1, 0) for i in range(4)}
    schema = "key string, at timestamp, turn long, status string"
    for cuts in ([len(events)], [0, 300, 8000]):
        source, sink, checkpoint = (lake.scratch(spark, n) for n in ("ev", "out", "cp"))
        parts = [events] if len(cuts) == 1 else [[e for e in events if lo <= (e[1] - at(0)).total_seconds() < hi] for lo, hi in zip(cuts, [*cuts[1:], 1e9], strict=True)]
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(source)
            collector.collect(spark.readStream.schema(schema).parquet(source), sink, checkpoint).awaitTermination()
        got = [(r.key, (r.at - at(0)).total_seconds(), r.action, r.attempts, r.pauses) for r in spark.read.schema(collector.REQUESTS).parquet(sink).collect()]
        assert len(got) == len(set(got)) and set(got) == want




def test_merge_touches_only_its_slots(spark):
    from tidemark.operators.keyed import KeyedState

    state, path = KeyedState(spark, "keyed_state_test", "k", 8), lake.scratch(spark, "keyed")
    state.create(spark.range(200).selectExpr("id AS k", "'old' AS v"), path)
    files = lambda: {f for f in glob.glob(f"{path.removeprefix('file://')}/slot=*/*.parquet")}
    before = files()
    new = spark.createDataFrame([(3, "new"), (777, "new"), (None, "no key")], "k long, v string")
    plan = state.joined(new.filter("k is not null"), list(range(8)), lambda old, fresh, _, is_new: {"v": F.when(is_new, fresh["v"]).otherwise(old["v"])})
    text = plan._jdf.queryExecution().executedPlan().toString()
    scan = text[text.index("keyed_state_test") :]
    assert text.count("Exchange") == 1 and "SelectedBucketsCount" in scan  # only the new rows are dealt
    slots = state.replace(new)
    after = files()
    gone = {f.split("/")[-2] for f in before - after}
    assert gone <= {f"slot={s}" for s in slots} and len(slots) <= 2 and len(before & after) >= 6
    assert {r.k: r.v for r in state.rows().collect()} == {i: "new" if i == 3 else "old" for i in range(200)} | {777: "new"}
    assert state.replace(new.filter("false")) == []
    spark.sql("DROP TABLE keyed_state_test")
