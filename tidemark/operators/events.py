"""Event windows and impacts: returns of sessions around events, against a benchmark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import ZONE, growth, impact_label, join_quality
from tidemark.operators.market import benchmark_index, indexed, session_order, session_returns
from tidemark.operators.sessions import CLOSE_HOUR, known_session, reaction_session

OFFSETS = (-5, -3, -2, -1, 0, 1, 2, 3, 5)
HORIZONS = (1, 3, 5)


def local_events(news: DataFrame, close_hour: int = CLOSE_HOUR) -> DataFrame:
    """One row per event and ticker with event_at, event_date and after_close in local time; news: tickers array, published_timestamp."""
    out = news.withColumn("ticker", F.explode("tickers")).drop("tickers").withColumn("event_at", F.from_utc_timestamp("published_timestamp", ZONE))
    return out.filter(F.col("event_at").isNotNull()).withColumns({"event_date": F.to_date("event_at"), "after_close": F.hour("event_at") >= close_hour})


def event_window(events: DataFrame, bars: DataFrame, offsets: tuple[int, ...] = OFFSETS) -> DataFrame:
    """One row per event, ticker and offset: session, cumulative return from the session before T0, and the same less the benchmark's.

    Sessions that do not exist stay as rows without market data. bars: ticker, session_date, close, daily_return, valid rows only.
    """
    numbered = indexed(bars)
    t0 = reaction_session(events, numbered)
    wanted = t0.withColumn("relative_session", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn("session_index", F.col("t0_index") + F.col("relative_session"))
    rows = wanted.join(numbered.select("ticker", "session_index", "session_date", "close", "daily_return"), ["ticker", "session_index"], "left")
    index = benchmark_index(bars)
    rows = rows.join(index, "session_date", "left").join(index.select(F.col("session_date").alias("anchor_date_t_minus_1"), F.col("benchmark_index").alias("benchmark_anchor_index")), "anchor_date_t_minus_1", "left")
    out = rows.withColumns(
        {
            "has_market_data": F.col("session_date").isNotNull(),
            "stock_cumulative_return": growth(F.col("close"), F.col("anchor_close_t_minus_1")),
            "benchmark_cumulative_return": growth(F.col("benchmark_index"), F.col("benchmark_anchor_index")),
            "gold_year_month": F.date_format("event_date", "yyyy-MM"),
        }
    )
    return out.withColumn("abnormal_return", F.col("stock_cumulative_return") - F.col("benchmark_cumulative_return"))


def session_windows(events: DataFrame, bars: DataFrame, benchmark: DataFrame, offsets: tuple[int, ...] = OFFSETS, threshold: float = 0.02) -> DataFrame:
    """Return of each session around T0 by itself, less the benchmark's of that date; sessions that do not exist are left out."""
    numbered = indexed(session_returns(bars))
    t0 = reaction_session(events, numbered).drop("anchor_close_t_minus_1", "anchor_date_t_minus_1")
    wanted = t0.withColumn("relative_session", F.explode(F.array(*[F.lit(o) for o in offsets]))).withColumn("session_index", F.col("t0_index") + F.col("relative_session"))
    rows = wanted.join(numbered.select("ticker", "session_index", "session_date", *["source"] * ("source" in bars.columns), "close", "session_return"), ["ticker", "session_index"])
    own = session_returns(benchmark.withColumn("ticker", F.lit("benchmark"))).select("session_date", F.col("session_return").alias("benchmark_session_return"))
    rows = rows.join(own, "session_date", "left").withColumn("abnormal_session_return", F.col("session_return") - F.col("benchmark_session_return"))
    value = F.coalesce("abnormal_session_return", "session_return")
    return rows.withColumns({"impact_label": impact_label(value, threshold), "join_quality": join_quality(F.col("abnormal_session_return"), F.col("published_precision"))})


def impacts(events: DataFrame, bars: DataFrame, benchmark: DataFrame, horizons: tuple[int, ...] = HORIZONS, threshold: float = 0.02) -> DataFrame:
    """Return from the last known close to so many sessions later, raw and less the benchmark's over the same dates."""
    order = session_order(bars)
    ahead = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lead("close", h).over(order).alias("close"), F.lead("session_date", h).over(order).alias("date")) for h in horizons])
    anchored = known_session(events, indexed(bars).withColumn("ahead", ahead), "ahead")
    rows = anchored.withColumn("x", F.explode("ahead")).filter(F.col("x.date").isNotNull()).select("*", F.col("x.horizon").alias("horizon_sessions"), F.col("x.close").alias("target_close"), F.col("x.date").alias("target_date")).drop("x", "ahead")
    at = lambda date, close: benchmark.select(F.col("session_date").alias(date), F.col("close").alias(close))
    rows = rows.join(at("known_date", "_b0"), "known_date", "left").join(at("target_date", "_b1"), "target_date", "left")
    ratio = growth(F.nullif(F.col("_b1"), F.lit(0.0)), F.col("_b0"))
    rows = rows.withColumns({"raw_return": growth(F.col("target_close"), F.col("known_close")), "benchmark_return": ratio}).withColumn("abnormal_return", F.col("raw_return") - F.col("benchmark_return")).drop("_b0", "_b1")
    return rows.withColumns({"impact_label": impact_label(F.coalesce("abnormal_return", "raw_return"), threshold), "join_quality": join_quality(F.col("abnormal_return"), F.col("published_precision"))})


def skip_counts(events: DataFrame, bars: DataFrame, offsets: tuple[int, ...] = OFFSETS, horizons: tuple[int, ...] = HORIZONS) -> DataFrame:
    """One row: events without T0, offsets outside the history, events without a known close, horizons without a session."""
    numbered = indexed(bars)
    key = ["event_id", "ticker"]
    sizes = bars.groupBy("ticker").agg(F.count("*").alias("sessions"))
    t0 = reaction_session(events, numbered).join(sizes, "ticker").select(*key, "t0_index", F.col("sessions").alias("s0"))
    known = known_session(events, numbered).join(sizes, "ticker").select(*key, "known_index", F.col("sessions").alias("s1"))
    both = events.select(*key).join(t0, key, "left").join(known, key, "left")
    outside = sum((F.when((F.col("t0_index") + o < 1) | (F.col("t0_index") + o > F.col("s0")), 1).otherwise(0) for o in offsets), F.lit(0))
    ahead = sum((F.when(F.col("known_index") + h > F.col("s1"), 1).otherwise(0) for h in horizons), F.lit(0))
    return both.agg(
        F.count_if(F.col("t0_index").isNull()).alias("no_t0"), F.sum(outside).alias("outside_history"),
        F.count_if(F.col("known_index").isNull()).alias("no_anchor"), F.sum(ahead).alias("no_future"),
    )


def event_choices(gold: DataFrame, news: DataFrame) -> DataFrame:
    """One row per ticker and event that a reader may pick: event_id, ticker, title and the sessions with market data."""
    known = gold.groupBy("event_id", "ticker").agg(F.count_if("has_market_data").alias("sessions"))
    return known.join(news.select("event_id", "title"), "event_id")


def windows_with_news(gold: DataFrame, news: DataFrame, session: int, limit: int = 100) -> DataFrame:
    """The limit rows of one relative session with the largest abnormal return (else return) of either sign, with their news."""
    moved = F.abs(F.coalesce("abnormal_return", "stock_cumulative_return"))
    rows = gold.filter(F.col("relative_session") == session).orderBy(moved.desc_nulls_last(), "event_id", "ticker").limit(limit)
    return F.broadcast(rows).join(news.select("event_id", "title", "source"), "event_id")  # limit rows
