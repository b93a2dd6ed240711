"""Point-in-time joins of events to trading sessions.

Every as-of join here is an equi-join: a session is repeated for each calendar day that it answers for (its gap to the next
session), so that a day finds its session by (ticker, day). Bars grow by the length of the gaps only, a hot ticker spreads over
its days, and Spark may split skewed keys, which a range join or a window per ticker would not allow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CLOSE_HOUR = 15


def _bounds(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.min("session_date").alias("_first"), F.max("session_date").alias("_last"))


def forward_calendar(indexed: DataFrame) -> DataFrame:
    """The first bar of each date, for that day and the days since the date before."""
    first = indexed.filter(F.col("anchor_date").isNull() | (F.col("anchor_date") < F.col("session_date")))
    return first.select("*", F.explode(F.sequence(F.coalesce(F.date_add("anchor_date", 1), F.col("session_date")), F.col("session_date"))).alias("_day"))


def backward_calendar(indexed: DataFrame) -> DataFrame:
    """The last bar of each date, for that day and the days up to the next date."""
    after = F.lead("session_date").over(Window.partitionBy("ticker").orderBy("session_index"))
    last = indexed.withColumn("_next", after).filter(F.col("_next").isNull() | (F.col("_next") > F.col("session_date")))
    return last.select("*", F.explode(F.sequence(F.col("session_date"), F.coalesce(F.date_sub("_next", 1), F.col("session_date")))).alias("_day")).drop("_next")


def reaction_session(events: DataFrame, indexed: DataFrame) -> DataFrame:
    """Events with t0_date, t0_index and the bar before it: the first session that can show the news.

    events: ticker, event_date, after_close. The event's own day counts unless it came after the close. Events after the last
    session have none and are dropped. Where a date has several bars (of several sources) T0 is the first of them.
    """
    wanted = events.join(_bounds(indexed), "ticker").withColumn("_day", F.greatest(F.date_add("event_date", F.col("after_close").cast("int")), "_first"))
    calendar = forward_calendar(indexed).select("ticker", "_day", F.col("session_date").alias("t0_date"), F.col("session_index").alias("t0_index"), F.col("anchor_close").alias("anchor_close_t_minus_1"), F.col("anchor_date").alias("anchor_date_t_minus_1"))
    return wanted.join(calendar, ["ticker", "_day"]).drop("_day", "_first", "_last")


def known_session(events: DataFrame, indexed: DataFrame, *carried: str) -> DataFrame:
    """Events with known_date, known_close and known_index: the last session whose close was known at the event.

    Events before any known close are dropped. Of several bars of a date the last counts. carried: other columns of the bar.
    """
    wanted = events.join(_bounds(indexed), "ticker").withColumn("_day", F.least(F.date_add("event_date", F.col("after_close").cast("int") - 1), "_last"))
    calendar = backward_calendar(indexed).select("ticker", "_day", F.col("session_date").alias("known_date"), F.col("close").alias("known_close"), F.col("session_index").alias("known_index"), *carried)
    return wanted.join(calendar, ["ticker", "_day"]).drop("_day", "_first", "_last")


def last_bar_at(events: DataFrame, bars: DataFrame, horizons: tuple[int, ...] = (1, 3, 5)) -> DataFrame:
    """Events with price_at_event of the last bar with bar_time <= event_time, and returns by number of bars ahead.

    This form takes a daily bar stamped at midnight as known all day: it is not point in time; known_session is.
    events: event_id, ticker, event_time; bars: ticker, bar_time, close.
    """
    order = Window.partitionBy("ticker").orderBy("bar_time")
    ahead = [F.lead("close", h).over(order).alias(f"_c{h}") for h in horizons]
    bars = bars.select("ticker", "bar_time", F.col("close").alias("_close"), *ahead, F.to_date("bar_time").alias("_date"))
    later = F.lead("_date").over(order)
    same = events.withColumn("_date", F.to_date("event_time")).join(bars, ["ticker", "_date"]).filter(F.col("bar_time") <= F.col("event_time"))
    best = F.max_by(F.struct("_close", *[f"_c{h}" for h in horizons]), "bar_time").alias("hit")
    same = same.groupBy("event_id", "ticker", "event_time").agg(best)
    last = bars.withColumn("_later", later).filter(F.col("_later").isNull() | (F.col("_later") > F.col("_date")))
    bounds = bars.groupBy("ticker").agg(F.max("_date").alias("_last"))
    days = last.select("ticker", F.explode(F.sequence(F.date_add("_date", 1), F.coalesce("_later", F.date_add("_date", 1)))).alias("_day"), F.struct("_close", *[f"_c{h}" for h in horizons]).alias("hit"))
    rest = events.join(same.select("event_id", "ticker", "event_time"), ["event_id", "ticker", "event_time"], "left_anti").join(bounds, "ticker")
    earlier = rest.withColumn("_day", F.least(F.to_date("event_time"), F.date_add("_last", 1))).join(days, ["ticker", "_day"]).select("event_id", "ticker", "event_time", "hit")
    both = same.unionByName(earlier)
    base = F.nullif(F.col("hit._close"), F.lit(0.0))
    return both.select("event_id", "ticker", "event_time", F.col("hit._close").alias("price_at_event"), *[(F.try_divide(F.col(f"hit._c{h}"), base) - 1).alias(f"return_{h}session") for h in horizons])


def with_known_features(events: DataFrame, features: DataFrame, columns: list[str]) -> DataFrame:
    """Events with features of the last session whose close was known; null where there is none yet.

    An inexact time counts as before the close. features: ticker, session_date, close and the columns, one row per session.
    """
    from tidemark.operators.market import indexed

    exact = F.col("published_precision").eqNullSafe("timestamp") & F.col("after_close")
    own = known_session(events.select("event_id", "ticker", "event_date", exact.alias("after_close")), indexed(features), *columns)
    return events.join(own.select("event_id", "ticker", "known_date", *columns), ["event_id", "ticker"], "left")
