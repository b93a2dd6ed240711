"""Training targets, splits, history features and leakage audits, all point in time."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.text import growth
from tidemark.operators.market import indexed
from tidemark.operators.sessions import known_session, reaction_session
from tidemark.operators.sides import sized

# Horizon, sessions after the first one past the event's day (None: that day itself), and label threshold.
HORIZONS = {"t0": (None, 0.010), "t1": (0, 0.010), "t3": (2, 0.015), "t5": (4, 0.020)}
JUMP = 0.10
MASKED = -100


def flagged(bars: DataFrame, jump: float = JUMP) -> DataFrame:
    """Numbered sessions with the running count of abnormal moves, so that a span's count is a difference."""
    out = indexed(bars).withColumn("jump", (F.abs("daily_return") > jump) & F.col("daily_return").isNotNull())
    run = Window.partitionBy("ticker").orderBy("session_index").rowsBetween(Window.unboundedPreceding, 0)
    return out.withColumn("jumps", F.sum(F.col("jump").cast("int")).over(run))


def three_way(value: Column, threshold: Column) -> Column:
    return F.when(value <= -threshold, 0).when(value >= threshold, 2).otherwise(1)


def targets_long(events: DataFrame, bars: DataFrame, jump: float = JUMP) -> DataFrame:
    """One row per event, ticker and horizon: stock_return, label (0 down, 1 neutral, 2 up, -100 masked) and mask.

    The anchor is the last close known at the event: the same day's only after the close and with an exact time. The first
    session past the event's day is number i; horizons t1, t3, t5 are i, i+2, i+4; t0 is the event's own session, only with an
    exact time before the close. A target is masked without anchor or target close, or with an abnormal move at the anchor or
    from there to the target. events: event_id, ticker, event_date, after_close, published_precision.
    """
    key = ["event_id", "ticker"]
    sessions = flagged(bars, jump)
    exact = F.col("published_precision").eqNullSafe("timestamp")
    base = events.select(*key, "event_date", (exact & F.col("after_close")).alias("after_close"), (exact & ~F.col("after_close")).alias("intraday"))
    known = known_session(base, sessions).select(*key, "known_index")
    first = reaction_session(base.withColumn("after_close", F.lit(True)), sessions).select(*key, "t0_index")
    wanted = F.array(*[F.struct(F.lit(h).alias("horizon"), (F.lit(None).cast("int") if o is None else F.lit(o)).alias("ahead"), F.lit(t).alias("threshold")) for h, (o, t) in HORIZONS.items()])
    rows = base.join(known, key, "left").join(first, key, "left").withColumn("w", F.explode(wanted)).select("*", "w.*").drop("w")
    firsts = sessions.filter(F.col("anchor_date").isNull() | (F.col("anchor_date") < F.col("session_date")))  # of a date
    own = firsts.select("ticker", F.col("session_date").alias("event_date"), F.col("session_index").alias("own_index"))
    rows = rows.join(own, ["ticker", "event_date"], "left").withColumn("target_index", F.when(F.col("ahead").isNull(), F.when(F.col("intraday"), F.col("own_index"))).otherwise(F.col("t0_index") + F.col("ahead")))
    at = lambda i, c, j, g: sessions.select("ticker", F.col("session_index").alias(i), F.col("close").alias(c), F.col("jumps").alias(j), F.col("jump").alias(g))
    rows = rows.join(at("known_index", "_a", "_ja", "_ga"), ["ticker", "known_index"], "left").join(at("target_index", "_b", "_jb", "_gb"), ["ticker", "target_index"], "left")
    mask = F.coalesce(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("_ga") & (F.col("_jb") == F.col("_ja")), F.lit(False))
    value = F.when(mask, growth(F.col("_b"), F.col("_a")))
    return rows.select(*key, "event_date", "horizon", value.alias("stock_return"), F.when(mask, three_way(value, F.col("threshold"))).otherwise(MASKED).alias("label"), mask.alias("mask"))


def targets_wide(long: DataFrame) -> DataFrame:
    """One row per event and ticker with stock_return_h, label_h and mask_h."""
    pick = lambda h, c: F.max(F.when(F.col("horizon") == h, F.col(c))).alias(f"{c}_{h}")
    return long.groupBy("event_id", "ticker", "event_date").agg(*[pick(h, c) for h in HORIZONS for c in ("stock_return", "label", "mask")])


def direction(value: Column, mask: Column) -> Column:
    """1 up, 0 down; null where masked or unchanged."""
    return F.when(mask & (value > 0), 1).when(mask & (value < 0), 0)


def eligible(split: Column, wanted: str, mask: Column, value: Column) -> Column:
    """Whether a row enters the measures of a split: of that split, not masked, with a return that is known and not 0."""
    return F.coalesce((split == wanted) & mask & value.isNotNull() & (value != 0), F.lit(False))


def temporal_split(date: Column, train_until: str, validation_until: str) -> Column:
    return F.when(date <= F.lit(train_until).cast("date"), "train").when(date <= F.lit(validation_until).cast("date"), "validation").when(date.isNotNull(), "test")


def walk_forward(df: DataFrame, date: str, cuts: list[str], embargo_days: int = 0) -> DataFrame:
    """Rows once per fold in which they are used: train up to the cut less the embargo, test up to the next cut."""
    folds = F.array(*[F.struct(F.lit(i).alias("fold"), F.lit(a).cast("date").alias("cut"), F.lit(b).cast("date").alias("end")) for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))])
    out = df.withColumn("f", F.explode(folds))
    part = F.when(F.col(date) <= F.date_sub("f.cut", embargo_days), "train").when((F.col(date) > F.col("f.cut")) & (F.col(date) <= F.col("f.end")), "test")
    return out.withColumns({"fold": F.col("f.fold"), "part": part}).drop("f").filter(F.col("part").isNotNull())


def leaks(df: DataFrame, split: str, keys: list[str]) -> DataFrame:
    """Values of each key that occur in more than one split: key, values, rows."""
    long = df.select(split, F.explode(F.map_from_arrays(F.array(*[F.lit(k) for k in keys]), F.array(*[F.col(k).cast("string") for k in keys]))).alias("key", "value")).filter(F.col("value").isNotNull())
    per = long.groupBy("key", "value").agg(F.count_distinct(split).alias("s"), F.count("*").alias("n"))
    return per.groupBy("key").agg(F.count_if(F.col("s") > 1).alias("shared_values"), F.sum(F.when(F.col("s") > 1, F.col("n")).otherwise(0)).alias("shared_rows"))


def grouped_split(df: DataFrame, split: str, group: str, order: tuple[str, ...] = ("train", "validation", "test")) -> DataFrame:
    """Rows of a group that reaches into an earlier split leave the later ones."""
    rank = F.array_position(F.array(*[F.lit(s) for s in order]), F.col(split))
    first = df.withColumn("_rank", rank).groupBy(group).agg(F.min("_rank").alias("_first"))
    return df.withColumn("_rank", rank).join(first, group, "left").filter(F.col(group).isNull() | (F.col("_rank") == F.col("_first"))).drop("_rank", "_first")


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Rows / (classes x rows of the class)."""
    n = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    return n.crossJoin(F.broadcast(n.agg(F.sum("n").alias("_all"), F.count("*").alias("_k")))).select(label, "n", (F.col("_all") / (F.col("_k") * F.col("n"))).alias("weight"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


#: Angles are exact to this: near 0 and a half turn a cosine's last digit is some 1e-8 of an angle.
SLACK = 1e-6
#: Rows of one ticker and block that a task compares with; a block of more is dealt out over several.
SHARE = 2_000


def pivot_vectors(df: DataFrame, n: int) -> list[list[float]]:
    """Unit vectors of n rows, those with the smallest hashes of their ids; equal rows are pivots once."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    found = df.withColumn("_n", norm).filter((F.col("_n") > 0) & (F.col("_n") < float("inf")))
    unit = F.transform("vector", lambda x: x.cast("double") / F.col("_n"))
    rows = found.orderBy(F.xxhash64("id"), "id").limit(n).select(unit.alias("v")).collect()
    return [list(v) for v in dict.fromkeys(tuple(r["v"]) for r in rows)]


def near_pairs(df: DataFrame, days: int, low: float, high: float, pivots: int, share: int) -> DataFrame:
    """Rows with the rows of their ticker of 1 to days days before, and `possible`: whether angles to pivots leave room for a
    cosine in [low, high].

    The angle of two vectors lies between the difference of their angles to a pivot and the sum of these (or what the sum lacks
    to a full turn), so pairs are told apart by a few numbers of each row. Days are cut into blocks of that length: a row meets
    two blocks by an equi-join. A block of more than share rows of a ticker is dealt out by a hash, and rows meet each part.
    """
    fixed = pivot_vectors(df, pivots)
    names = [f"_a{i}" for i in range(len(fixed))]
    to = lambda p: cosine(F.col("vector"), F.array(*map(F.lit, p)))
    angle = lambda p: F.when(to(p).isNotNull(), F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), to(p)))))  # null: another length
    rows = df.select("ticker", "id", "day", "vector", F.floor(F.col("day") / days).alias("block"), *[angle(p).alias(c) for p, c in zip(fixed, names, strict=True)])
    hot = rows.groupBy("ticker", "block").agg(F.count("*").alias("_n")).filter(F.col("_n") > share)
    hot = sized(hot.select("ticker", "block", F.ceil(F.col("_n") / share).alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1)).cast("int")
    past = rows.join(hot, ["ticker", "block"], "left").withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int")).drop("_parts")
    past = past.withColumnsRenamed({c: f"past_{c}" for c in ("id", "day", "vector", *names)})
    now = rows.withColumn("block", F.explode(F.array("block", F.col("block") - 1))).join(hot, ["ticker", "block"], "left")
    now = now.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_parts")
    near = now.join(past, ["ticker", "block", "part"]).filter((F.col("past_day") < F.col("day")) & (F.col("past_day") >= F.col("day") - days))
    possible = F.lit(True)
    for c in names:
        a, b = F.col(c), F.col(f"past_{c}")
        inside = (F.abs(a - b) <= math.acos(low) + SLACK) & (F.least(a + b, 2 * math.pi - a - b) >= math.acos(high) - SLACK)
        possible = possible & F.coalesce(inside, F.lit(True))
    return near.withColumn("possible", possible).drop(*names, *[f"past_{c}" for c in names], "block", "part")


def history(df: DataFrame, days: int = 14, low: float = 0.30, high: float = 0.85, top: int = 5, pivots: int = 6, share: int = SHARE) -> DataFrame:
    """Up to top earlier rows of the same ticker, 1 to days days back, with a cosine in [low, high]; the most similar first.

    df: id, ticker, day (int), vector. Cosines are taken of pairs only that near_pairs holds possible.
    """
    near = near_pairs(df, days, low, high, pivots, share).filter("possible")
    near = near.select("ticker", "id", "day", "past_id", "past_day", cosine(F.col("vector"), F.col("past_vector")).alias("similarity")).filter(F.col("similarity").between(low, high))
    order = Window.partitionBy("id", "ticker").orderBy(F.desc("similarity"), "past_id")
    return near.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def history_pairs(df: DataFrame, days: int = 14, low: float = 0.30, high: float = 0.85, pivots: int = 6, share: int = SHARE) -> DataFrame:
    """One row: pairs within the days, those whose cosine is taken, and those with a cosine in [low, high]."""
    near = near_pairs(df, days, low, high, pivots, share)
    inside = F.when(F.col("possible"), cosine(F.col("vector"), F.col("past_vector"))).between(low, high)
    return near.agg(F.count("*").alias("pairs"), F.count_if("possible").alias("looked_at"), F.count_if(inside).alias("in_range"))


def history_features(df: DataFrame, **kw) -> DataFrame:
    """Per row: whether there is history, how much, days since the last, mean and largest similarity."""
    h = history(df, **kw).groupBy("id", "ticker").agg(F.count("*").alias("history_count"), F.min(F.col("day") - F.col("past_day")).alias("days_since_last_history"), F.avg("similarity").alias("history_mean_similarity"), F.max("similarity").alias("history_max_similarity"))
    out = df.select("id", "ticker").join(h, ["id", "ticker"], "left")
    return out.withColumns({"history_count": F.coalesce("history_count", F.lit(0)), "history_available": F.col("history_count").isNotNull().cast("int")})


def history_pooled(df: DataFrame, **kw) -> DataFrame:
    """Similarity-weighted mean of the vectors of a row's history, by place in the vector."""
    h = history(df, **kw).select("id", "ticker", "past_id", "similarity").join(df.select(F.col("id").alias("past_id"), "vector"), "past_id")
    long = h.select("id", "ticker", "similarity", F.posexplode("vector").alias("place", "x"))
    means = long.groupBy("id", "ticker", "place").agg((F.sum(F.col("x") * F.col("similarity")) / F.sum("similarity")).alias("m"))
    return means.groupBy("id", "ticker").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "m"))), lambda p: p["m"]).alias("pooled"))
