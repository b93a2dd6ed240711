"""Exact quantiles of groups of any size.

A quantile between two ranks is interpolated, as by `percentile`, which however keeps every distinct value of a group in one
buffer. Here ranks are sought by ranges: a range that holds a wanted rank is cut at approximate quantiles (a sketch of fixed
size), its rows are counted between the cuts, and only the parts that hold wanted ranks are cut again. A part is done when it holds
one value, however often, or at most LEAF rows, which are then sorted. No task holds more than such a part.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sides import kept, sized

LEAF, CUTS = 10_000, 64


def quantiles(df: DataFrame, value: Column | str, at: dict[str, float], by: list[str] | None = None) -> DataFrame:
    """A row for each group that has a value: the columns by and a double for each name and fraction of at. Nulls do not count; NaN
    is the largest value."""
    by = by or []
    keys = [f"g{i}" for i in range(len(by))]
    v = (F.col(value) if isinstance(value, str) else value).cast("double")
    rows = df.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)], v.alias("v")).filter("v is not null")
    spots = F.array(*[F.lit(p) for p in at.values()])
    ranks = lambda n: F.array_distinct(F.flatten(F.transform(spots, lambda p: F.array(F.floor(p * (n - 1)), F.ceil(p * (n - 1))))))
    groups = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")).filter("n > 0")
    groups = kept(groups, "groups")
    # A range: its group, values from low to high, how many values lie below it, how many in it, and the ranks wanted of it.
    open_, done = groups.select(*keys, "low", "high", F.lit(0).cast("long").alias("below"), F.col("n").alias("held"), ranks(F.col("n")).alias("ranks")), []
    while True:
        ready = (F.col("held") <= LEAF) | (F.col("low") == F.col("high"))
        done.append(open_.filter(ready))
        open_ = open_.filter(~ready)
        if open_.isEmpty():
            break
        open_ = parts_of(rows, open_, keys)
    found = values_of(rows, reduce(DataFrame.unionByName, done), keys)
    grouped = found.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("rank", "v"))).alias("m"))
    out = met(groups.select(*keys, "n"), grouped, keys)
    place = lambda p: p * (F.col("n") - 1)
    value_at = lambda r: F.element_at("m", r)

    def between(p: float) -> Column:
        low, high = value_at(F.floor(place(F.lit(p)))), value_at(F.ceil(place(F.lit(p))))
        share = place(F.lit(p)) - F.floor(place(F.lit(p)))
        return F.when(low == high, low).otherwise(low + (high - low) * share)

    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], *[between(p).alias(name) for name, p in at.items()])


def met(left: DataFrame, right: DataFrame, keys: list[str], *more: Column) -> DataFrame:
    """Inner join of two tables by keys, null with null; without keys all rows meet (one side is then a handful of ranges)."""
    renamed = right.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys] + list(more)
    side = sized(renamed) if keys else F.broadcast(renamed)
    joined = left.join(side, reduce(Column.__and__, on)) if on else left.crossJoin(side)
    return joined.drop(*[f"_{k}" for k in keys])


def inside(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    return met(rows, ranges, keys, F.col("v").between(F.col("low"), F.col("high")))


def parts_of(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of ranges that hold wanted ranks, as ranges; bounds are values that occur. The cuts are written, because a sketch
    may differ when it is made again."""
    name = [*keys, "low", "high"]
    inner = [i / CUTS for i in range(1, CUTS)]
    cuts = inside(rows, ranges.select(*name), keys).groupBy(*name).agg(F.array_distinct(F.percentile_approx("v", inner, 10 * CUTS)).alias("cuts"))
    cut = met(ranges, cuts.select(*keys, F.col("low").alias("_low"), F.col("high").alias("_high"), "cuts"), keys, F.col("low") == F.col("_low"), F.col("high") == F.col("_high")).drop("_low", "_high")
    cut = kept(cut, "cuts")
    # Below the first cut, at a cut, or between it and the next: even numbers hold one value.
    steps = F.size(F.filter("cuts", lambda c: c < F.col("v"))) + F.size(F.filter("cuts", lambda c: c <= F.col("v")))
    dealt = inside(rows, cut.select(*name, "cuts"), keys).select(*name, "v", steps.alias("part"))
    counts = dealt.groupBy(*name, "part").agg(F.count("*").alias("held"), F.min("v").alias("from"), F.max("v").alias("to"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy(*name).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumn("before", before).select(*keys, F.col("low").alias("_low"), F.col("high").alias("_high"), "held", "from", "to", "before")
    parts = met(ranges.drop("held"), counts, keys, F.col("low") == F.col("_low"), F.col("high") == F.col("_high"))
    parts = parts.select(*keys, F.col("from").alias("low"), F.col("to").alias("high"), (F.col("below") + F.col("before")).alias("start"), "held", "ranks")
    wanted = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("held")))
    return kept(parts.select(*keys, "low", "high", F.col("start").alias("below"), "held", wanted.alias("ranks")).filter(F.size("ranks") > 0), "parts")


def values_of(rows: DataFrame, ranges: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, rank, v) of the wanted ranks of ranges that are done."""
    one = ranges.filter("low = high").select(*keys, F.explode("ranks").alias("rank"), F.col("low").alias("v"))
    few = inside(rows, ranges.filter("low <> high"), keys).groupBy(*keys, "low", "high", "below", "ranks").agg(F.array_sort(F.collect_list("v")).alias("s"))
    few = few.select(*keys, F.explode("ranks").alias("rank"), "below", "s").select(*keys, "rank", F.get("s", (F.col("rank") - F.col("below")).cast("int")).alias("v"))
    return one.unionByName(few)
