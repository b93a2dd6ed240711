"""State by key that is merged where it lies: a table whose files are dealt by a hash of the key.

The table is partitioned by slot (hash of the key modulo the number of buckets) and bucketed by the key into as many buckets, so
a slot is one bucket. A merge reads only the slots that new keys fall into, joins them without a shuffle of the old rows (the new
ones are dealt like the table), and replaces only those slots' folders; all other files stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.lake import settings

Combine = Callable[[dict[str, Column], dict[str, Column], Column, Column], dict[str, Column]]


class KeyedState:
    """A table of the session's catalog with one row per key; a null key is no row."""

    def __init__(self, spark: SparkSession, name: str, key: str, buckets: int = 64):
        self.spark, self.name, self.key, self.buckets = spark, name, key, buckets

    def slot(self) -> Column:
        """The bucket that Spark puts a key into."""
        return F.pmod(F.hash(self.key), F.lit(self.buckets))

    def create(self, df: DataFrame, path: str) -> None:
        """A new table of df at a path."""
        rows = df.filter(F.col(self.key).isNotNull()).withColumn("slot", self.slot()).repartition(self.buckets, self.key)
        rows.write.partitionBy("slot").bucketBy(self.buckets, self.key).sortBy(self.key).option("path", path).saveAsTable(self.name)

    def rows(self) -> DataFrame:
        return self.spark.table(self.name).drop("slot")

    def joined(self, new: DataFrame, slots: list[int], combine: Combine) -> DataFrame:
        """Old rows of some slots and new rows (one per key), combined; columns as in the table."""
        old = self.spark.table(self.name).filter(F.col("slot").isin(slots))
        names = [c for c in old.columns if c not in (self.key, "slot")]
        left = old.select(self.key, *[F.col(c).alias(f"old_{c}") for c in names], F.lit(True).alias("is_old"))
        right = new.select(self.key, *[F.col(c).alias(f"new_{c}") for c in names], F.lit(True).alias("is_new"))
        both = left.hint("merge").join(right, self.key, "full")
        out = combine({c: F.col(f"old_{c}") for c in names}, {c: F.col(f"new_{c}") for c in names}, F.col("is_old").isNotNull(), F.col("is_new").isNotNull())
        kinds = {f.name: f.dataType for f in old.schema}
        return both.select(self.key, *[out[c].cast(kinds[c]).alias(c) for c in names], self.slot().alias("slot"))

    def merge(self, new: DataFrame, combine: Combine) -> list[int]:
        """Merge new rows (one per key) into the table; the slots that were written again, at most one per bucket."""
        new = new.filter(F.col(self.key).isNotNull())
        slots = sorted(r.s for r in new.select(self.slot().alias("s")).distinct().collect())
        if slots:
            with settings(self.spark, **{"spark_sql_sources_partitionOverwriteMode": "dynamic"}):
                self.joined(new, slots, combine).write.insertInto(self.name, overwrite=True)
        return slots

    def replace(self, new: DataFrame) -> list[int]:
        """Insert or replace by key."""
        return self.merge(new, lambda old, fresh, _, is_new: {c: F.when(is_new, fresh[c]).otherwise(old[c]) for c in old})

    def upsert(self, new: DataFrame, arrays: tuple[str, ...] = ("tickers", "rulebased_tickers", "ner_tickers"), plain: str = "rulebased") -> list[int]:
        """Merge rows as state.upserted makes them: the old row's fields stay, arrays are joined in the order of first occurrence,
        the strategy is the new one if it is another than plain, versions add up."""

        def combine(old, fresh, is_old, is_new):
            empty = F.array().cast("array<string>")
            out = {c: F.when(is_old, old[c]).otherwise(fresh[c]) for c in old}
            out |= {c: F.array_distinct(F.concat(F.coalesce(old[c], empty), F.coalesce(fresh[c], empty))) for c in arrays if c in old}
            if "strategy" in old:
                out["strategy"] = F.when(is_new & (~is_old | (fresh["strategy"] != plain)), fresh["strategy"]).otherwise(old["strategy"])
            if "versions" in old:
                out["versions"] = F.coalesce(old["versions"], F.lit(0)) + F.coalesce(fresh["versions"], F.lit(0))
            return out

        return self.merge(new, combine)
