"""Connected components of a table of links, by the smallest id, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized, staged, unstaged


def components(links: DataFrame) -> DataFrame:
    """(id, c) for every id in links (a, b); c is the smallest id that it reaches.

    Each round gives a node the smallest label around it and then that label's own label, so labels travel twice as far each
    time. Labels are written between rounds; it ends when a round changes none.
    """
    both = staged(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    label = staged(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("id"), F.least("a", "b").alias("c")), "labels")
    while True:
        near = both.join(sized(label.select("id", "c")).withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("c").alias("near"))
        new = label.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        new = staged(new, "labels")
        far = sized(new.select(F.col("id").alias("c"), F.col("c").alias("far")))
        after = staged(new.join(far, "c").select("id", "old", F.least("c", "far").alias("c")), "labels")
        unstaged(label, new)
        label = after
        if not label.filter(F.col("c") != F.col("old")).limit(1).count():
            unstaged(both)
            return label.select("id", "c")
