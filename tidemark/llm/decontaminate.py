"""Operator 4: benchmark items inside documents. Built-in functions only.

Method: MinHash containment search, partitioned by size. Items are put into classes by their number of shingles (powers of
two). Of each item the index holds its smallest shingle hashes, as many as its class needs: a document that contains at least a
share t of an item's n shingles lacks at most (1 - t) n of them, so of any floor((1 - t) n) + 1 it holds one, and the search
misses nothing whatever the document's length. Documents are probed with all their shingles. Candidates are then verified by
the exact intersection of the shingles as text.

Words are runs of letters and digits in lower case; a shingle is five words, or the whole item if it is shorter.

Plan: the index is counted and broadcast only up to a limit, else the probe is a shuffled join; the same holds for the ids of
candidates when they meet the texts. No text is shuffled while the candidates are few.

Defined results: null and empty texts and items without words match nothing; repeated rows of a document or an item give one
pair; a null id of a document or an item is never reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sized, staged, table

WORDS, THRESHOLD = 5, 0.8


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def starts(n: Column, size: int) -> Column:
    return F.when(n >= size, F.sequence(F.lit(0), n - size)).otherwise(F.array().cast("array<int>"))


def hashed(w: Column, size: int) -> Column:
    """Hashes of the shingles of so many words."""
    return F.transform(starts(F.size(w), size), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)]))


def spelled(w: Column, size: int) -> Column:
    """The shingles themselves."""
    return F.transform(starts(F.size(w), size), lambda i: F.concat_ws(" ", *[F.get(w, i + k) for k in range(size)]))


def by_size(sizes: list[int], make) -> Column:
    return F.array_distinct(F.concat(*[make(F.col("w"), s) for s in sizes]))


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, shingle: int = WORDS, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Pairs (id, item) whose document holds at least that share of the item's shingles: n_shared, n_item, containment."""
    item = items.select(F.col(item_col).alias("item"), words(F.col(item_text)).alias("w")).filter(F.col("item").isNotNull() & (F.size("w") > 0))
    item = staged(item.distinct().withColumn("k", F.least(F.lit(shingle), F.size("w"))), "items")
    sizes = sorted(r["k"] for r in item.select("k").distinct().collect()) or [shingle]  # shingle lengths: at most as many as shingle

    def of_item(make) -> Column:
        out = F.array_distinct(make(F.col("w"), shingle))
        for s in range(1, shingle):
            out = F.when(F.col("k") == s, F.array_distinct(make(F.col("w"), s))).otherwise(out)
        return out

    full = item.select("item", of_item(hashed).alias("h"))
    size_class = F.floor(F.log2(F.size("h")))
    depth = F.floor(F.lit(1 - threshold + 1e-9) * (F.pow(F.lit(2.0), size_class + 1) - 1)).cast("int") + 1
    index = staged(full.select("item", F.explode(F.slice(F.sort_array("h"), 1, F.least(depth, F.size("h")))).alias("h")), "item-sketches")

    doc = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).filter(F.col("id").isNotNull() & F.col("t").isNotNull())
    probe = doc.select("id", words(F.col("t")).alias("w")).select("id", F.explode(by_size(sizes, hashed)).alias("h"))
    pairs = staged(probe.join(sized(index), "h").select("id", "item").distinct(), "candidates")

    texts = doc.join(sized(pairs.select("id").distinct()), "id").distinct()
    texts = texts.select("id", words(F.col("t")).alias("w")).select("id", by_size(sizes, spelled).alias("held"))
    wanted = item.select("item", of_item(spelled).alias("wanted"))
    found = pairs.join(texts, "id").join(sized(wanted), "item")
    found = found.select("id", "item", F.size(F.array_intersect("held", "wanted")).cast("long").alias("n_shared"), F.size("wanted").cast("long").alias("n_item"))
    best = found.groupBy("id", "item").agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("m"))
    out = best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), "m.n_shared", "m.n_item", (F.col("m.n_shared") / F.col("m.n_item")).alias("containment"))
    return out.filter(F.col("n_shared") >= F.lit(threshold) * F.col("n_item"))


def op4_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Documents that hold at least 0.8 of the five-word shingles of a benchmark item."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contaminated(docs, table(spark, sf_dir, "benchmark"))


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL
), bs AS (
  SELECT DISTINCT item_id, least(5, len(w)) AS k, unnest(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i : i + least(5, len(w)) - 1], ' '))) AS s FROM b WHERE len(w) > 0
), n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id
), ds AS (
  SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS s FROM d, (SELECT DISTINCT k FROM bs)
)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item)::DOUBLE AS containment
FROM ds JOIN bs USING (k, s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_item)
"""
