"""Named entities: tokens with places, BIO labels, linking of mentions, and the metrics of spans."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from tidemark.functions.text import mention_key
from tidemark.operators.sides import kept

token = re.compile(r"\w+(?:[.-]\w+)*|[^\w\s]")
SPAN = "array<struct<start: int, end: int>>"


def tokens(text: Column) -> Column:
    """Array of (token, start, end)."""

    @F.pandas_udf(ArrayType(StructType.fromDDL("token string, start int, end int")))
    def cut(s: pd.Series) -> pd.Series:
        return s.map(lambda t: [(m.group(), m.start(), m.end()) for m in token.finditer(t or "")])

    return cut(text)


LONGEST = 20
FORM = "struct<lower: string, last3: string, last2: string, first3: string, is_upper: boolean, is_title: boolean, is_digit: boolean, has_digit: boolean, length: int>"


def form(w: str) -> tuple:
    """A token case-folded, its ends, its case, its digits and its length up to LONGEST."""
    low = w.casefold()
    return low, low[-3:], low[-2:], low[:3], w.upper() == w and w.lower() != w, w.istitle(), w.isdigit(), any(c.isdigit() for c in w), min(len(w), LONGEST)


def forms_of(words: Column) -> Column:
    """The form of each word of an array; each distinct word of a batch is looked at once."""
    names = ["lower", "last3", "last2", "first3", "is_upper", "is_title", "is_digit", "has_digit", "length"]
    types = [pa.string()] * 4 + [pa.bool_()] * 4 + [pa.int32()]

    @F.arrow_udf(f"array<{FORM}>")
    def run(column: pa.Array) -> pa.Array:
        flat = column.flatten().dictionary_encode()
        columns = list(zip(*[form(w) for w in flat.dictionary.to_pylist()], strict=True)) or [()] * len(names)
        distinct = pa.StructArray.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
        ends = np.append(0, np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), distinct.take(flat.indices), mask=column.is_null())

    return run(words)


def token_features(df: DataFrame, words: str, out: str = "features") -> DataFrame:
    """df with an array of what a sequence labeller sees of each token of the array words (as from tokens): the token's form, and
    folded form and case of the neighbours (null at the ends of the text, where first or last is true). A null array gives null."""
    forms, n = free(df, "forms"), F.size(words)
    nothing = F.array(F.lit(None).cast(FORM))
    sides = df.withColumn(forms, forms_of(F.transform(words, lambda t: t["token"])))
    own = F.col(forms)
    zipped = F.arrays_zip(own.alias("own"), F.concat(nothing, F.slice(own, 1, F.greatest(n - 1, F.lit(0)))).alias("back"), F.concat(F.slice(own, 2, F.greatest(n - 1, F.lit(0))), nothing).alias("ahead"))

    def features(z: Column, i: Column) -> Column:
        near = [z[side][c].alias(f"{side}_{c}") for side in ("back", "ahead") for c in ("lower", "is_upper", "is_title")]
        return F.struct(*[z["own"][c].alias(c) for c in ("lower", "last3", "last2", "first3", "is_upper", "is_title", "is_digit", "has_digit", "length")], *near, (i == 0).alias("first"), (i == n - 1).alias("last"))

    return sides.withColumn(out, F.when(n > 0, F.transform(F.slice(zipped, 1, F.greatest(n, F.lit(1))), features)).when(n == 0, F.array())).drop(forms)


def free(df: DataFrame, stem: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    return next(stem + "_" * k for k in range(len(taken) + 1) if stem + "_" * k not in taken)


def bio(words: Column, spans: Column) -> Column:
    """Labels of tokens: the first that overlaps a span begins it, the others are inside."""
    overlaps = lambda t, s: (t["start"] < s["end"]) & (t["end"] > s["start"])

    def label(t: Column) -> Column:
        own = F.filter(spans, lambda s: overlaps(t, s))
        begins = F.exists(own, lambda s: t["start"] == F.array_min(F.transform(F.filter(words, lambda u: overlaps(u, s)), lambda u: u["start"])))
        return F.when(begins, "B-ORG").when(F.size(own) > 0, "I-ORG").otherwise("O")

    return F.transform(words, label)


def ranges(labels: Column) -> Column:
    """Token ranges [start, end) of entities; an inside label without a beginning opens one."""
    n = F.size(labels)
    at = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)))
    before = lambda i: F.coalesce(F.get(labels, i - 1), F.lit("O"))
    opens = lambda i: (F.get(labels, i) == "B-ORG") | ((F.get(labels, i) == "I-ORG") & (before(i) == "O"))
    starts = F.filter(at, opens)
    ends = lambda i: F.coalesce(F.array_min(F.filter(at, lambda j: (j > i) & ((F.get(labels, j) != "I-ORG")))), n)
    return F.when(n > 0, F.transform(starts, lambda i: F.struct(i.alias("start"), ends(i).cast("int").alias("end")))).otherwise(F.array().cast(SPAN))


def span_scores(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    """Micro precision, recall and F1 of entity ranges, to four places; from two label arrays."""
    return range_scores(df.select(ranges(F.col(gold)).alias("g"), ranges(F.col(predicted)).alias("p")), "g", "p")


def range_scores(df: DataFrame, gold: str, predicted: str) -> DataFrame:
    """span_scores of two arrays of ranges."""
    c = df.select(F.col(gold).alias("g"), F.col(predicted).alias("p")).agg(F.sum(F.size(F.array_intersect("g", "p"))).alias("true_positive"), F.sum(F.size(F.array_except("p", "g"))).alias("false_positive"), F.sum(F.size(F.array_except("g", "p"))).alias("false_negative"))
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = (F.col(x) for x in ("true_positive", "false_positive", "false_negative"))
    return c.select(F.round(ratio(tp, tp + fp), 4).alias("precision"), F.round(ratio(tp, tp + fn), 4).alias("recall"), F.round(ratio(2 * tp, 2 * tp + fp + fn), 4).alias("f1"), tp, fp, fn)


def mention_table(spans: DataFrame) -> DataFrame:
    """Most common ticker of each normalised mention; ties go to the one seen first. spans: mention, ticker, seen (order)."""
    n = spans.withColumn("key", mention_key(F.col("mention"))).filter(F.col("key") != "").groupBy("key", "ticker").agg(F.count("*").alias("n"), F.min("seen").alias("first"))
    return n.groupBy("key").agg(F.max_by("ticker", F.struct(F.col("n"), -F.col("first"))).alias("ticker"))


def indel(a: str, b: str) -> float:
    """Similarity in per cent by insertions and deletions: twice the longest common subsequence over both lengths."""
    if not a and not b:
        return 100.0
    places: dict[str, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = open_ = (1 << len(a)) - 1  # one row of the table as bits: those that are 0 are steps of the subsequence
    for y in b:
        met = open_ & places.get(y, 0)
        open_ = (open_ + met | open_ - met) & full
    return 200.0 * (len(a) - open_.bit_count()) / (len(a) + len(b))


def linked(mentions: DataFrame, known: DataFrame, aliases: DataFrame, cutoff: float = 90.0) -> DataFrame:
    """mentions (mention, ...) with ticker and link_confidence: an exact known mention, else an exact alias, else the nearest at
    cutoff per cent for keys of three characters or more.

    known and aliases: key, ticker. Exact links are joins. So are those of names that differ from a key by one character put in
    or left out, which no other name can beat: such pairs are equal once each character in turn is left out of one of them. For
    the keys that have none candidates share one of the key's rarest pairs of letters: a key that reaches the cutoff differs from
    a name by at most so many insertions and deletions, each of which undoes two pairs, so of one pair more than that some are
    left. Lengths must allow the cutoff too. For cutoffs under about 65 that is all pairs of the key, and names that share none
    are not compared. Ties go to known mentions before aliases, then to the smallest name.
    """
    m = mentions.withColumn("key", mention_key(F.col("mention")))
    exact = m.join(known.select("key", F.col("ticker").alias("_t1")).dropDuplicates(["key"]), "key", "left").join(aliases.select("key", F.col("ticker").alias("_t2")).dropDuplicates(["key"]), "key", "left")
    exact = exact.withColumn("_t", F.coalesce("_t1", "_t2")).drop("_t1", "_t2")
    names = known.select("key", "ticker", F.lit(0).alias("turn")).unionByName(aliases.select("key", "ticker", F.lit(1).alias("turn"))).groupBy("key").agg(F.min_by("ticker", "turn").alias("ticker"), F.min("turn").alias("turn"))
    grams = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: F.substr(c, i, F.lit(2))))
    open_keys = exact.filter(F.col("_t").isNull() & (F.length("key") >= 3)).select("key").distinct()
    less = lambda c: F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(F.left(c, i - 1), F.substr(c, i + 1))))
    named = names.select(F.col("key").alias("name"), "ticker", F.col("turn").alias("list"))
    pair = ["key", "name", "ticker", "list"]
    longer = open_keys.select("key", F.explode(less(F.col("key"))).alias("name")).join(named.hint("merge"), "name").select(*pair)
    shorter = named.filter(F.length("name") > 0).select("*", F.explode(less(F.col("name"))).alias("key")).join(open_keys.hint("merge"), "key").select(*pair)
    same = open_keys.withColumn("name", F.col("key")).join(named.hint("merge"), "name").select(*pair)
    close = longer.unionByName(shorter).unionByName(same)

    def scored(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in parts:
            p["score"] = [indel(a, b) for a, b in zip(p["key"], p["name"], strict=True)]
            yield p[p["score"] >= cutoff]

    kind = names.schema["ticker"].dataType.simpleString()

    def nearest(pairs: DataFrame) -> DataFrame:
        found = pairs.mapInPandas(scored, f"key string, name string, ticker {kind}, list int, score double")
        return found.groupBy("key").agg(F.min_by(F.struct("ticker", "score"), F.struct(-F.col("score"), "list", "name")).alias("b"))

    won = kept(nearest(close), "nearest-names")
    right = names.select(F.col("key").alias("name"), "ticker", F.col("turn").alias("list"), F.explode(grams(F.col("key"))).alias("g"))
    common = right.groupBy("g").agg(F.count("*").alias("c"))  # keys have 37 characters, so at most 37 * 37 rows
    edits = F.floor((1 - cutoff / 100) * 2 * F.length("key") / (cutoff / 100) + 1e-9)
    rarest = Window.partitionBy("key").orderBy(F.coalesce("c", F.lit(0)), "g")
    rest = open_keys.join(won.select("key").hint("merge"), "key", "left_anti")
    left = rest.select("key", F.explode(grams(F.col("key"))).alias("g")).join(F.broadcast(common), "g", "left")
    left = left.withColumn("turn", F.row_number().over(rarest)).filter(F.col("turn") <= 2 * edits + 1).select("key", "g")
    near = left.join(right, "g").filter(2 * F.least(F.length("key"), F.length("name")) >= cutoff / 100 * (F.length("key") + F.length("name"))).select("key", "name", "ticker", "list").distinct()
    out = exact.join(won.unionByName(nearest(near)), "key", "left")
    return out.withColumns({"ticker": F.coalesce("_t", "b.ticker"), "link_confidence": F.round(F.when(F.col("_t").isNotNull(), 1.0).otherwise(F.coalesce(F.col("b.score") / 100, F.lit(0.0))), 3)}).drop("_t", "b")
