"""Operator 10: quality rules with cutoffs that are certified to reject few good documents. Built-in functions only.

Method: each rule is a measure of the text and a cutoff. On labelled documents the cutoffs of a fixed grid are tested in every
stratum (a language): the exact binomial (Clopper-Pearson) upper bound of the share of good documents that a cutoff rejects must
stay under ALPHA / number of rules. Multiple tests: strata and rules share DELTA (Bonferroni); the cutoffs of one rule and stratum
are tested in a fixed sequence from the loosest inward, each at the full level, up to the first that fails, which needs no
correction. So with probability 1 - DELTA no stratum loses more than ALPHA of its good documents. Among certified cutoffs the one
that rejects most bad labelled documents is used, if it rejects surely more of the bad than of the good; a stratum with too few
labels (least_labels) has no cutoff.

Plan: the measures are array expressions over one row, without a shuffle of texts; labels meet only the measures. What comes
to the driver is the table of counts per stratum, rule and grid step, of strata that have enough good labels for any bound to
hold (over a thousand each with four strata, so that they are few beside the labels). The cutoffs meet the measures as a table.

Defined results: a null or empty text has 0 words and fails the base; a null stratum is a stratum of its own; several labels of
one document: it counts as good only if all say so; documents without an id have no label. Input columns named as added ones
are replaced. Repeated rows are measured each; an empty table gives an empty one; very long texts are whole arrays of one row.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import SPACE_CLASS, free_name, sized, staged, table, without

#: Share of good documents that may be rejected in a stratum, and the chance that any bound fails.
ALPHA, DELTA = 0.02, 0.05
#: Steps of the grid of cutoffs.
STEPS = 64
#: The part of a binomial tail that may be left out, and the terms that are added at once.
TAIL_PART, TERMS = 1e-13, 4096
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Rule: its measure from the base counts (larger is worse) and the largest cutoff of the grid.
RULES = {
    "symbols": (lambda c: c("n_symbols") / F.greatest(c("word_chars"), F.lit(1)), 0.64),
    "dup_lines": (lambda c: 100 * c("n_dup_lines") / F.greatest(c("n_words"), F.lit(1)), 6.4),
    "repeats": (lambda c: c("n_repeat_words") / F.greatest(c("n_words"), F.lit(1)), 0.64),
    "long_words": (lambda c: c("word_chars") / F.greatest(c("n_words"), F.lit(1)) - 3, 12.8),
}


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """df without its text, with the five base counts."""
    words_col, grams_col, twice_col = (free_name(df, c) for c in ("words_array", "grams_array", "twice_array"))
    keep = [F.col(f"`{c}`") for c in without(df, [*MEASURES, text_col])]
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    one = df.select(
        *keep,
        F.filter(F.split(text, SPACE_CLASS, -1), lambda x: x != "").alias(words_col),
        (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
        lines.alias(grams_col),
    )
    n, w = F.size(words_col), F.col(words_col)
    starts = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    gram = F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    two = one.select(
        *keep, "n_symbols", "word_chars", n.cast("long").alias("n_words"),
        (F.size(grams_col) - F.size(F.array_distinct(grams_col))).cast("long").alias("n_dup_lines"),
        F.sort_array(gram).alias(grams_col),
    )
    # neighbours in the order of the hash: both windows of an equal pair are repeated
    pairs = F.zip_with(F.col(grams_col), F.slice(grams_col, 2, F.greatest(F.size(grams_col), F.lit(1))), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    three = two.select(
        *keep, *MEASURES[:4],
        F.array_sort(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull())))).alias(twice_col),
    )
    # words that the windows cover: each adds 3, less what the next one shares with it
    at = F.col(twice_col)
    covered = F.aggregate(
        F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.coalesce(F.least(F.lit(3), b - a), F.lit(3))),
        F.lit(0).cast("long"), lambda s, x: s + x,
    )
    return three.select(*keep, *MEASURES[:4], covered.alias("n_repeat_words"))


def base_failed() -> Column:
    n, r = F.col("n_words"), F.col("n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


def log_term(k: int, n: int, p: float) -> float:
    """Log of the chance of exactly k successes in n trials, by deviances: no large logs cancel, however large n is."""

    def rest(x: int) -> float:  # of Stirling's formula
        if x < 16:
            return math.lgamma(x + 1) - (x + 0.5) * math.log(x) + x - 0.5 * math.log(2 * math.pi)
        return (1 / 12 - (1 / 360 - (1 / 1260 - 1 / (1680 * x * x)) / (x * x)) / (x * x)) / x

    def deviance(x: int, mean: float) -> float:
        d = (x - mean) / mean
        return mean * ((1 + d) * math.log1p(d) - d)

    if k == 0 or k == n:
        return n * (math.log(p) if k else math.log1p(-p))
    return rest(n) - rest(k) - rest(n - k) - deviance(k, n * p) - deviance(n - k, n * (1 - p)) + 0.5 * (math.log(n / k) - math.log(2 * math.pi * (n - k)))


def log_tail(k: int, n: int, p: float) -> float:
    """Log of the chance of at most k successes in n trials; what is left out is below TAIL_PART of it, for any n."""
    top = min(k, int((n + 1) * p))  # the largest term; the others fall from there in both directions
    total = 1.0
    for step, end in ((-1, 0), (1, k)):
        at, last = top, 1.0
        while at != end and last * abs(end - at) > TAIL_PART * total:
            i = np.arange(at, at + step * min(TERMS, abs(end - at)), step, dtype=np.float64)
            ratio = i * (1 - p) / ((n - i + 1) * p) if step < 0 else (n - i) * p / ((i + 1) * (1 - p))
            terms = last * np.cumprod(ratio)
            total, last, at = total + float(terms.sum()), float(terms[-1]), at + step * len(i)
    return log_term(top, n, p) + math.log(total)


def upper_bound(k: int, n: int, error: float) -> float:
    """Clopper-Pearson: the largest rate under which at most k of n still has a chance of error."""
    if n == 0 or k >= n:
        return 1.0
    lo, hi = k / n, 1.0
    for _ in range(50):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if log_tail(k, n, min(max(mid, 1e-12), 1 - 1e-12)) > math.log(error) else (lo, mid)
    return hi


def error_of_test(n_strata: int, delta: float) -> float:
    """Chance of error of each stratum and rule; the cutoffs of one are tested in sequence and share it."""
    return delta / max(1, n_strata * len(RULES))


def least_labels(n_strata: int, alpha: float, delta: float) -> int:
    """Good labels without which no bound of a stratum can hold, even if none of them is rejected."""
    return math.ceil(math.log(error_of_test(n_strata, delta)) / math.log1p(-alpha / len(RULES)))


def certified(counts: dict, strata: list, alpha: float, delta: float, n_strata: int | None = None) -> dict:
    """(stratum, rule): cutoff. counts: (stratum, rule, step, good) -> documents whose measure lies above that many cutoffs of the grid.

    n_strata: number of all strata, where those without enough labels were left out.
    """
    error = error_of_test(n_strata or len(strata), delta)
    chosen = {}
    for stratum in strata:
        for rule in RULES:
            over = {good: [counts.get((stratum, rule, s, good), 0) for s in range(STEPS + 1)] for good in (0, 1)}
            n_good, n_bad = sum(over[1]), sum(over[0])
            best = None
            for cut in range(STEPS, 0, -1):  # rejected: a measure over cutoff number cut; the next cutoff rejects no less
                good, bad = sum(over[1][cut:]), sum(over[0][cut:])
                upper = upper_bound(good, n_good, error)
                if upper > alpha / len(RULES):
                    break
                surely = bad and 1 - upper_bound(n_bad - bad, n_bad, error) > upper  # a choice, no part of the guarantee
                if surely and (best is None or bad > best[0]):
                    best = (bad, cut)
            if best:
                chosen[stratum, rule] = best[1]
    return chosen


def quality_verdicts(df: DataFrame, labels: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """df without its text, with the base counts, base_failed, failed_rules and kept."""
    stats = staged(measured(df, text_col), "quality")
    cell = F.coalesce(F.col(f"`{stratum}`").cast("string"), F.lit("")) if stratum in df.columns else F.lit("")
    step = {r: F.least(F.lit(STEPS), F.ceil(f(F.col) * STEPS / top) - 1).cast("int") for r, (f, top) in RULES.items()}
    step = {r: F.greatest(F.lit(0), s) for r, s in step.items()}
    marks = labels.groupBy(F.col(id_col).alias("label_id")).agg(F.min("quality").alias("good")).filter(F.col("good").isNotNull())
    held = staged(stats.filter(~base_failed()).join(marks, F.col(id_col) == F.col("label_id")).select(cell.alias("stratum"), "good", *[s.alias(r) for r, s in step.items()]), "quality-labelled")
    sizes = staged(held.groupBy("stratum").agg(F.count_if(F.col("good") != 0).alias("n")), "quality-strata")
    n_strata = sizes.count()
    fit = sizes.filter(F.col("n") >= least_labels(n_strata, alpha, delta)).select("stratum")
    steps = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES])).alias("x")
    rows = held.join(sized(fit), "stratum", "left_semi").select("stratum", (F.col("good") != 0).cast("int").alias("good"), steps).groupBy("stratum", "x.rule", "x.step", "good").count().collect()
    counts = {(r["stratum"], r["rule"], r["step"], int(r["good"])): r["count"] for r in rows}
    cutoffs = certified(counts, sorted({k[0] for k in counts}), alpha, delta, n_strata)
    added = ["base_failed", "failed_rules", "kept"]
    keep = [F.col(f"`{c}`") for c in without(stats, added)]
    if not cutoffs:
        return stats.select(*keep, base_failed().alias("base_failed"), F.array().cast("array<string>").alias("failed_rules"), (~base_failed()).alias("kept"))
    cell_col, cuts_col = free_name(stats, "cell"), free_name(stats, "cuts")
    rows = [F.struct(F.lit(s).alias(cell_col), F.array(*[F.lit(cutoffs.get((s, r))).cast("int") for r in RULES]).alias(cuts_col)) for s in sorted({s for s, _ in cutoffs})]
    cuts = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    met = stats.withColumn(cell_col, cell).join(sized(cuts), cell_col, "left")
    failed = F.array_compact(F.array(*[F.when(step[r] >= F.get(cuts_col, F.lit(i)), F.lit(r)) for i, r in enumerate(RULES)]))
    out = met.select(*keep, base_failed().alias("base_failed"), failed.alias("failed_rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def op10_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Base counts of every whole document, and whether the base and the certified cutoffs keep it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = quality_verdicts(docs, table(spark, sf_dir, "labels"))
    return out.select("doc_id", *MEASURES, "base_failed", "kept", "failed_rules")
