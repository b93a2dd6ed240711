"""Classification metrics, linear prediction, permutation importance and the baseline model."""

from __future__ import annotations

import math
import random

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sides import kept


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(F.count("*").alias("n"))


def per_class(df: DataFrame, label: str, prediction: str, classes: tuple = (0, 1)) -> DataFrame:
    """precision, recall, f1 and support of each class; 0 where undefined."""
    counts = [(F.count_if((F.col(label) == k) & (F.col(prediction) == k)), F.count_if(F.col(prediction) == k), F.count_if(F.col(label) == k)) for k in classes]
    one = df.agg(*[c.alias(f"{n}{i}") for i, triple in enumerate(counts) for n, c in zip("tpl", triple, strict=True)])
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    rows = F.array(*[F.struct(F.lit(k).alias("class"), ratio(F.col(f"t{i}"), F.col(f"p{i}")).alias("precision"), ratio(F.col(f"t{i}"), F.col(f"l{i}")).alias("recall"), ratio(2 * F.col(f"t{i}"), F.col(f"p{i}") + F.col(f"l{i}")).alias("f1"), F.col(f"l{i}").alias("support")) for i, k in enumerate(classes)])
    return one.select(F.explode(rows).alias("r")).select("r.*")


def scores(df: DataFrame, label: str, prediction: str, classes: tuple = (0, 1)) -> DataFrame:
    """One row: accuracy, macro and weighted F1, balanced accuracy, accuracy of always saying the largest class."""
    k = per_class(df, label, prediction, classes)
    total = k.agg(F.avg("f1").alias("macro_f1"), F.try_divide(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"), F.avg("recall").alias("balanced_accuracy"), F.try_divide(F.max("support"), F.sum("support")).alias("majority_accuracy"))
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"), F.count("*").alias("n")).crossJoin(total)


def ranking_scores(df: DataFrame, label: str, score: str, parts: int = 64) -> DataFrame:
    """One row: Brier score, ROC-AUC and PR-AUC, ties taken together.

    Running counts need the order of scores: they are cut into parts at approximate quantiles, counted in each, and run inside
    a part from what the parts above hold, so that no task has all scores.
    """
    per = df.groupBy(F.col(score).alias("s")).agg(F.sum(label).cast("double").alias("p"), F.count("*").cast("double").alias("m"))
    cuts = per.agg(F.percentile_approx("s", [i / parts for i in range(1, parts)]).alias("cuts"))
    per = per.crossJoin(F.broadcast(cuts)).withColumn("part", F.size(F.filter("cuts", lambda c: c < F.col("s")))).drop("cuts")
    above = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)  # one row for each part
    start = per.groupBy("part").agg(F.sum("p").alias("p"), F.sum("m").alias("m")).select("part", *[F.coalesce(F.sum(c).over(above), F.lit(0.0)).alias(f"{c}0") for c in ("p", "m")])
    inside = Window.partitionBy("part").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    run = per.join(F.broadcast(start), "part").withColumns({"tp": F.col("p0") + F.sum("p").over(inside), "seen": F.col("m0") + F.sum("m").over(inside)})
    total = df.agg(F.sum(label).cast("double").alias("positive"), F.count("*").cast("double").alias("total"), F.avg(F.pow(F.col(score) - F.col(label), 2)).alias("brier"))
    pairs = F.nullif(F.col("positive") * (F.col("total") - F.col("positive")), F.lit(0.0))
    return run.crossJoin(F.broadcast(total)).agg(
        F.first("brier").alias("brier"),
        (F.sum((F.col("m") - F.col("p")) * (F.col("tp") - F.col("p") / 2)) / F.first(pairs)).alias("roc_auc"),
        F.sum(F.col("p") / F.nullif(F.col("positive"), F.lit(0.0)) * F.col("tp") / F.col("seen")).alias("pr_auc"),
    )


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def linear_prediction(features: Column, weights: list[list[float]], intercepts: list[float]) -> Column:
    """Index of the largest of W x + b; the first on ties."""
    z = F.array(*[dot(features, F.array(*[F.lit(float(w)) for w in row])) + float(b) for row, b in zip(weights, intercepts, strict=True)])
    return (F.array_position(z, F.array_max(z)) - 1).cast("int")


def numbered(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """df with `number`, 0 to n - 1 in the order of a seeded hash of key: by the counts of 1,024 ranges of hashes, so no task
    sorts the whole."""
    rows = df.withColumn("_h", F.xxhash64(key, F.lit(seed))).withColumn("_range", F.shiftright("_h", 54))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_m"))  # at most 1,024 rows
    sizes = sizes.select("_range", (F.sum("_m").over(Window.orderBy("_range")) - F.col("_m")).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy("_h", key))
    return rows.withColumn("_place", place).join(F.broadcast(sizes), "_range").withColumn("number", F.col("_start") + F.col("_place") - 1).drop("_h", "_range", "_place", "_start")


def permutation_importance(df: DataFrame, groups: dict[str, list[str]], predict, label: str, repeats: int = 30, seed: int = 42) -> DataFrame:
    """Mean and deviation of the drop of macro-F1 and accuracy when the columns of a group are permuted together.

    df: id, label and feature columns; predict maps a function from name to Column to the prediction. Rows get numbers in the
    order of a hash, once. In a run, row i gives its values of the group's columns to row (a i + c) mod n, with a and c drawn
    for the run and a prime to n: a bijection, so each value is used once. Rows stay where their number puts them and only the
    permuted columns travel; all groups and repeats are one join. It is a merge join: the planner takes the values sent, of which
    there are groups x repeats for each row, for as few as the rows and would broadcast them.
    """
    columns = sorted({c for cols in groups.values() for c in cols})
    rows = kept(numbered(df.select("id", F.col(label).alias("y"), *columns), "id", seed), "importance-rows")
    n, rnd = max(rows.count(), 1), random.Random(seed)
    factors = lambda: next(a for a in iter(lambda: rnd.randrange(1, 1 << 20), 0) if math.gcd(a, n) == 1)
    runs = [F.struct(F.lit(g).alias("grp"), F.lit(r).alias("rep"), F.lit(factors()).cast("long").alias("a"), F.lit(rnd.randrange(n)).cast("long").alias("c")) for g in groups for r in range(repeats)]
    member = {c: [g for g, cols in groups.items() if c in cols] for c in columns}
    given = [F.when(F.col("run.grp").isin(member[c]), F.col(c)).alias(f"{c}_p") for c in columns]
    to = F.pmod(F.col("number") * F.col("run.a") + F.col("run.c"), F.lit(n).cast("long")).alias("number")
    sent = rows.select("number", *columns, F.explode(F.array(*runs)).alias("run")).select("run.grp", "run.rep", to, *given)
    shown = lambda c: F.when(F.col("grp").isin(member[c]), F.col(f"{c}_p")).otherwise(F.col(c))
    done = sent.hint("merge").join(rows, "number").select("grp", "rep", "y", predict(shown).alias("z"))
    base = rows.select("y", predict(F.col).alias("z"))

    def quality() -> tuple[Column, Column]:
        f1 = [F.coalesce(F.try_divide(2 * F.count_if((F.col("y") == k) & (F.col("z") == k)), F.count_if(F.col("y") == k) + F.count_if(F.col("z") == k)), F.lit(0.0)) for k in (0, 1)]
        return ((f1[0] + f1[1]) / 2).alias("macro_f1"), F.avg((F.col("y") == F.col("z")).cast("double")).alias("accuracy")

    each = done.groupBy("grp", "rep").agg(*quality()).crossJoin(F.broadcast(base.agg(*quality()).toDF("base_f1", "base_accuracy")))
    drop, loss = F.col("base_f1") - F.col("macro_f1"), F.col("base_accuracy") - F.col("accuracy")
    return each.groupBy(F.col("grp").alias("feature")).agg(F.avg(drop).alias("macro_f1_drop_mean"), F.coalesce(F.stddev_samp(drop), F.lit(0.0)).alias("macro_f1_drop_std"), F.avg("macro_f1").alias("permuted_macro_f1_mean"), F.avg(loss).alias("accuracy_drop_mean"), F.count("*").alias("repeats")).orderBy(F.desc("macro_f1_drop_mean"), "feature")


def baseline(train: DataFrame, features: list[str], label: str, vector: str | None = None, weight: str | None = None):
    """Median imputation, scaling and class-weighted multinomial logistic regression, fitted on the training rows only."""
    filled = [f"{c}_filled" for c in features]
    stages = [Imputer(strategy="median", inputCols=features, outputCols=filled), VectorAssembler(inputCols=filled + ([vector] if vector else []), outputCol="assembled"), StandardScaler(inputCol="assembled", outputCol="features", withMean=True)]
    stages.append(LogisticRegression(labelCol=label, featuresCol="features", family="multinomial", maxIter=300, regParam=0.05, elasticNetParam=0.0, **({"weightCol": weight} if weight else {})))
    return Pipeline(stages=stages).fit(train)


def vector(c: str) -> Column:
    return array_to_vector(F.col(c).cast("array<double>"))


def saved(model, path: str):
    """Write a fitted pipeline and read it again, as scoring jobs do."""
    from pyspark.ml import PipelineModel

    model.write().overwrite().save(path)
    return PipelineModel.load(path)
