"""History by cosine with pivots, permuted columns, and rows that enter a split, against plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import metrics as mt
from tidemark.operators import targets as tg


def brute(rows, days, low, high, top):
    out, pairs = set(), 0
    for i, t, d, v in rows:
        near = []
        for j, u, e, w in rows:
            if t == u and d - days <= e < d:
                pairs += 1
                if v and w and len(v) == len(w) and np.linalg.norm(v) and np.linalg.norm(w):
                    c = float(np.dot(v, w) / np.linalg.norm(v) / np.linalg.norm(w))
                    if low <= c <= high:
                        near.append((-round(c, 9), j))
        out |= {(i, j, k + 1) for k, (_, j) in enumerate(sorted(near)[:top])}
    return out, pairs


def clustered(n):
    rnd = np.random.default_rng(4)
    centres = rnd.normal(size=(6, 8))
    rows = [(i, "hot" if i % 3 else "cold", int(rnd.integers(-30, 30)), (centres[i % 6] + 0.05 * rnd.normal(size=8)).tolist()) for i in range(n)]
    odd = [(n, "hot", 3, None), (n + 1, "hot", 4, [0.0] * 8), (n + 2, "hot", 5, [1.0, 2.0]), (n + 3, "hot", 2, [2.0, 1.0]), (n + 4, None, 1, [1.0] * 8)]
    return rows + odd


def test_history_is_brute_force(spark):
    """Also with blocks dealt out over many parts, zero and null vectors and vectors of two lengths."""
    rows = clustered(240)
    df = spark.createDataFrame(rows, "id long, ticker string, day int, vector array<double>").repartition(3)
    for days, low, high in ((14, 0.30, 0.85), (5, 0.0, 0.999)):
        want, _ = brute([r for r in rows if r[1]], days, low, high, 5)
        for share in (2_000, 7):
            assert {(r.id, r.past_id, r["rank"]) for r in tg.history(df, days, low, high, share=share).collect()} == want
        assert {(r.id, r.past_id, r["rank"]) for r in tg.history(df, days, low, high, pivots=0).collect()} == want
    assert not tg.history(df.limit(0)).collect()


def test_pairs_that_pivots_drop(spark):
    """Of vectors in narrow groups most pairs out of range are dropped before a cosine is taken."""
    rows = clustered(240)
    df = spark.createDataFrame(rows, "id long, ticker string, day int, vector array<double>")
    _, pairs = brute([r for r in rows if r[1]], 14, 0.3, 0.85, 5)
    got = tg.history_pairs(df).first()
    plain = tg.history_pairs(df, pivots=0).first()
    assert got.pairs == plain.pairs == plain.looked_at == pairs and got.in_range == plain.in_range
    assert got.in_range <= got.looked_at < 0.7 * pairs


def test_numbers_are_dense(spark):
    df = spark.range(1000).withColumn("id", F.col("id") * 7).repartition(5)
    rows = mt.numbered(df, "id", 3).collect()
    assert sorted(r.number for r in rows) == list(range(1000)) and len({r.id for r in rows}) == 1000
    assert not mt.numbered(df.limit(0), "id").collect()


def test_importance_permutes(spark):
    """A column that the prediction reads loses by what permuting it loses; one that it does not read loses nothing."""
    rnd = random.Random(2)
    data = [(i, rnd.randrange(2), rnd.random()) for i in range(400)]
    df = spark.createDataFrame([(i, y, float(y), x) for i, y, x in data], "id long, label int, own double, other double")
    predict = lambda c: (c("own") > 0.5).cast("int")
    out = {r.feature: r for r in mt.permutation_importance(df, {"own": ["own"], "other": ["other"], "both": ["own", "other"]}, predict, "label", repeats=6).collect()}
    assert out["other"].macro_f1_drop_mean == 0 and out["other"].accuracy_drop_mean == 0 and out["other"].repeats == 6
    assert all(0.4 < out[g].accuracy_drop_mean < 0.6 and out[g].macro_f1_drop_std > 0 for g in ("own", "both"))
    one = mt.permutation_importance(df.limit(1), {"own": ["own"]}, predict, "label", repeats=2).collect()
    assert [(r.feature, r.accuracy_drop_mean, r.repeats) for r in one] == [("own", 0.0, 2)]
    assert not mt.permutation_importance(df.limit(0), {"own": ["own"]}, predict, "label", repeats=2).collect()


def test_each_value_is_used_once(spark):
    """What a run gives away adds up to the column: the prediction is the value itself."""
    df = spark.range(300).select("id", (F.col("id") % 2).cast("int").alias("label"), F.col("id").cast("double").alias("x"))
    predict = lambda c: (c("x") % 2).cast("int")
    r = mt.permutation_importance(df, {"x": ["x"]}, predict, "label", repeats=8).first()
    assert 0.35 < r.accuracy_drop_mean < 0.65


def test_rows_of_a_split(spark):
    df = spark.createDataFrame([("train", True, 0.1), ("train", True, 0.0), ("train", True, None), ("train", False, 0.1), ("test", True, 0.1), ("train", None, 0.1), (None, True, 0.1)], "s string, m boolean, r double")
    assert [r.k for r in df.select(tg.eligible(F.col("s"), "train", F.col("m"), F.col("r")).alias("k")).collect()] == [True] + [False] * 6


def test_importance_broadcasts_no_rows(spark):
    """The values sent are many for each row, whatever the planner takes them for."""
    df = spark.range(500).selectExpr("id", "CAST(id % 2 AS INT) AS y", "CAST(id AS DOUBLE) AS x")
    out = mt.permutation_importance(df, {"x": ["x"]}, lambda c: (c("x") > 10).cast("int"), "y", repeats=3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [number" in plan and "BroadcastHashJoin" not in plan
