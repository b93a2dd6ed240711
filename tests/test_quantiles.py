"""Exact quantiles against numpy, in ranges of a few rows."""

import math

import numpy as np
import pytest

from tidemark.operators import quantiles as qt

AT = {"lo": 0.0, "p01": 0.01, "q25": 0.25, "mid": 0.5, "p99": 0.99, "hi": 1.0}


def expected(groups):
    return {g: tuple(float(np.quantile(v, p)) for p in AT.values()) for g, v in groups.items() if v}


def got(df, by):
    return {tuple(r[c] for c in by): tuple(r[c] for c in AT) for r in qt.quantiles(df, "v", AT, by).collect()}


@pytest.mark.parametrize("leaf", [10_000, 20])
def test_groups(spark, monkeypatch, leaf):
    monkeypatch.setattr(qt, "LEAF", leaf)
    monkeypatch.setattr(qt, "CUTS", 8)
    rng = np.random.default_rng(5)
    groups = {("a", 1): rng.standard_normal(900).tolist(), ("a", None): [3.0] * 300 + [5.0], (None, 2): (10.0 ** rng.uniform(-200, 200, 300)).tolist(), ("b", 0): [1.5], ("c", 0): [-1.0, 4.0], ("d", 0): []}
    groups["hot", 0] = rng.integers(0, 3, 2000).astype(float).tolist() + rng.standard_normal(50).tolist()
    rows = [(*g, x, "own", 1.0) for g, v in groups.items() for x in v] + [("d", 0, None, "own", 1.0), ("a", 1, None, "own", 1.0)]
    df = spark.createDataFrame(rows, "k string, n long, v double, low string, held double").repartition(3)
    out, want = got(df, ["k", "n"]), expected(groups)
    assert out.keys() == want.keys()
    for g, v in want.items():
        assert out[g] == pytest.approx(v, rel=1e-12)


def test_all_rows_and_none(spark, monkeypatch):
    monkeypatch.setattr(qt, "LEAF", 5)
    df = spark.range(1, 1002).selectExpr("id AS v")
    assert got(df, [])[()] == pytest.approx(expected({(): list(range(1, 1002))})[()])
    assert got(df.filter("v < 0"), []) == {}
    nan = spark.createDataFrame([(float("nan"),), (1.0,), (2.0,)], "v double")
    assert math.isnan(qt.quantiles(nan, "v", {"x": 1.0}).first().x) and qt.quantiles(nan, "v", {"x": 0.5}).first().x == 2.0
