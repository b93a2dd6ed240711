"""Operator 13 against all pairs, its parts against plain versions, and on odd cases."""

import itertools
import math

import numpy as np
import pytest
from compare import duck_rows, spark_rows

from tidemark.llm import common, neighbours

SCHEMA = "vec_id long, embedding array<double>, label int, score string, rank string"


def plain(rows, k=10, every=100):
    """All pairs, by the definition."""
    good = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    asked = {}
    for i, v in sorted(good):
        if i % every == 0:
            asked.setdefault(i, v)
    out = set()
    for q, v in asked.items():
        near = {}
        for i, w in good:
            if i != q and len(w) == len(v):
                total = 0.0
                for a, b in zip(v, w, strict=True):
                    try:
                        total += (a - b) ** 2
                    except OverflowError:
                        total = math.inf
                near[i] = min(near.get(i, math.inf), math.sqrt(total))
        out |= {(q, n + 1, i, s) for n, (i, s) in enumerate(sorted(near.items(), key=lambda x: (x[1], x[0]))[:k])}
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 1, "own", "own") for i, v in rows], SCHEMA).repartition(3)
    out = neighbours.nearest(df, "vec_id % 100 = 0", **options)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


def test_perturbations_are_in_order_and_complete():
    rng = np.random.default_rng(2)
    for m in (1, 2, 3):
        place = rng.uniform(-5, 5, m)
        inside = place - np.floor(place)
        score = lambda o: sum((0 if d == 0 else (x - d - 1 if d < 0 else d - x)) ** 2 for d, x in zip(o, inside, strict=True))  # noqa: B023,E731
        every = list(itertools.product(range(-neighbours.REACH, neighbours.REACH + 1), repeat=m))
        got = neighbours.perturbations(place, 10**6)
        assert sorted(got) == sorted(every) and got[0] == (0,) * m
        assert np.allclose([score(o) for o in got], sorted(map(score, every)))
        assert got[:5] == neighbours.perturbations(place, 5)


def test_nearest_pairs(monkeypatch):
    rng = np.random.default_rng(3)
    for block in (1 << 20, 64):
        monkeypatch.setattr(neighbours, "BLOCK_CELLS", block)
        for scale, shift in ((1.0, 0.0), (1e-9, 1e3), (1e200, 0.0)):
            c = rng.integers(-2, 3, (90, 5)) * scale + shift
            q, ids = rng.integers(-2, 3, (7, 5)) * scale + shift, rng.permutation(90)
            row, place, score = neighbours.nearest_pairs(q, c, ids, 4)
            for i in range(len(q)):
                with np.errstate(all="ignore"):
                    d = np.sqrt([sum((a - b) ** 2 for a, b in zip(q[i], x, strict=True)) for x in c])
                order = np.lexsort((ids, d))[:4]
                assert place[row == i].tolist() == order.tolist() and score[row == i].tolist() == d[order].tolist()


@pytest.mark.parametrize("broadcast", [True, False])
def test_small_tables_are_exact(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(neighbours, "sized", lambda df: common.sized(df, 0))
    monkeypatch.setattr(neighbours, "CHUNK_ROWS", 40)
    monkeypatch.setattr(neighbours, "CHUNK_PROBES", 2)
    rng = np.random.default_rng(4)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(500)]
    rows += [(i, rows[7][1]) for i in range(500, 820)]  # a hot vector, three queries among its copies
    rows += [rows[3], rows[600], (100, rows[9][1]), (40, rows[50][1])]  # repeated rows, ids with two vectors
    rows += [(900, None), (1000, []), (1100, [0.0] * 6), (1200, [1.0, None]), (1300, [math.nan] * 6), (1400, [math.inf, 1.0]), (None, [1.0] * 6)]
    rows += [(1500, [1.0, 2.0]), (1501, [1.0, 2.5]), (1600, [9.0]), (1700, [1e200] * 6), (1701, [-1e200] * 6), (-100, [5.0] * 6)]
    assert found(spark, rows) == plain(rows)


def test_few_and_none(spark):
    assert found(spark, []) == set()
    assert found(spark, [(1, [1.0]), (2, [2.0])]) == set()
    assert found(spark, [(100, [1.0, 0.0])]) == set()
    rows = [(100, [1.0, 0.0]), (200, [1.0, 0.0]), (3, [0.0, 1.0]), (4, [-0.0, 1.0])]
    assert found(spark, rows) == plain(rows)


def test_outliers_are_compared_with_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SCAN_QUERIES", 2)
    rng = np.random.default_rng(5)
    rows = [(i, (rng.standard_normal(8) * 0.01 + 1).tolist()) for i in range(1, 900) if i % 100] + [(100 * i, (rng.standard_normal(8) * 1000).tolist()) for i in range(1, 6)]
    monkeypatch.setattr(neighbours, "chosen", lambda *a: (neighbours.Hashes(2, 4, 0.02), 1, {}))
    assert {x for x in found(spark, rows)} == plain(rows)


def test_probes_are_selective_and_recall_holds(spark):
    """Groups of 24 vectors, far from each other: few probes, few vectors looked at, nearly all neighbours found."""
    rng = np.random.default_rng(6)
    rows = [(25 * g + i if i else 100 * g + 100_000, (c + rng.standard_normal(16) * 0.05).tolist()) for g, c in enumerate(rng.standard_normal((160, 16)) * 3) for i in range(24)]
    df = spark.createDataFrame([(i, v, 1, "", "") for i, v in rows], SCHEMA)
    vectors = neighbours.classes(neighbours.usable(df, "vec_id", "embedding"), 10)
    queries = vectors.filter("cid % 100 = 0").withColumnRenamed("cid", "qid")
    _, probes, measured = neighbours.chosen(vectors, queries, 10_000_000, 10)
    assert probes <= 64 and measured["share"] < 0.1 and measured["recall"] >= neighbours.RECALL
    got, wanted = found(spark, rows), plain(rows)
    assert len(got & wanted) >= 0.9 * len(wanted)


def test_sql_on_a_given_table(spark):
    assert spark_rows(neighbours.op13_nearest(spark, "/root/testdata/sf0.01")) == duck_rows(neighbours.OP13_SQL, "/root/testdata/sf0.01")
