"""The sequence model against all label sequences, and on odd rows."""

import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.operators import sequence as sq

RNG = np.random.default_rng(11)


def model(dims=40):
    return sq.SequenceModel(RNG.standard_normal((dims, 3)), RNG.standard_normal((3, 3)), sq.LABELS)


def sequences(lengths, dims=40):
    rows = [[RNG.integers(0, dims, RNG.integers(0, 4)).tolist() for _ in range(n)] for n in lengths]
    return pa.array(rows, pa.list_(pa.list_(pa.int32())))


def score(m, tokens, labels):
    own = sum(m.weights[i, y] for t, y in zip(tokens, labels, strict=True) for i in t)
    return own + sum(m.steps[a, b] for a, b in itertools.pairwise(labels))


def test_best_labels_are_those_of_all_sequences():
    m, rows = model(), sequences([0, 1, 2, 3, 5, 6, 4, 1])
    for tokens, got in zip(rows.to_pylist(), m.best(rows), strict=True):
        every = list(itertools.product(range(3), repeat=len(tokens)))
        best = max(every, key=lambda y: score(m, tokens, y))
        assert got == [sq.LABELS[y] for y in best]


def test_gradient_is_that_of_all_sequences(monkeypatch):
    m, rows = model(), sequences([1, 2, 4, 3, 0, 1])
    gold = pa.array([RNG.integers(0, 3, len(t)).tolist() for t in rows.to_pylist()], pa.list_(pa.int32()))
    total, by_weight, by_step = 0.0, np.zeros_like(m.weights), np.zeros_like(m.steps)
    for tokens, own in zip(rows.to_pylist(), gold.to_pylist(), strict=True):
        every = list(itertools.product(range(3), repeat=len(tokens)))
        mass = np.array([score(m, tokens, y) for y in every])
        p = np.exp(mass - np.log(np.exp(mass).sum()))
        total += score(m, tokens, own) - np.log(np.exp(mass).sum())
        for y, w in [(tuple(own), 1.0), *zip(every, -p, strict=True)]:
            for t, k in zip(tokens, y, strict=True):
                for i in t:
                    by_weight[i, k] += w
            for a, b in itertools.pairwise(y):
                by_step[a, b] += w
    for room in (1 << 16, 3):
        monkeypatch.setattr(sq, "BATCH_TOKENS", room)
        got = m.gradient(rows, gold)
        assert np.allclose(got[0], total) and np.allclose(got[1], by_weight) and np.allclose(got[2], by_step)


def test_quasi_newton_finds_the_minimum():
    a = np.diag([1.0, 30.0, 0.2, 5.0]) + 0.1
    goal = np.array([1.0, -2.0, 3.0, 0.5])
    x = sq.descended(lambda x: (float((x - goal) @ a @ (x - goal)), 2 * a @ (x - goal)), np.zeros(4), 100, 1e-14)
    assert np.allclose(x, goal, atol=1e-4)


def test_name_labels_and_mentions(spark):
    text = "Hòa Phát và hòa  phát group, VCB. Phát hòa"
    df = sq.seen_tokens(spark.createDataFrame([(text, 1), (None, 2), ("", 3)], "text string, k int"), "text")
    got = df.withColumn("y", sq.name_labels(F.col("words"), ["hòa phát", "hòa phát group", "vcb"])).orderBy("k").collect()
    assert got[0].y == ["B-ORG", "I-ORG", "O", "B-ORG", "I-ORG", "I-ORG", "O", "B-ORG", "O", "O", "O"]
    assert not got[1].y and not got[2].y
    found = sq.mentions(df.withColumn("predicted", sq.name_labels(F.col("words"), ["hòa phát", "vcb"])), "text").orderBy("start").collect()
    assert [(r.mention, text[r.start : r.end]) for r in found] == [(m, m) for m in ("Hòa Phát", "hòa  phát", "VCB")]
    assert set(found[0].asDict()) == {"text", "k", "ids", "mention", "start", "end"}


def test_training_learns_what_needs_steps_and_neighbours(spark, monkeypatch):
    monkeypatch.setattr(sq, "PIECE_TOKENS", 16)
    words, rnd = ["red", "fox", "sees", "the", "dog", "bank", "of", "north", "and"], np.random.default_rng(12)
    texts = [" ".join(rnd.choice(words, 30)) for _ in range(120)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(900, None), (901, "")], "i int, text string")
    rows = sq.seen_tokens(df, "text", dims=1 << 10).withColumn("gold", sq.name_labels(F.col("words"), ["bank of north", "red fox", "dog"]))
    m = sq.trained(rows.filter("i % 4 > 0"), dims=1 << 10, rounds=25)
    out = sq.predicted(rows.filter("i % 4 = 0"), m)
    wrong, n = out.agg(F.sum(F.size(F.filter(F.zip_with("gold", "predicted", lambda a, b: a != b), lambda x: x))), F.sum(F.size("gold"))).first()
    assert wrong <= 0.005 * n
    odd = {r.i: r.predicted for r in sq.predicted(rows.filter("i >= 900"), m).collect()}
    assert not odd[900] and not odd[901]


def test_unknown_labels_are_an_error(spark):
    df = spark.createDataFrame([([[1], [2]], ["O", "B-PER"])], "ids array<array<int>>, gold array<string>")
    with pytest.raises(Exception, match="unknown label"):
        sq.trained(df, rounds=1, dims=8)


def test_folding_and_marks(spark):
    from tidemark.functions import entities as ent
    from tidemark.functions.text import instant, mention_key

    row = spark.createDataFrame([("weiß ΣΑΣ", "a͏b V️CB ́Hòa", "2024-05-01T10:00:00")], "t string, m string, at string")
    seen = ent.token_features(row.select(ent.tokens(F.col("t")).alias("w")), "w").first().features
    assert [f.lower for f in seen] == ["weiß".casefold(), "ΣΑΣ".casefold()] and seen[0].last3 == "iss" and seen[1].back_lower == "weiss"
    assert row.select(mention_key("m").alias("k")).first().k == "ab vcb hoa"
    assert row.select(F.date_format(instant("at"), "HH").alias("h")).first().h == "03"
