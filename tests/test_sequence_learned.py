"""The sequence model learned from all texts: slopes against those of whole label sequences, the optimum, names in few texts."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.functions.entities import token
from tidemark.operators import sequence as sq
from tidemark.plans import sequence_queries

WORDS = ["red", "Fox", "sees", "the", "DOG", "bank", "of", "north", "and", "12", "Hòa", "ﬁx", "😀", "weiß", "2nd", "a-b", "_"]
LABEL = sq.labeller(["bank of north", "red fox", "dog"])


@pytest.fixture(scope="module")
def texts():
    rnd = np.random.default_rng(8)
    return [*(" ".join(rnd.choice(WORDS, n)) for n in [*rnd.integers(1, 60, 50), 300]), "", "dog"]


def typed(kinds, parts):
    return {c: np.asarray(parts[c], kind) for c, kind in kinds.items()}


def pieces(texts, known):
    """Features (places in known) and labels of pieces of tokens, as SequenceModel.gradient takes them."""
    vocabulary, place, ids, gold = sq.Vocabulary(), {x: i for i, x in enumerate(known.tolist())}, [], []
    for t in texts:
        words = token.findall(t)
        y = [sq.LABELS.index(x) for x in LABEL(words)]
        for at in range(0, len(words), sq.PIECE_TOKENS):
            ids.append([[place[i] for i in row if i in place] for row in vocabulary.ids(words, at, at + sq.PIECE_TOKENS)])
            gold.append(y[at : at + sq.PIECE_TOKENS])
    return pa.array(ids, pa.list_(pa.list_(pa.int32()))), pa.array(gold, pa.list_(pa.int32()))


@pytest.mark.parametrize("room", [1 << 17, 40])
def test_slopes_are_those_of_whole_sequences(texts, monkeypatch, room):
    monkeypatch.setattr(sq, "PIECE_TOKENS", 16)
    monkeypatch.setattr(sq, "LEARN_TOKENS", room)
    part, rnd = typed(sq.CUT, sq.cut(texts, LABEL, sq.LABELS, sq.DIMS)), np.random.default_rng(9)
    every = np.unique(part["ids"])
    for known in (every, np.sort(rnd.choice(every, 40, replace=False))):
        weights, steps, near = rnd.standard_normal((len(known), 3)), rnd.standard_normal((3, 3)), 1e-8
        met = typed(sq.MET, sq.contexts(part, known, 3))
        total, by_weight, by_step = sq.SequenceModel(weights, steps, sq.LABELS).gradient(*pieces(texts, known))
        got = sq.slopes(met, weights, steps)
        assert abs(got[0] - total) < near and np.abs(got[1] - by_weight).max() < near and np.abs(got[2] - by_step).max() < near
        apart = sq.SequenceModel(weights, 0 * steps, sq.LABELS).gradient(*pieces(texts, known))
        got = sq.slopes_apart(met, weights)
        assert abs(got[0] - apart[0]) < near and np.abs(got[1] - apart[1]).max() < near
        seen, numbers, sums = sq.steep_features(part, known, weights, steps, 1e-3)
        assert abs(seen - total) < near
        slope = dict(zip(numbers.tolist(), sums, strict=True))
        for i, x in zip(known.tolist(), by_weight, strict=True):
            assert np.abs(slope[i] - x).max() < near if i in slope else np.abs(x).max() < 1e-3 + near


def test_no_feature_is_left_that_all_texts_ask_for(spark, texts):
    rows = [*texts, *texts[:20], None]  # copies count as often as they occur
    df = spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    l1, l2 = 0.1, 0.1
    model = sq.learned(df, "text", LABEL, l1=l1, l2=l2, rounds=400, tolerance=1e-9)
    part = typed(sq.CUT, sq.cut([t or "" for t in rows], LABEL, sq.LABELS, sq.DIMS))
    _, numbers, sums = sq.steep_features(part, model.known, model.weights, model.steps, 0.0)
    slope, held = dict(zip(numbers.tolist(), sums, strict=True)), set(model.known.tolist())
    assert len(held) > 5 and all(np.abs(x).max() < 1.1 * l1 for i, x in slope.items() if i not in held)
    for i, w in zip(model.known.tolist(), model.weights, strict=True):
        assert np.abs(slope[i] - l2 * w - l1 * np.sign(w))[w != 0].max() < 0.02 and np.abs(slope[i][w == 0]).max(initial=0) < 1.2 * l1
    found = df.select("text", sq.entity_spans(F.col("text"), sq.by_model(model)).alias("p"), sq.entity_spans(F.col("text"), sq.by_names(["bank of north", "red fox", "dog"])).alias("g")).collect()
    assert all(r.p == r.g for r in found)


def test_nothing_is_learned_from_no_tokens(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",)], "text string")
    for none in (df, df.limit(0)):
        model = sq.learned(none, "text", LABEL)
        assert sq.by_model(model)([["red", "fox"], []]).tolist() == [0, 0]


def test_numbers_of_features_are_the_hashes_of_their_names():
    for dims in (sq.DIMS, 1 << 10):
        vocabulary = sq.Vocabulary(dims)
        for w in [*WORDS, "VCB", "Vcb", "x²", "ΣΑΣ", "İı", "a" * 30, "٣"]:
            assert vocabulary(w) == tuple(sq.numbered(f, dims) for f in (sq.own_features(w), sq.side_features(w, "back"), sq.side_features(w, "ahead")))


def test_a_name_in_few_of_many_texts_is_learned(spark, tmp_path):
    def far(text: str) -> bool:
        """Among the last of all pieces by hash, which a choice by hash leaves out."""
        seen = "\n".join(["False", *text.split()])
        return int.from_bytes(hashlib.blake2b(seen.encode(), digest_size=8).digest(), "big", signed=True) > 1 << 62

    named = [t for t in (f"w{i} que v{i}" for i in range(100)) if far(t)][:6]
    rows = [(i, f"w{i} und v{i}" if i % 3 else f"w{i} x v{i}") for i in range(1, 16_000) if i % 5] + [(20_000 + 5 * i + 1, t) for i, t in enumerate(named)]
    rows += [(50_000, "w7 que v9"), (50_005, "w8 und v8"), (50_010, "w12 que v11")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sequence_queries.sequence_f1(spark, str(tmp_path)).first()
    assert (got.true_positive, got.false_positive, got.false_negative) == (3, 0, 0)
