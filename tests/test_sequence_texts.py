"""The sequence model on whole texts: the same labels as on arrays of features, bounded samples, mentions across lines."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.functions import entities as ent
from tidemark.operators import sequence as sq
from tidemark.plans import sequence_queries

WORDS = ["red", "Fox", "sees", "the", "DOG", "bank", "of", "north", "and", "12", "Hòa", "ﬁx", "😀", "weiß", "grund"]


@pytest.fixture(scope="module")
def texts(spark):
    rnd = np.random.default_rng(5)
    rows = [" ".join(rnd.choice(WORDS, n)) for n in [*rnd.integers(1, 90, 60), 700]]
    return spark.createDataFrame([*enumerate(rows), (900, None), (901, ""), (902, "unheard bank of\nnorth")], "i int, text string").cache()


@pytest.fixture(scope="module")
def model(texts):
    return sq.fitted(sq.sampled(texts.filter("i % 4 > 0 AND i < 900"), "text", sq.labeller(["bank of north", "red fox", "dog"])), rounds=15)


def test_spans_of_texts_are_the_ranges_of_predicted_labels(texts, model):
    ids = sq.predicted(sq.seen_tokens(texts, "text"), model)
    both = ids.select("i", "text", "words", ent.ranges(F.col("predicted")).alias("r"), sq.entity_spans(F.col("text"), sq.by_model(model)).alias("s")).collect()
    assert sum(len(r.s) for r in both) > 50
    for r in both:
        assert [(x.start, x.end) for x in r.r] == [(x.start, x.end) for x in r.s]
        assert [(r.words[x.start].start, r.words[x.end - 1].end) for x in r.s] == [(x.first_char, x.end_char) for x in r.s]


def test_spans_do_not_depend_on_slices(texts, model, monkeypatch):
    spans = lambda: [r.s for r in texts.orderBy("i").select(sq.entity_spans(F.col("text"), sq.by_names(["dog", "bank of north"])).alias("s")).collect()]
    whole = spans()
    column = __import__("pyarrow").array(["abc", None, "", "d" * 9, "e"])
    monkeypatch.setattr(sq, "SLICE_CHARS", 4)
    assert list(sq.slices(column)) == [["abc", "", ""], ["d" * 9], ["e"]]
    assert spans() == whole


def test_a_path_between_sure_tokens_is_that_of_the_whole_search():
    rnd = np.random.default_rng(6)
    for scale in (0.3, 3.0, 30.0):
        m = sq.SequenceModel(np.zeros((1, 3)), rnd.standard_normal((3, 3)), sq.LABELS)
        lengths = rnd.integers(0, 40, 50)
        u = rnd.standard_normal((int(lengths.sum()), 3)) * scale
        whole = m.searched(sq.padded(u, lengths), np.maximum(lengths, 1))
        assert m.path(u, lengths).tolist() == np.concatenate([whole[i, :n] for i, n in enumerate(lengths)]).tolist()


def test_sample_is_bounded_and_the_same_in_any_cut(spark, monkeypatch):
    monkeypatch.setattr(sq, "PIECE_TOKENS", 8)
    rnd = np.random.default_rng(7)
    rows = [(" ".join(rnd.choice(WORDS, 30)),) for _ in range(40)] + [("the same text of many copies",)] * 500
    take = lambda n, parts: sorted(map(str, sq.sampled(spark.createDataFrame(rows, "text string").repartition(parts), "text", sq.labeller(["dog"]), most=n).collect()))
    assert len(take(20, 1)) == 20 and take(20, 1) == take(20, 5)
    assert len(take(10_000, 3)) == 40 * 4 + 1  # all pieces, copies once
    assert sq.sampled(spark.createDataFrame([(None,), ("",)], "text string"), "text", sq.labeller(["dog"])).count() == 0


def test_features_are_those_of_the_feature_table(spark):
    words = [*WORDS, "VCB", "Vcb", "2nd", "x²", "a-b.c", "ΣΑΣ", "_"]
    row = ent.token_features(spark.createDataFrame([(words,)], "w array<string>").select(F.transform("w", lambda t: F.struct(t.alias("token"))).alias("w")), "w").first().features
    for i, (w, f) in enumerate(zip(words, row, strict=True)):
        seen = f.asDict()
        mine = set(sq.own_features(w)) | (set(sq.side_features(words[i - 1], "back")) if i else {"first"}) | (set(sq.side_features(words[i + 1], "ahead")) if i < len(words) - 1 else {"last"})
        assert mine == {"bias"} | {f"{k}={v}" for k, v in seen.items() if v is not None and not isinstance(v, bool)} | {k for k, v in seen.items() if v is True}


def test_mentions_across_lines_are_one_name(spark, tmp_path):
    rows = [(i, "the dog in the house und of the garden que " * 6) for i in range(1, 9)] + [(10, "in\nthe OF \u0009 the")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.mention: (r.n, r.docs) for r in sequence_queries.sequence_mentions(spark, str(tmp_path)).collect()}
    assert got == {"in the": (49, 9), "of the": (49, 9), "und": (48, 8), "que": (48, 8)}
