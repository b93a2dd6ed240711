"""Operator 12 against zlib and a plain version, and on odd cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from cases import SCHEMA, documents, empty, rows
from pyspark.sql import functions as F

from tidemark.llm import common, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text):
    w = WORD.findall(lower(text))
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]


def plain(docs, target, percent=25, min_words=20, buckets=10_000, seed=7):
    """(id, n_features, weight, score, rank) of every (id, text), by the definition."""
    hashed = lambda text: [zlib.crc32(f.encode()) % buckets for f in features(text)[1]]
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(hashed(text))
    for text in target:
        t.update(hashed(text))
    all_s, all_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log(float(t[b] + 1) * float(all_s + buckets) / (float(s[b] + 1) * float(all_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in docs:
        found = hashed(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None, len(features(text)[0])])
    able = sorted((x for x in out if x[5] >= min_words), key=lambda x: (-x[3], (x[0] is not None, x[0]), -x[1], x[2]))
    for n, x in enumerate(able[: percent * len(able) // 100]):
        x[4] = n + 1
    return Counter(tuple(x[:5]) for x in out)


def found(df, target, **options):
    return Counter((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in resample.importance_ranks(df, target, **options).collect())


def test_crc_columns_are_zlib():
    rnd = random.Random(3)
    parts = [bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 1, 2, 5, 5, 5, 40, 255, 256, 257, 3000]))) for _ in range(300)]
    data, lengths = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    assert resample.crc_columns(data, starts, lengths).tolist() == [zlib.crc32(p) for p in parts]


def test_feature_buckets():
    rnd = random.Random(4)
    texts = [None, "", "--", "A", "a b", "É é éa ÀB 9z\x00z {z|z}"] + ["".join(rnd.choice("abAB09 é-\n日_") for _ in range(rnd.randint(0, 80))) for _ in range(500)] + ["x" * 5000 + " y"]
    column = pa.array(["cut off", *texts], pa.string()).slice(1)
    n, got = resample.feature_buckets(column)
    at = 0
    for text, k in zip(texts, n.tolist(), strict=True):
        w, f = features(text)
        assert k == len(w)
        assert Counter(got[at : at + len(f)].tolist()) == Counter(zlib.crc32(x.encode()) % 10_000 for x in f)
        at += len(f)
    assert at == len(got)


def test_odd_rows(spark):
    target = ["brown fox over the river", None, "Wizards!", ""]
    goal = spark.createDataFrame([(t, "x") for t in target], "text string, doc_id string")
    docs = [(r[0], r[1]) for r in rows()]
    for options in ({}, {"percent": 50, "min_words": 1}, {"percent": 100, "min_words": 0, "buckets": 7, "seed": 1}):
        assert found(documents(spark), goal, **options) == plain(docs, target, **options)
    assert resample.importance_ranks(documents(spark), goal).columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    assert found(documents(spark), goal.filter("false")) == plain(docs, [])
    assert not found(empty(spark), goal)


def test_ties_strings_and_shuffled_plans(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(25))
    docs = [(f"d{i % 40}", text if i % 3 else text + " more") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id string, text string").repartition(5)
    goal = spark.createDataFrame([("w1 w2",)], "text string")
    assert found(df, goal) == plain(docs, ["w1 w2"])
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(resample, "sized", lambda df: common.sized(df, 0))
    assert found(df, goal) == plain(docs, ["w1 w2"])


def test_rows_of_the_draw(spark):
    docs = spark.createDataFrame([(i, "the goal text " * 9 if i < 5 else f"other{i} thing{i} " * 15, "x", str(i), i) for i in range(40)], ", ".join(SCHEMA.split(", ")[:5])).withColumn("rank", F.lit("own"))
    out = resample.resampled(docs, spark.createDataFrame([("the goal text " * 3000,)], "text string"))
    kept = {r.doc_id for r in out.collect()}
    assert out.columns == docs.columns and len(kept) == 10 and set(range(5)) <= kept
