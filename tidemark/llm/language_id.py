"""Operator 6: language identification.

Method: lower-cased UTF-8 bytes of letters and spaces are cut into 1- to 4-grams, each hashed into a table of embeddings; the
average embedding of a text goes through a linear softmax. Embeddings and softmax are trained together by stochastic gradient
descent (AdaGrad steps) in numpy on the driver. A temperature is fitted on rows left out of the descent, and so is the confidence under which
a prediction is marked rejected: the least at which accepted rows of the calibration part are right to ACCEPT.

Bounds: training uses about TRAIN_ROWS rows, taken by a hash of id and text (the smallest hashes, so that repeated rows don't make
it more than twice that), and of each the n-gram counts of the whole text, made
in tasks (6 bytes for each bucket that a text has, at most 2 ** BUCKETS_BITS); the model is a table of BUCKETS x languages.
Predictions use whole texts.

Plan: one scan for the sample, one for the predictions; no shuffle.

Defined results: a null text or one without a letter is `und` with score 0; so is everything if there is nothing to learn
from; null languages are not learnt; equal scores go to the first language in the alphabet; repeated rows get the same result;
an empty table gives an empty one; very long texts are read in whole; input columns named as added ones are replaced; a null id is
held out or not as null (held_out is then null). Only the text enters a prediction.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import fold, give_back, map_text, slices, table

TRAIN_ROWS = 6_000
BUCKETS_BITS, DIMS = 15, 16
#: Passes over the rows, at least so many steps in all, the rate of AdaGrad steps, and rows in a step.
EPOCHS, LEAST_STEPS, RATE, BATCH = 6, 600, 0.1, 32
ACCEPT = 0.995
GRAMS = (1, 2, 3, 4)
#: n-grams whose weights are added at once.
PART = 1 << 16

not_letters = re.compile(r"[\W\d_]+")


def cleaned(text: str | None) -> bytes:
    """Words of letters in lower case, one space before, between and after; nothing if there is no letter."""
    words = not_letters.sub(" ", (text or "").lower()).strip()
    return f" {words} ".encode("utf-8", "surrogatepass") if words else b""


def hashed_grams(data: bytes) -> np.ndarray:
    """Bucket of every n-gram of the bytes."""
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    out, h = [], np.zeros(len(b), np.uint32)
    for n in range(1, GRAMS[-1] + 1):
        h = h[: len(b) - n + 1] * np.uint32(0x01000193) + b[n - 1 :] + np.uint32(n)
        mixed = h * np.uint32(0x9E3779B1)
        out.append(mixed >> np.uint32(32 - BUCKETS_BITS))
        if len(h) <= 1:
            break
    return np.concatenate(out)


def gram_counts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets that the n-grams of the bytes fall in, and how many fall in each."""
    n = np.bincount(hashed_grams(data), minlength=1 << BUCKETS_BITS)
    at = np.flatnonzero(n)
    return at.astype(np.uint16), n[at].astype(np.uint32)


class LanguageModel:
    """names, table (BUCKETS x languages: embeddings times softmax weights), bias, temperature and confidence bound."""

    def __init__(self, names: list[str], weights: np.ndarray, bias: np.ndarray):
        self.names, self.weights, self.bias = names, weights.astype(np.float32), bias
        self.temperature, self.least = 1.0, 0.0

    def logits(self, data: bytes) -> np.ndarray:
        h = hashed_grams(data)
        total = np.zeros(len(self.names))
        for at in range(0, len(h), PART):
            total += self.weights[h[at : at + PART]].sum(axis=0, dtype=np.float64)
        return total / len(h) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=-1, keepdims=True))
        return e / e.sum(axis=-1, keepdims=True)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        data = cleaned(text)
        if not data or not self.names:
            return "und", 0.0, True
        p = self.probabilities(self.logits(data))
        best = int(p.argmax())
        return self.names[best], float(p[best]), bool(p[best] < self.least)


def trained(counts: list[tuple[np.ndarray, np.ndarray]], langs: list[str]) -> LanguageModel:
    """Descent on nine tenths of the rows (gram_counts of each), calibration on the rest; the order is fixed."""
    names = sorted(set(langs))
    rows = [(at, names.index(g), n) for (at, n), g in zip(counts, langs, strict=True) if len(at)]
    rng = np.random.default_rng(7)
    order = rng.permutation(len(rows))
    held = [rows[i] for i in order[: len(rows) // 10]]
    learn = [rows[i] for i in order[len(rows) // 10 :]]
    e = rng.uniform(-1 / DIMS, 1 / DIMS, (1 << BUCKETS_BITS, DIMS)).astype(np.float32)
    w, b = np.zeros((DIMS, len(names)), np.float32), np.zeros(len(names), np.float32)
    seen_e, seen_w, seen_b = np.full_like(e, 1e-8), np.full_like(w, 1e-8), np.full_like(b, 1e-8)  # sums of squared gradients
    epochs = max(EPOCHS, math.ceil(LEAST_STEPS * BATCH / max(1, len(learn))))
    steps, done = epochs * max(1, math.ceil(len(learn) / BATCH)), 0
    for _ in range(epochs if learn else 0):
        shuffled = rng.permutation(len(learn))
        for lo in range(0, len(learn), BATCH):
            part = [learn[i] for i in shuffled[lo : lo + BATCH]]
            rate = np.float32(RATE * (1 - done / steps))
            done += 1
            sizes = np.array([len(p[0]) for p in part])
            grams, starts = np.concatenate([p[0] for p in part]), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            share = np.concatenate([p[2] / p[2].sum() for p in part]).astype(np.float32)
            mean = np.add.reduceat(e[grams] * share[:, None], starts, axis=0)
            z = mean @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), [x[1] for x in part]] -= 1
            to_mean = p @ w.T
            for value, seen, slope in ((w, seen_w, mean.T @ p / len(part)), (b, seen_b, p.mean(axis=0))):
                seen += slope * slope
                value -= rate * slope / np.sqrt(seen)
            used, place = np.unique(grams, return_inverse=True)
            change = np.stack([np.bincount(place, np.repeat(to_mean[:, k], sizes) * share, len(used)) for k in range(DIMS)], axis=1)
            seen_e[used] += (change * change).astype(np.float32)
            e[used] -= (rate * change / np.sqrt(seen_e[used])).astype(np.float32)
    model = LanguageModel(names, e @ w, b.astype(np.float64))
    if held:
        z, y = np.stack([(h[2] / h[2].sum()) @ model.weights[h[0]].astype(np.float64) + model.bias for h in held]), np.array([h[1] for h in held])
        loss = []
        for t in np.geomspace(0.5, 20, 60):
            model.temperature = float(t)
            loss.append((-np.log(np.maximum(model.probabilities(z)[np.arange(len(y)), y], 1e-12)).mean(), float(t)))
        model.temperature = min(loss)[1]
        p = model.probabilities(z)
        sure, right = p.max(axis=1), p.argmax(axis=1) == y
        ranked = np.argsort(-sure, kind="stable")
        share = np.cumsum(right[ranked]) / np.arange(1, len(ranked) + 1)
        fine = np.flatnonzero(share >= ACCEPT)
        model.least = float(sure[ranked[fine[-1]]]) if len(fine) else 1.0
    return model


def fitted(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", train_rows: int = TRAIN_ROWS) -> LanguageModel:
    """A model from about train_rows of the given rows (all of them must be free to learn from)."""
    known = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    keep = max(1, math.ceil(known.count() / train_rows))
    h = F.xxhash64(F.col(id_col), F.col(text_col), F.lit("language"))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 64):
                got = [gram_counts(d) if (d := cleaned(t)) else (np.zeros(0, np.uint16), np.zeros(0, np.uint32)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *(pa.array([g[k].tobytes() for g in got], pa.binary()) for k in (0, 1))], names=["g", "h", "at", "n"])
        give_back()

    sample = known.filter(F.pmod(h, F.lit(keep)) == 0).select(F.col(lang_col).cast("string").alias("g"), F.col(text_col).cast("string"), h.alias("h"))
    counted = sample.mapInArrow(run, "g string, h long, at binary, n binary")
    rows = counted.orderBy("h", "g").limit(2 * train_rows).select("g", "at", "n").orderBy("g", "at", "n").collect()
    return trained([(np.frombuffer(r["at"], np.uint16), np.frombuffer(r["n"], np.uint32)) for r in rows], [r["g"] for r in rows])


def languages(df: DataFrame, model: LanguageModel, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """df with lang_pred, score and rejected (the confidence is under the calibrated bound)."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        def run(texts: list) -> dict:
            got = [shared.value.predict(x) for x in texts]
            return {"lang_pred": [g[0] for g in got], "score": [g[1] for g in got], "rejected": [g[2] for g in got]}

        return run

    return map_text(df, make, "lang_pred string, score double, rejected boolean", text_col, keep_text)


def op6_language_id(spark, sf_dir: str) -> DataFrame:
    """Language of every whole document; learnt from where crc32(doc_id) mod 4 is not 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fitted(docs.filter(fold("doc_id", 4) != 2))
    out = languages(docs.select("doc_id", "text"), model, keep_text=False)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")
