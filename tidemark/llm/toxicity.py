"""Operator 5: toxicity by the nearest labelled examples.

Method: texts become TF-IDF vectors over the words and word beginnings whose presence goes with the label (chi-square on the
training rows of at least LEAST_CHI2, and found in LEAST_ROWS of them; document frequencies over all documents). The K nearest
training vectors by exact cosine come from an inverted index whose postings are cut into blocks with their largest weights:
blocks are read in the order of their bounds until no bound can reach the K-th best. Neighbours vote with weights
1 / (1 - cosine + SOFT); the vote is calibrated by a logistic fit on the training rows, each scored without itself (in tasks,
equal vectors once). The neighbours are returned as evidence. With all words as terms the neighbours of long texts are those that share their subject,
and most toxic texts are missed (README), so terms are selected.

Bounds: the index holds about TRAIN_ROWS labelled rows, taken by a hash of the id, as flat arrays, so it can be sent to every
task whatever the corpus. Everything else - document frequencies and scores - covers all documents.

Plan: three scans of the texts (training rows, frequencies, scores), no shuffle of texts.

Defined results: a text with no term (null and empty ones too) gets the training rate of such texts; several labels of one
document: toxic if any says so; null labels and null ids are not learnt from; without any training row the score is 0; repeated
rows and very long texts are scored like any others, whole; an empty table gives an empty one; ties of cosines go to the earlier
row of the index; input columns named as added ones are replaced; held_out of a null id is null. Only the text enters a score:
no row is told by its id, so a training row is among its own neighbours when it is scored (not when the vote is calibrated).
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import fold, give_back, map_text, sized, slices, staged, table, unstaged

#: About so many labelled rows are learnt from.
TRAIN_ROWS = 12_000
#: Chi-square from which a term is used, and the least number of training rows with it.
LEAST_CHI2, LEAST_ROWS = 20.0, 3
STEM = 5
K, SOFT, BLOCK = 15, 0.05, 64
#: Results that a worker keeps, of texts with few terms.
MEMO = 4_000

find_words = re.compile(r"[^\W\d_]+").findall


def terms(text: str | None) -> list[str]:
    """Words of a text, and the beginnings of the longer ones, marked with a tilde."""
    words = find_words((text or "").lower())
    return words + ["~" + w[:STEM] for w in words if len(w) > STEM]


class Terms:
    """Counts of the chosen terms in a text."""

    def __init__(self, names: list[str]):
        self.word = {n: i for i, n in enumerate(names) if not n.startswith("~")}
        self.stem = {n[1:]: i for i, n in enumerate(names) if n.startswith("~")}

    def counts(self, text: str | None) -> tuple:
        if not text:
            return ()
        words = find_words(text.lower())
        word, stem = self.word, self.stem
        found = Counter([word[w] for w in words if w in word])
        found.update([stem[w[:STEM]] for w in words if w[:STEM] in stem and len(w) > STEM])
        return tuple(sorted(found.items()))


class BlockIndex:
    """Exact K nearest by cosine over blocks of BLOCK training rows.

    The postings of term t in block b are places[first[t, b] : first[t, b + 1]] (rows of the block) with their weights.
    """

    def __init__(self, names: list[str], idf: np.ndarray, rows: list[tuple], ids: list, toxic: list[int]):
        self.terms, self.idf = Terms(names), idf
        order = sorted(range(len(rows)), key=lambda i: ([-c[0] for c in self.heaviest(rows[i])], ids[i]))
        self.ids = [ids[i] for i in order]
        self.toxic = np.array([toxic[i] for i in order], np.float64)
        self.width = max(1, -(-len(order) // BLOCK))
        vectors = [self.vector(rows[i]) for i in order]
        #: row n has the terms term[start[n] : start[n + 1]]
        self.start = np.concatenate([[0], np.cumsum([len(t) for t, _ in vectors], dtype=np.int64)])
        self.term = np.concatenate([np.zeros(0, np.int32), *(t for t, _ in vectors)]).astype(np.int32)
        self.weight = np.concatenate([np.zeros(0), *(w for _, w in vectors)])
        row = np.repeat(np.arange(len(order)), np.diff(self.start))
        cell = self.term.astype(np.int64) * self.width + row // BLOCK
        sort = np.argsort(cell, kind="stable")
        self.places, self.weights = (row[sort] % BLOCK).astype(np.int32), self.weight[sort]
        cells = len(names) * self.width
        self.first = np.searchsorted(cell[sort], np.arange(cells + 1)).astype(np.int64)
        bound = np.zeros(cells)
        np.maximum.at(bound, cell, self.weight)
        self.bound = bound.reshape(len(names), self.width)
        self.fit, self.bare, self.id_type = (1.0, 0.0), 0.0, "long"
        self.memo: dict[tuple, tuple] = {}

    def own(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Terms and weights of a row of the index."""
        return self.term[self.start[n] : self.start[n + 1]], self.weight[self.start[n] : self.start[n + 1]]

    def heaviest(self, counts: tuple) -> list:
        return sorted(((self.idf[t] * (1 + math.log(n)), -t) for t, n in counts), reverse=True)[:3]

    def vector(self, counts: tuple) -> tuple[np.ndarray, np.ndarray]:
        t = np.array([c[0] for c in counts], np.int64)
        w = np.array([(1 + math.log(c[1])) for c in counts]) * self.idf[t]
        norm = math.sqrt(float(w @ w))
        return t, w / norm if norm else w

    def nearest(self, t: np.ndarray, w: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
        """Positions and cosines of the k nearest rows with a cosine over 0; ties by position.

        Blocks are read by twos, fours and so on in the order of their bounds. A block whose bound only ties with the k-th best
        is read if it may hold an earlier row, so a large group of copies does not have to be read to its end.
        """
        bounds = w @ self.bound[t]
        order = np.argsort(-bounds, kind="stable")
        order = order[bounds[order] > 0]
        best_at, best = np.zeros(0, np.int64), np.zeros(0)
        at, step = 0, 2
        while at < len(order):
            blocks = order[at : at + step]
            at, step = at + step, min(2 * step, 32)
            if len(best) == k:
                reach = bounds[blocks]
                if reach[0] < best[-1] - 1e-12:
                    break
                over = np.round(reach + 1e-13, 12) > np.round(best[-1], 12)
                blocks = blocks[(reach >= best[-1] - 1e-12) & (over | (blocks * BLOCK < best_at[-1]))]
                if not len(blocks):
                    continue
            row, score = self.scores(t, w, blocks)
            best_at, best = np.concatenate([best_at, row]), np.concatenate([best, score])
            first = np.lexsort((best_at, -np.round(best, 12)))[:k]
            best_at, best = best_at[first], best[first]
        return best_at, np.minimum(best, 1.0)

    def scores(self, t: np.ndarray, w: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of some blocks with a cosine over 0, and the cosines; weights are added in the order of the terms."""
        cell = (t[:, None] * self.width + blocks[None, :]).ravel()
        n = self.first[cell + 1] - self.first[cell]
        posting = np.repeat(self.first[cell] - np.cumsum(n) + n, n) + np.arange(n.sum())
        slot = np.repeat(np.tile(np.arange(len(blocks)) * BLOCK, len(t)), n) + self.places[posting]
        score = np.bincount(slot, np.repeat(np.repeat(w, len(blocks)), n) * self.weights[posting], len(blocks) * BLOCK)
        found = np.flatnonzero(score > 0)
        return blocks[found // BLOCK] * BLOCK + found % BLOCK, score[found]

    def vote(self, at: np.ndarray, cosine: np.ndarray) -> float:
        weight = 1 / (1 - cosine + SOFT)
        return float((weight @ self.toxic[at] + 0.5) / (weight.sum() + 1))  # half a vote each way

    def groups(self) -> list[list[int]]:
        """Rows of the index with terms, those of one vector together."""
        same: dict[tuple, list[int]] = {}
        for i in np.flatnonzero(np.diff(self.start)).tolist():
            t, w = self.own(i)
            same.setdefault((t.tobytes(), w.tobytes()), []).append(i)
        return list(same.values())

    def votes(self, rows: list[int]) -> list[tuple[int, float]]:
        """Row and vote of each of some rows of one vector, without itself: the K + 1 nearest are the same for all of them."""
        at, cosine = self.nearest(*self.own(rows[0]), K + 1)
        most = self.vote(at[:K], cosine[:K]) if len(at) else 0.5
        near = set(at.tolist())
        out = []
        for i in rows:
            if i not in near:
                out.append((i, most))
            elif len(at) > 1:
                other = at != i
                out.append((i, self.vote(at[other], cosine[other])))
        return out

    def calibrate(self, voted: list[tuple[int, float]]) -> None:
        """Logistic fit of label on the votes of all rows, by Newton steps with a small ridge; and the rate of rows without
        features."""
        votes = [math.log(p / (1 - p)) for _, p in voted]
        labels = [self.toxic[i] for i, _ in voted]
        bare = self.toxic[np.diff(self.start) == 0].tolist()
        self.bare = (sum(bare) + 0.5 * float(np.mean(self.toxic)) if len(self.toxic) else 0.0) / (len(bare) + 1)
        if len(set(labels)) < 2:
            return
        x, y = np.column_stack([votes, np.ones(len(votes))]), np.array(labels)
        c = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-x @ c))
            step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(2), x.T @ (y - p) - 0.1 * (c - [1.0, 0.0]))
            c = c + step
            if np.abs(step).max() < 1e-9:
                break
        self.fit = (float(max(c[0], 0.0)), float(c[1]))

    def score(self, text: str | None) -> tuple:
        """(score, ids of the neighbours, their cosines)"""
        counts = self.terms.counts(text)
        if not counts:
            return self.bare, [], []
        hit = self.memo.get(counts)
        if hit is None:
            at, cosine = self.nearest(*self.vector(counts))
            if len(at):
                p = self.vote(at, cosine)
                p = 1 / (1 + math.exp(-self.fit[0] * math.log(p / (1 - p)) - self.fit[1]))
                hit = (p, [self.ids[i] for i in at.tolist()], cosine.tolist())
            else:
                hit = (self.bare, [], [])
            if len(counts) <= 8:
                if len(self.memo) >= MEMO:
                    self.memo.clear()
                self.memo[counts] = hit
        return hit


def term_rows(train: DataFrame) -> DataFrame:
    """term, toxic rows and rows with it: one row per term and task."""

    def run(batches):
        toxic, rows = Counter(), Counter()
        for batch in batches:
            for part in slices(batch, 0):
                for text, label in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    here = set(terms(text))
                    rows.update(here)
                    if label:
                        toxic.update(here)
        names = list(rows)
        for lo in range(0, len(names), 20_000):
            part = names[lo : lo + 20_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([toxic[n] for n in part], pa.int64()), pa.array([rows[n] for n in part], pa.int64())], names=["term", "p", "n"])

    return train.select("text", "toxic").mapInArrow(run, "term string, p long, n long").groupBy("term").agg(F.sum("p").alias("p"), F.sum("n").alias("n"))


def frequencies(df: DataFrame, names: list[str], text_col: str) -> np.ndarray:
    """Documents that hold each feature, over all of df, and the number of documents at the end."""

    def run(batches):
        t, n = Terms(names), np.zeros(len(names) + 1, np.int64)
        for batch in batches:
            for part in slices(batch, 0):
                for text in part.column(0).to_pylist():
                    n[[c[0] for c in t.counts(text)]] += 1
            n[-1] += batch.num_rows
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(n)), pa.array(n[np.flatnonzero(n)])], names=["i", "n"])

    out = np.zeros(len(names) + 1, np.int64)
    for r in df.select(F.col(text_col)).mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect():
        out[r["i"]] = r["n"]
    return out


def own_votes(spark: SparkSession, index: BlockIndex) -> list[tuple[int, float]]:
    """The vote of each row of the index without itself, made in tasks; one row each comes back, in the order of the rows."""
    groups = index.groups()
    if not groups:
        return []
    shared = spark.sparkContext.broadcast((index, groups))

    def run(batches):
        known, rows = shared.value
        for batch in batches:
            got = [v for n in batch.column(0).to_pylist() for v in known.votes(rows[n])]
            yield pa.RecordBatch.from_arrays([pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.float64())], names=["row", "vote"])

    parts = min(len(groups), 2 * spark.sparkContext.defaultParallelism)
    out = sorted((r["row"], r["vote"]) for r in spark.range(0, len(groups), 1, parts).mapInArrow(run, "row long, vote double").collect())
    shared.destroy()
    return out


def fitted(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", train_rows: int = TRAIN_ROWS) -> BlockIndex:
    """The index over about train_rows of the given labelled rows (all of them must be free to learn from)."""
    same = df.schema[id_col].dataType == labels.schema[id_col].dataType
    own = (F.col(id_col) if same else F.col(id_col).cast("string")).alias("label_id")  # ids of two types meet as texts
    marks = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(own).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    keep = max(1, math.ceil(marks.count() / train_rows))
    marks = marks.filter(F.pmod(F.xxhash64("label_id", F.lit("toxicity")), F.lit(keep)) == 0)
    texts = df.select(own, F.col(text_col).alias("text"))
    # of an id with several texts the one with the smallest hash, so that the bound holds whatever is repeated
    one = F.min_by("text", F.xxhash64("text")).alias("text")
    train = staged(texts.join(sized(marks), "label_id").groupBy("label_id", "toxic").agg(one).select("label_id", "text", "toxic"), "toxicity-train")
    n, p = (train.select(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first() or (0, 0))[:2]
    share = F.lit(float(p) / max(n, 1))
    gap = F.col("p") - F.col("n") * share
    chi2 = gap * gap / (F.col("n") * share * (1 - share) + 1e-9)
    chosen = term_rows(train).filter(F.col("n") >= LEAST_ROWS).withColumn("chi2", chi2).filter(F.col("chi2") >= LEAST_CHI2)
    names = sorted(r["term"] for r in chosen.select("term").collect())  # of about train_rows texts
    df_counts = frequencies(df, names, text_col)
    idf = np.log((1 + df_counts[-1]) / (1 + df_counts[:-1])) + 1

    def run(batches):
        t = Terms(names)
        for batch in batches:
            for part in slices(batch, 1):
                got = [t.counts(x) for x in part.column(1).to_pylist()]
                numbers = [pa.array([[c[k] for c in g] for g in got], pa.list_(pa.int32())) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers, part.column(2)], names=["id", "t", "c", "toxic"])

    kind = train.schema["label_id"].dataType
    rows = train.select(F.col("label_id").alias("id"), "text", "toxic").mapInArrow(run, f"id {kind.simpleString()}, t array<int>, c array<int>, toxic int").collect()
    index = BlockIndex(names, idf, [tuple(zip(r["t"], r["c"], strict=True)) for r in rows], [r["id"] for r in rows], [r["toxic"] for r in rows])
    index.calibrate(own_votes(df.sparkSession, index))
    index.id_type = kind.simpleString()
    unstaged(train)
    return index


def toxicity_scores(df: DataFrame, index: BlockIndex, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """df with score, predicted, neighbours (ids of training rows) and cosines."""
    shared = df.sparkSession.sparkContext.broadcast(index)

    def make():
        def run(texts: list) -> dict:
            got = [shared.value.score(x) for x in texts]
            return {"score": [g[0] for g in got], "predicted": [int(g[0] >= 0.5) for g in got], "neighbours": [g[1] for g in got], "cosines": [g[2] for g in got]}

        return run

    return map_text(df, make, f"score double, predicted int, neighbours array<{index.id_type}>, cosines array<double>", text_col, keep_text)


def op5_toxicity(spark, sf_dir: str) -> DataFrame:
    """Score of every whole document; labels are learnt from where crc32(doc_id) mod 5 is not 0."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 5) != 0)
    scored = toxicity_scores(docs, fitted(docs, labels), keep_text=False)
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted", "neighbours", "cosines")
