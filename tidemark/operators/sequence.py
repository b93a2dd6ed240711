"""A linear-chain sequence model of token labels: trained with gradients summed in tasks, decoded by Viterbi.

Tokens are seen through hashed features (array<array<int>>), a row is one sequence. A label's score is the sum of the weights of
the token's features and of the step from the label before; features that training did not meet weigh nothing, but that a form
is one of them is a feature. Training maximises
the likelihood less l2 / 2 times the squared weights: each evaluation is one job in which tasks run forward and backward over their
sequences, all sequences of a batch at once, and send one row per feature that they met; the sums meet the weights on the driver,
which takes a quasi-Newton step with a bounded history.

There are two ways to learn. learned takes all tokens of all texts, however many. So that the weights stay few, l1 times their
sizes is taken off as well: most are 0 then, and only features with a weight, or whose slope over all tokens exceeds l1, so that
they must get one, are with the driver and in the evaluations. trained and fitted take label arrays or pieces of a bounded number
and weigh every feature that two tokens have.

Whole texts are labelled in the task that reads them (spans): tokens, features and labels never leave it, only the entities do.
What a token adds to the scores, its own and those of its neighbours, is summed once for each distinct token of a slice of texts.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.entities import LONGEST, ranges, token, tokens
from tidemark.operators.sides import spread

LABELS = ["O", "B-ORG", "I-ORG"]
#: Features are numbered by hash. There are so many numbers that two features hardly ever share one.
DIMS = 1 << 31
#: The number of a form that training did not meet.
UNSEEN = -1
#: Tokens that are scored together, padded to the longest sequence of a batch.
BATCH_TOKENS = 1 << 16
#: Training takes sequences in pieces of so many tokens; trained takes so many pieces at most. Decoding takes whole sequences.
PIECE_TOKENS, MOST_PIECES = 128, 8_000
#: Characters of texts whose tokens learned holds in one row, and tokens that it goes through at a time.
LEARN_CHARS, LEARN_TOKENS = 4_000_000, 1 << 17
#: So many features at most begin to be weighed at a time, the steepest of those outside.
MOST_NEW = 2_000
#: Characters of texts that a task cuts into tokens at a time (at least one whole text).
SLICE_CHARS = 2_000_000
SPANS = "array<struct<start: int, end: int, first_char: int, end_char: int>>"


def own_features(w: str) -> list[str]:
    """What a token says of its own label: the features of entities.token_features that are not null or false, and one that every
    token has."""
    low = w.casefold()
    return [f"lower={low}", f"last3={low[-3:]}", f"last2={low[-2:]}", f"first3={low[:3]}", f"length={min(len(w), LONGEST)}", "bias", *cases(w), *["is_digit"] * w.isdigit(), *["has_digit"] * any(c.isdigit() for c in w)]


def side_features(w: str, side: str) -> list[str]:
    """What a token says of the label after it (side back) or before it (ahead)."""
    return [f"{side}_lower={w.casefold()}", *[f"{side}_{c}" for c in cases(w)]]


def cases(w: str) -> list[str]:
    return ["is_upper"] * (w.upper() == w and w.lower() != w) + ["is_title"] * w.istitle()


def numbered(features: list[str], dims: int) -> list[int]:
    return [zlib.crc32(f.encode()) % dims for f in features]


#: The hashes so far of features that go on with a token or an end of it.
BEGINS = [zlib.crc32(f"{x}=".encode()) for x in ("lower", "last3", "last2", "first3", "back_lower", "ahead_lower")]


class Vocabulary:
    """Numbers of the features of tokens, each token looked at once; forgets all when it is full."""

    def __init__(self, dims: int = DIMS, room: int = 100_000):
        self.dims, self.room, self.seen, self.shared = dims, room, {}, {}
        self.ends = [numbered(["first"], dims), numbered(["last"], dims)]

    def __call__(self, w: str) -> tuple[list[int], list[int], list[int]]:
        """Features of the token itself, those that it gives the token after it and those that it gives the token before it."""
        out = self.seen.get(w)
        if out is None:
            if len(self.seen) >= self.room:
                self.seen.clear()
            out = self.seen[w] = self.looked_at(w)
        return out

    def looked_at(self, w: str) -> tuple[list[int], list[int], list[int]]:
        """The numbers of own_features and of side_features of both sides. Those that many tokens share are looked up, and what
        begins alike is hashed from there on."""
        low, case = w.casefold(), tuple(cases(w))
        shared = (case, min(len(w), LONGEST), w.isdigit(), any(map(str.isdigit, w)))
        if shared not in self.shared:
            _, length, digit, has_digit = shared
            rest = [[f"length={length}", "bias", *case, *["is_digit"] * digit, *["has_digit"] * has_digit], [f"back_{c}" for c in case], [f"ahead_{c}" for c in case]]
            self.shared[shared] = [numbered(f, self.dims) for f in rest]
        own, back, ahead = self.shared[shared]
        whole, dims = low.encode(), self.dims
        after = [zlib.crc32(x, begin) % dims for x, begin in zip((whole, low[-3:].encode(), low[-2:].encode(), low[:3].encode(), whole, whole), BEGINS, strict=True)]
        return after[:4] + own, after[4:5] + back, after[5:] + ahead

    def ids(self, words: list[str], begin: int = 0, end: int | None = None) -> list[list[int]]:
        """Features of the tokens from begin to end of a sequence."""
        n, out = len(words), []
        for i in range(begin, n if end is None else min(end, n)):
            row = list(self(words[i])[0])
            row += self(words[i - 1])[1] if i else self.ends[0]
            row += self(words[i + 1])[2] if i < n - 1 else self.ends[1]
            out.append(row)
        return out


def seen_tokens(df: DataFrame, text: str, words: str = "words", ids: str = "ids", dims: int = DIMS) -> DataFrame:
    """df with the tokens of a text (words) and their hashed features (ids)."""
    vocabulary = Vocabulary(dims)

    @F.pandas_udf("array<array<int>>")
    def hashed(column: pd.Series) -> pd.Series:
        return column.map(lambda row: None if row is None else vocabulary.ids(list(row)))

    return df.withColumn(words, tokens(F.col(text))).withColumn(ids, hashed(F.transform(words, lambda t: t["token"])))


@dataclass
class SequenceModel:
    """weights: features x labels; steps: label before x label; known: the sorted numbers of the features, if these are not the rows
    of weights themselves."""

    weights: np.ndarray
    steps: np.ndarray
    labels: list[str]
    known: np.ndarray | None = None

    def sums(self, flat: np.ndarray, counts: np.ndarray, tokens: bool = True) -> np.ndarray:
        """Summed weights of groups of features, one group after another."""
        if self.known is not None:
            flat, counts = compacted(flat, counts, self.known, tokens)
        out, full = np.zeros((len(counts), len(self.labels))), counts > 0
        if len(flat):
            out[full] = np.add.reduceat(self.weights[flat], (np.cumsum(counts) - counts)[full], axis=0)
        return out

    def scores(self, sequences: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Scores of all tokens, sequence after sequence, lengths, the flat feature numbers and how many each token has."""
        lengths = sequences.value_lengths().to_numpy(zero_copy_only=False)
        tokens = sequences.flatten()
        counts = tokens.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        flat = tokens.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        return self.sums(flat, counts), lengths, flat, counts

    def best(self, sequences: pa.ListArray) -> list[list[str]]:
        """The most likely labels of each sequence; ties go to the label that comes first."""
        out: list = [None] * len(sequences)
        for batch in batches_of(sequences):
            score, lengths, _, _ = self.scores(sequences.take(pa.array(batch)))
            path, ends = self.path(score, lengths), np.cumsum(lengths)
            for i, n, end in zip(batch, lengths.tolist(), ends.tolist(), strict=True):
                out[i] = [self.labels[k] for k in path[end - n : end].tolist()]
        return out

    def path(self, u: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The most likely labels, from the scores of tokens, sequence after sequence.

        Where a token's best label leads by more than all that its neighbours' labels can change, they are what they are without
        it; only the runs between such tokens need a search, and they are short.
        """
        n, steps = len(u), self.steps
        label = u.argmax(1).astype(np.int8)
        if not n:
            return label
        into = np.maximum(0.0, (steps[:, None, :] - steps[:, :, None]).max(0))  # [y, k]: gain of k for y by the step into it
        out_of = np.maximum(0.0, (steps[None, :, :] - steps[:, None, :]).max(2))
        lead = u[np.arange(n), label][:, None] - u - (into + out_of)[label]
        lead[np.arange(n), label] = np.inf
        sure = lead.min(1) > 1e-9
        first = np.zeros(n, bool)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
        last = np.append(first[1:], True)
        open_ = ~sure
        begins = np.flatnonzero(open_ & (first | np.append(True, sure[:-1])))
        ends = np.flatnonzero(open_ & (last | np.append(sure[1:], True)))
        runs = ends - begins + 1
        order = np.argsort(runs, kind="stable")
        at = 0
        while at < len(order):
            many = max(1, BATCH_TOKENS // int(runs[order[at]]))
            part = order[at : at + many]
            while len(part) > 1 and len(part) * runs[part[-1]] > BATCH_TOKENS:
                part = part[: max(1, len(part) // 2)]
            at += len(part)
            size, begin, end = runs[part], begins[part], ends[part]
            flat = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
            x = padded(u[flat], size)
            left, right = ~first[begin], ~last[end]
            x[left, 0] += steps[label[begin[left] - 1]]
            rows = np.arange(len(part))
            x[rows[right], size[right] - 1] += steps[:, label[end[right] + 1]].T
            label[flat] = self.searched(x, size)[np.arange(x.shape[1]) < size[:, None]]
        return label

    def searched(self, u: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Viterbi over padded sequences of one token or more."""
        back, best = np.zeros(u.shape, np.int8), u[:, 0]
        ends = best.copy()
        for t in range(1, u.shape[1]):
            step = best[:, :, None] + self.steps
            back[:, t] = step.argmax(1)
            best = step.max(1) + u[:, t]
            ends = np.where((lengths > t)[:, None], best, ends)
        label = ends.argmax(1)
        path = np.zeros(u.shape[:2], np.int8)
        for t in range(u.shape[1] - 1, -1, -1):
            inside = lengths > t
            path[inside, t] = label[inside]
            label = np.where(inside, back[np.arange(len(label)), t, label], label)
        return path

    def labelled(self, rows: list[list[str]], vocabulary: Vocabulary) -> np.ndarray:
        """The most likely labels of tokens, sequence after sequence."""
        flat, lengths = [w for row in rows for w in row], np.array([len(row) for row in rows], np.int64)
        if not flat:
            return np.zeros(0, np.int8)
        codes, words = pd.factorize(np.array(flat, dtype=object))
        parts = list(zip(*[vocabulary(w) for w in words], strict=True))
        summed = lambda groups, tokens=False: self.sums(np.array([i for g in groups for i in g], np.int64), np.array([len(g) for g in groups], np.int64), tokens)
        own, back, ahead = summed(parts[0], True), summed(parts[1]), summed(parts[2])
        u, ends = own[codes], np.cumsum(lengths)
        inner = np.ones(len(flat), bool)
        inner[(ends - lengths)[lengths > 0]] = False  # tokens with one before them
        u[inner] += back[codes[np.flatnonzero(inner) - 1]]
        u[np.flatnonzero(inner) - 1] += ahead[codes[inner]]
        edge = summed(vocabulary.ends)
        u[~inner] += edge[0]
        u[ends[lengths > 0] - 1] += edge[1]
        return self.path(u, lengths)

    def gradient(self, sequences: pa.ListArray, gold: pa.ListArray) -> tuple[float, np.ndarray, np.ndarray]:
        """Log-likelihood of the labels, its gradient in the weights, and in the steps."""
        total, by_weight, by_step = 0.0, np.zeros_like(self.weights), np.zeros_like(self.steps)
        for batch in batches_of(sequences):
            score, lengths, flat, counts = self.scores(sequences.take(pa.array(batch)))
            labels = gold.take(pa.array(batch)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            u, y = padded(score, lengths), padded(labels[:, None], lengths)[:, :, 0].astype(np.int64)
            inside = np.arange(u.shape[1]) < lengths[:, None]
            high = u.max(2, keepdims=True)
            e, move = np.exp(u - high), np.exp(self.steps)
            a, b, scale = np.zeros_like(e), np.ones_like(e), np.ones(u.shape[:2])
            for t in range(u.shape[1]):
                x = e[:, 0] if t == 0 else (a[:, t - 1] @ move) * e[:, t]
                scale[:, t] = x.sum(1)
                a[:, t] = x / scale[:, t, None]
            for t in range(u.shape[1] - 2, -1, -1):
                x = ((b[:, t + 1] * e[:, t + 1]) @ move.T) / scale[:, t + 1, None]
                b[:, t] = np.where(inside[:, t + 1, None], x, 1.0)
            p = a * b
            total -= float((np.log(scale) + high[:, :, 0])[inside].sum())
            total += float(np.take_along_axis(u, y[:, :, None], 2)[:, :, 0][inside].sum())
            both = inside[:, 1:]
            if both.any():
                pair = a[:, :-1, :, None] * move * (b[:, 1:] * e[:, 1:] / scale[:, 1:, None])[:, :, None, :]
                by_step -= pair[both].sum(0)
                np.add.at(by_step, (y[:, :-1][both], y[:, 1:][both]), 1.0)
                total += float(self.steps[y[:, :-1][both], y[:, 1:][both]].sum())
            away = -p[inside]
            away[np.arange(len(labels)), labels] += 1
            for k in range(len(self.labels)):
                by_weight[:, k] += np.bincount(flat, np.repeat(away[:, k], counts), len(self.weights))
        return total, by_weight, by_step


def compacted(flat: np.ndarray, counts: np.ndarray, known: np.ndarray, tokens: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Places of features among the known ones, without the others, and how many each group has left. In groups that are tokens
    the first feature, the token's form, counts as UNSEEN where it is not known, if UNSEEN is."""
    at = np.searchsorted(known, flat)
    held = at < len(known)
    held[held] = known[at[held]] == flat[held]
    if tokens and len(flat) and len(known) and known[0] == UNSEEN:
        forms = (np.cumsum(counts) - counts)[counts > 0]
        forms = forms[~held[forms]]
        at[forms], held[forms] = np.searchsorted(known, UNSEEN), True
    return at[held], np.bincount(np.repeat(np.arange(len(counts)), counts)[held], minlength=len(counts))


def batches_of(sequences: pa.ListArray) -> Iterator[list[int]]:
    """Places of sequences of similar length, a bounded number of padded tokens at a time."""
    lengths = sequences.value_lengths().to_pylist()
    order = sorted(range(len(lengths)), key=lengths.__getitem__)
    batch: list[int] = []
    for i in order:
        if batch and (len(batch) + 1) * max(1, lengths[i]) > BATCH_TOKENS:
            yield batch
            batch = []
        batch.append(i)
    if batch:
        yield batch


def padded(flat: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Rows of tokens, one sequence after another, as sequences x longest x columns."""
    out = np.zeros((len(lengths), max(1, int(lengths.max(initial=0))), flat.shape[1]), flat.dtype)
    ends = np.cumsum(lengths)
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(ends - lengths, lengths)] = flat
    return out


def summed(rows: DataFrame, model: SequenceModel) -> tuple[float, np.ndarray, np.ndarray]:
    """One evaluation over all rows (ids, gold): each task sends its sums, which are added by feature."""
    dims, k = model.weights.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weights, steps = 0.0, np.zeros((dims, k)), np.zeros((k, k))
        for batch in batches:
            x = model.gradient(batch.column(0), batch.column(1))
            total, weights, steps = total + x[0], weights + x[1], steps + x[2]
        at = np.flatnonzero(weights.any(1))
        number = np.concatenate([at, dims + np.arange(k), [dims + k]])
        values = np.concatenate([weights[at], steps, [[total] + [0.0] * (k - 1)]])
        yield pa.RecordBatch.from_arrays([pa.array(number), *(pa.array(c) for c in values.T)], names=["i", *(f"g{j}" for j in range(k))])

    names = [f"g{j}" for j in range(k)]
    sums = rows.select("ids", "gold").mapInArrow(run, "i long, " + ", ".join(f"{c} double" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).toArrow()
    out = np.zeros((dims + k + 1, k))
    out[sums.column("i").to_numpy()] = np.stack([sums.column(c).to_numpy() for c in names], 1)
    return float(out[-1, 0]), out[:dims], out[dims : dims + k]


def trained(df: DataFrame, gold: str = "gold", ids: str = "ids", labels: list[str] = LABELS, dims: int = DIMS, l2: float = 0.1, rounds: int = 30, most: int = MOST_PIECES, tolerance: float = 1e-4) -> SequenceModel:
    """A model of the label arrays in gold, from at most `most` pieces of sequences (those with the smallest hashes of their
    features; all, if there are no more). Rows without tokens teach nothing; a label that is not among labels is an error."""
    rows = df.filter(F.size(ids) > 0).select(F.col(ids).alias("ids"), F.col(gold).alias("gold"))
    at = F.explode(F.sequence(F.lit(1), F.size("ids"), F.lit(PIECE_TOKENS))).alias("at")
    pieces = rows.select("ids", "gold", at).select(*[F.slice(c, F.col("at"), F.lit(PIECE_TOKENS)).alias(c) for c in ("ids", "gold")])
    pieces = pieces.withColumn("h", F.xxhash64("ids", "gold"))
    edge = pieces.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]  # of hashes alone: pieces are large
    return fitted(pieces.filter(F.col("h") <= edge).orderBy("h").limit(most), labels, dims, l2, rounds, tolerance)


def labeller(names: list[str]) -> Callable[[list[str]], list[str]]:
    """Labels of tokens by a list of names in small letters, each of one or more tokens between spaces: the longest name that
    begins at a token counts, and its tokens begin no other."""
    known: dict[str, list[list[str]]] = {}
    for name in sorted(names, key=lambda n: -len(n.split())):
        known.setdefault(name.split()[0], []).append(name.split())

    def labels(words: list[str]) -> list[str]:
        low, out, end = [x.casefold() for x in words], ["O"] * len(words), 0
        for at in [i for i, x in enumerate(low) if x in known]:
            n = next((len(x) for x in known[low[at]] if low[at : at + len(x)] == x), 0) if at >= end else 0
            if n:
                end = at + n
                out[at:end] = ["B-ORG"] + ["I-ORG"] * (n - 1)
        return out

    return labels


def sampled(df: DataFrame, text: str, label: Callable[[list[str]], list[str]], most: int = MOST_PIECES, dims: int = DIMS) -> DataFrame:
    """At most `most` different pieces (ids, gold) of the texts, labelled as whole texts: those with the smallest hashes of their
    tokens and the tokens beside them. All pieces are hashed first; only those that are chosen leave their task, each once."""
    size, vocabulary = PIECE_TOKENS, Vocabulary(dims)

    def hashes(words: list[str]) -> list[int]:
        seen = ["\n".join([str(at > 0), *words[max(0, at - 1) : at + size + 1]]) for at in range(0, len(words), size)]
        return [int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big", signed=True) for x in seen]

    @F.arrow_udf("array<bigint>")
    def hashed(column: pa.Array) -> pa.Array:
        return pa.array([hashes(token.findall(t.as_py() or "")) for t in column], pa.list_(pa.int64()))

    edge = df.select(F.explode(hashed(text)).alias("h")).distinct().orderBy("h").limit(most).agg(F.max("h")).first()[0]

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = set()
        for batch in batches:
            for texts in slices(batch.column(0)):
                out = []
                for t in texts:
                    words = token.findall(t)
                    new = [(i * size, h) for i, h in enumerate(hashes(words)) if edge is not None and h <= edge and h not in done]
                    labels = label(words) if new else []
                    for at, h in new:
                        if h not in done:
                            done.add(h)
                            out.append((h, vocabulary.ids(words, at, at + size), labels[at : at + size]))
                h, ids, gold = zip(*out, strict=True) if out else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(ids, pa.list_(pa.list_(pa.int32()))), pa.array(gold, pa.list_(pa.string()))], names=["h", "ids", "gold"])

    return df.select(text).mapInArrow(chosen, "h long, ids array<array<int>>, gold array<string>").dropDuplicates(["h"]).select("ids", "gold")


def fitted(pieces: DataFrame, labels: list[str] = LABELS, dims: int = DIMS, l2: float = 0.1, rounds: int = 30, tolerance: float = 1e-4) -> SequenceModel:
    """A model of a bounded number of pieces (ids, gold). A feature that one token only has is not learned; if it is the token's
    form (its first feature), the token teaches instead what is to be thought of forms that were not learned."""
    known = F.array(*[F.lit(x) for x in labels])
    number = F.transform("gold", lambda x: F.when(F.array_contains(known, x), F.array_position(known, x) - 1).otherwise(F.raise_error(F.lit("unknown label"))).cast("int"))
    spark = pieces.sparkSession
    raw = pieces.select("ids", number.alias("gold")).repartition(spark.sparkContext.defaultParallelism).persist()
    rows = None
    try:
        met = raw.select(F.explode(F.flatten("ids")).alias("i")).groupBy("i").count().filter("count > 1").select("i").toArrow()
        features = np.append(UNSEEN, np.sort(met.column("i").to_numpy().astype(np.int64)))

        def compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sequences = batch.column(0)
                words = sequences.flatten()
                flat, counts = compacted(words.flatten().to_numpy(zero_copy_only=False), words.value_lengths().to_numpy(zero_copy_only=False), features)
                ends = lambda n: pa.array(np.append(0, np.cumsum(n)), pa.int32())
                inner = pa.ListArray.from_arrays(ends(counts), pa.array(flat, pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends(sequences.value_lengths().to_numpy(zero_copy_only=False)), inner), batch.column(1)], names=["ids", "gold"])

        rows = raw.mapInArrow(compact, "ids array<array<int>>, gold array<int>").persist()
        rows.count()
        raw.unpersist()
        weights, steps = maximised(rows, len(features), labels, l2, rounds, tolerance)
    finally:
        raw.unpersist()
        if rows is not None:
            rows.unpersist()
    return SequenceModel(weights, steps, list(labels), features)


def maximised(rows: DataFrame, dims: int, labels: list[str], l2: float, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights and steps of the greatest penalised likelihood; rows: ids under dims, gold as numbers of labels."""
    k = len(labels)
    model = SequenceModel(np.zeros((dims, k)), np.zeros((k, k)), list(labels))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        at = SequenceModel(x[: dims * k].reshape(dims, k), x[dims * k :].reshape(k, k), model.labels)
        total, by_weight, by_step = summed(rows, at)
        return -total + l2 / 2 * float(x @ x), l2 * x - np.concatenate([by_weight.ravel(), by_step.ravel()])

    x = descended(loss, np.zeros(dims * k + k * k), rounds, tolerance)
    return x[: dims * k].reshape(dims, k), x[dims * k :].reshape(k, k)


def descended(loss, x: np.ndarray, rounds: int, tolerance: float, memory: int = 6, l1: float = 0.0, history: list | None = None) -> np.ndarray:
    """A minimum of the loss and l1 times the sizes of x, by limited-memory quasi-Newton steps; a step is halved until it lowers
    the sum enough. With l1 a step goes by the side on which the sum falls at 0, and what would change its sign becomes 0. history,
    where it is given, holds the last steps of an earlier call and takes those of this one."""

    def side(x: np.ndarray, slope: np.ndarray) -> np.ndarray:
        at_zero = np.sign(slope) * np.maximum(np.abs(slope) - l1, 0.0)
        return np.where(x == 0, at_zero, slope + l1 * np.sign(x)) if l1 else slope

    history = [] if history is None else history
    value, slope = loss(x)
    value += l1 * float(np.abs(x).sum())
    for _ in range(rounds):
        steep = side(x, slope)
        way, kept = -steep, []
        for s, y, r in reversed(history):
            kept.append(r * (s @ way))
            way = way - kept[-1] * y
        if history:
            s, y, r = history[-1]
            way = way / (r * (y @ y))
        else:
            way = way / max(1.0, float(np.linalg.norm(steep)))
        for (s, y, r), a in zip(history, reversed(kept), strict=True):
            way = way + (a - r * (y @ way)) * s
        if l1:
            way = np.where(way * steep < 0, way, 0.0)
        sign, size = np.where(x == 0, -np.sign(steep), np.sign(x)), 1.0
        while True:
            to = x + size * way
            to = np.where(to * sign > 0, to, 0.0) if l1 else to
            after, after_slope = loss(to)
            after += l1 * float(np.abs(to).sum())
            if after <= value + 1e-4 * float(steep @ (to - x)) or size < 1e-6:
                break
            size /= 2
        if size < 1e-6:
            break
        s, y = to - x, after_slope - slope
        if s @ y > 1e-12:
            history[:] = [*history, (s, y, 1.0 / float(s @ y))][-memory:]
        done = value - after <= tolerance * max(1.0, abs(value))
        x, value, slope = to, after, after_slope
        if done:
            break
    return x


#: What rows of learned hold: the tokens of texts (begin and end of a text are 0 and 1) and their labels, the places and lengths of the
#: pieces, the features of each distinct token and how many it has for itself, the token after and the token before it.
CUT = {"codes": np.int32, "gold": np.int8, "starts": np.int32, "lengths": np.int32, "ids": np.int32, "counts": np.uint8}
#: The same by contexts: that of each token, piece by piece (in_order), the sets of weighed features that make a context (a token's own
#: and those by its neighbours) and how many tokens it has; the features of each set and how often it has each label, and how often a
#: label follows another.
MET = {"at": np.int32, "lengths": np.int32, "sets": np.int32, "many": np.int32, "flat": np.int32, "counts": np.int32, "gold": np.int32, "pairs": np.int64}
#: The same without the order of the tokens.
APART = {c: MET[c] for c in ("sets", "many", "flat", "counts", "gold")}


def ddl(kinds: dict) -> str:
    return ", ".join(f"{c} binary" for c in kinds)


def stored(kinds: dict, parts: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(parts[c], kind).tobytes()], pa.binary()) for c, kind in kinds.items()], names=list(kinds))


def loaded(kinds: dict, batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {c: np.frombuffer(batch.column(j)[i].as_py(), kind) for j, (c, kind) in enumerate(kinds.items())}


def cut(texts: list[str], label: Callable[[list[str]], list[str]], labels: list[str], dims: int) -> dict | None:
    """CUT of some texts; None if they have no tokens."""
    known, number, vocabulary = {}, {x: i for i, x in enumerate(labels)}, Vocabulary(dims, 1)
    codes, gold, starts, lengths, at = [], [], [], [], 0
    for t in texts:
        words = token.findall(t)
        if words:
            codes.append(np.array([0, *[known.setdefault(w, len(known) + 2) for w in words], 1], np.int32))
            gold.append(np.array([0, *[number[y] for y in label(words)], 0], np.int8))
            begins = np.arange(0, len(words), PIECE_TOKENS)
            starts.append(at + 1 + begins)
            lengths.append(np.minimum(PIECE_TOKENS, len(words) - begins))
            at += len(words) + 2
    if not codes:
        return None
    first, last = vocabulary.ends
    own, back, ahead = zip(([], first, []), ([], [], last), *[vocabulary(w) for w in known], strict=True)
    ids = [i for groups in (own, back, ahead) for g in groups for i in g]
    lengths, order = np.concatenate(lengths), np.argsort(-np.concatenate(lengths), kind="stable")
    return {"codes": np.concatenate(codes), "gold": np.concatenate(gold), "starts": np.concatenate(starts)[order], "lengths": lengths[order], "ids": ids, "counts": [len(g) for groups in (own, back, ahead) for g in groups]}


def parted(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of pieces, the longest first, with a bounded number of tokens."""
    ends, a = np.cumsum(lengths), 0
    while a < len(lengths):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] - lengths[a] + LEARN_TOKENS, side="right")))
        yield a, b
        a = b


def in_order(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the tokens of pieces: part by part (parted), in a part all first tokens, then all second ones, and so on."""
    out = []
    for a, b in parted(lengths):
        step = np.arange(lengths[a])[:, None]
        out.append((starts[a:b] + step)[step < lengths[a:b]])
    return np.concatenate(out)


def weighed(ids: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which features are among the known ones (sorted), and their places there."""
    near = np.zeros(1 << 16, bool)
    near[known & 0xFFFF] = True  # most others are seen by their last bits
    hit = np.flatnonzero(near[ids & 0xFFFF])
    at = np.minimum(np.searchsorted(known, ids[hit]), len(known) - 1)
    same = known[at] == ids[hit]
    return hit[same], at[same]


def contexts(part: dict, known: np.ndarray, k: int) -> dict:
    """MET of CUT: tokens with the same weighed features, their own and those by their neighbours, are one context."""
    n = len(part["counts"]) // 3
    hit, at = weighed(part["ids"], known)
    size = np.bincount(np.repeat(np.arange(3 * n), part["counts"])[hit], minlength=3 * n)
    begin = np.cumsum(size) - size
    mark = np.zeros(3 * n, np.uint64)  # of a set of features, by 64 bits of each
    mixed = np.frombuffer(b"".join(hashlib.blake2b(x.tobytes(), digest_size=8).digest() for x in known), np.uint64)
    if len(at):
        mark[size > 0] = np.add.reduceat(mixed[at], begin[size > 0])
    sets = [np.unique(mark[r * n : r * n + n], return_index=True, return_inverse=True)[1:] for r in range(3)]
    places = in_order(part["starts"], part["lengths"])
    key = np.zeros(len(places), np.int64)
    for r, (firsts, of) in enumerate(sets):
        key = key * len(firsts) + of[part["codes"][places + (0, -1, 1)[r]]]
    token_at, keys = pd.factorize(key)
    y, gold, in_sets, words, at_set = part["gold"][places].astype(np.int64), [], [], [], sum(len(firsts) for firsts, _ in sets)
    for r, (firsts, of) in reversed(list(enumerate(sets))):
        keys, mine = np.divmod(keys, len(firsts))
        at_set -= len(firsts)
        in_sets.append(mine + at_set)
        words.append(firsts + r * n)
        gold.append(np.bincount(mine[token_at] * k + y, minlength=len(firsts) * k))
    words, gold = np.concatenate(words[::-1]), np.concatenate(gold[::-1])
    sizes = size[words]
    flat = at[np.repeat(begin[words] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())]
    pairs, at_token = np.zeros(k * k, np.int64), 0
    for a, b in parted(part["lengths"]):
        for before, after in steps_of(part["lengths"][a:b], at_token):
            pairs += np.bincount(y[before] * k + y[after], minlength=k * k)
        at_token += int(part["lengths"][a:b].sum())
    return {"at": token_at, "lengths": part["lengths"], "sets": np.concatenate(in_sets[::-1]), "many": np.bincount(token_at), "flat": flat, "counts": sizes, "gold": gold, "pairs": pairs}


def steps_of(lengths: np.ndarray, at: int = 0) -> list[tuple[slice, slice]]:
    """Places of tokens of a part that begins at a place, and of those that follow them, step by step."""
    live = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")
    begin = at + np.cumsum(live) - live
    return [(slice(a, a + n), slice(b, b + n)) for a, b, n in zip(begin[:-1].tolist(), begin[1:].tolist(), live[1:].tolist(), strict=True)]


def chances(part: dict, score: np.ndarray, steps: np.ndarray) -> Iterator[tuple[int, float, np.ndarray, np.ndarray]]:
    """Of each part of MET: where it begins, the logarithm of the sum over all label sequences, the chances of each token's labels
    (labels x tokens) and the expected steps. score: labels x contexts."""
    high = score.max(0)
    table, move, begin = np.exp(score - high), np.exp(steps), 0
    for a, b in parted(part["lengths"]):
        lengths = part["lengths"][a:b]
        at = part["at"][begin : begin + int(lengths.sum())]
        e = table[:, at]
        forward, scale, follow = np.empty_like(e), np.empty(len(at)), steps_of(lengths)
        first = b - a
        scale[:first] = e[:, :first].sum(0)
        forward[:, :first] = e[:, :first] / scale[:first]
        for before, after in follow:
            x = (move.T @ forward[:, before]) * e[:, after]
            scale[after] = x.sum(0)
            np.divide(x, scale[after], out=forward[:, after])
        e /= scale
        backward = np.ones_like(e)
        for before, after in reversed(follow):
            backward[:, before] = move @ (backward[:, after] * e[:, after])
        p = forward * backward
        by_step = np.zeros_like(steps)
        if follow:
            backward *= e
            by_step = move * (np.concatenate([forward[:, before] for before, _ in follow], 1) @ backward[:, first:].T)
        yield begin, float(np.log(scale).sum() + high[at].sum()), p, by_step
        begin += len(at)


def scored(part: dict, weights: np.ndarray) -> tuple[np.ndarray, float]:
    """Scores of the contexts of MET (labels x contexts), and the summed scores of the labels that its tokens have."""
    of, n = np.repeat(np.arange(len(part["counts"])), part["counts"]), len(part["counts"])
    by_set = np.stack([np.bincount(of, w[part["flat"]], n) for w in weights.T])
    own, back, ahead = part["sets"].reshape(3, -1)
    return by_set[:, own] + by_set[:, back] + by_set[:, ahead], float((part["gold"].reshape(n, -1).T * by_set).sum())


def by_feature(part: dict, expected: np.ndarray, features: int) -> np.ndarray:
    """Slopes in the weights, from how often each context of MET is expected to have each label but the first."""
    k, n = len(expected) + 1, len(part["counts"])
    of, away = np.repeat(np.arange(n), part["counts"]), part["gold"].reshape(n, k).T.astype(float)
    for sets in part["sets"].reshape(3, -1):
        for y in range(1, k):
            away[y] -= np.bincount(sets, expected[y - 1], n)
    away[0] = -away[1:].sum(0)  # chances sum to 1
    return np.stack([np.bincount(part["flat"], x[of], features) for x in away], 1)


def slopes(part: dict, weights: np.ndarray, steps: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels of MET, its slope in the weights, and in the steps."""
    k, n, pairs = len(steps), len(part["many"]), part["pairs"].reshape(steps.shape)
    score, total = scored(part, weights)
    total, expected, by_step = total + float((pairs * steps).sum()), np.zeros((k - 1, n)), pairs.astype(float)
    for begin, log_sum, p, moves in chances(part, score, steps):
        at = part["at"][begin : begin + p.shape[1]]
        for y in range(1, k):
            expected[y - 1] += np.bincount(at, p[y], n)
        total, by_step = total - log_sum, by_step - moves
    return total, by_feature(part, expected, len(weights)), by_step


def slopes_apart(part: dict, weights: np.ndarray) -> tuple[float, np.ndarray]:
    """slopes of APART without steps: tokens of one context are alike."""
    score, total = scored(part, weights)
    high = score.max(0)
    e = np.exp(score - high)
    z = e.sum(0)
    return total - float((part["many"] * (np.log(z) + high)).sum()), by_feature(part, e[1:] * (part["many"] / z), len(weights))


def steep_features(part: dict, known: np.ndarray, weights: np.ndarray, steps: np.ndarray, least: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood of the labels of CUT, and all features with a slope over least in a label, with their slopes."""
    k, n = len(steps), len(part["counts"]) // 3
    met, places = contexts(part, known, k), in_order(part["starts"], part["lengths"])
    score, total = scored(met, weights)
    total += float((met["pairs"].reshape(k, k) * steps).sum())
    away = np.zeros((k, 3 * n))
    for begin, log_sum, p, _ in chances(met, score, steps):
        at = places[begin : begin + p.shape[1]]
        np.negative(p, out=p)
        p[part["gold"][at], np.arange(len(at))] += 1
        for r, near in enumerate((0, -1, 1)):
            code = part["codes"][at + near]
            for y in range(k):
                away[y, r * n : r * n + n] += np.bincount(code, p[y], n)
        total -= log_sum
    of = np.repeat(np.arange(3 * n), part["counts"])
    numbers, place = np.unique(part["ids"], return_inverse=True)
    sums = np.stack([np.bincount(place, x[of], len(numbers)) for x in away], 1)
    steep = np.abs(sums).max(1) > least
    return total, numbers[steep], sums[steep]


def learned(df: DataFrame, text: str, label: Callable[[list[str]], list[str]], labels: list[str] = LABELS, dims: int = DIMS, l1: float = 0.1, l2: float = 0.1, rounds: int = 60, tolerance: float = 1e-2) -> SequenceModel:
    """A model of all tokens of all texts, each as often as it occurs: the greatest likelihood of the labels that label gives, less
    l1 times the sizes of the weights and l2 / 2 times their squares.

    The texts are cut into tokens once. The features whose slope exceeds a thousandth of the tokens come first, and are weighed
    without steps first, which looks at each context once however many tokens it has; from there on whole sequences count. Then
    features outside whose slope exceeds l1 over all texts come in. The others have none over l1, so their best weight is 0. It ends
    when there is none left to come in, or when those that came in last changed the sum by no more than the tolerance."""
    k = len(labels)

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, room = [], LEARN_CHARS
        for batch in batches:
            for t in batch.column(0):
                t = t.as_py() or ""
                if texts and len(t) > room:
                    if part := cut(texts, label, labels, dims):
                        yield stored(CUT, part)
                    texts, room = [], LEARN_CHARS
                texts.append(t)
                room -= len(t)
        if texts and (part := cut(texts, label, labels, dims)):
            yield stored(CUT, part)

    raw = spread(df.select(text), 2).mapInArrow(cut_up, ddl(CUT)).persist(StorageLevel.DISK_ONLY)  # rows of megabytes
    try:
        parts, tokens = raw.agg(F.count("*"), F.coalesce(F.sum(F.length("gold")), F.lit(0))).first()
        known, x, history, before = np.array(numbered(["bias"], dims)), np.zeros((k + 1) * k), [], np.inf
        if parts:
            known = np.append(known, outside(raw, known, x[k * k :].reshape(-1, k), x[: k * k].reshape(k, k), max(l1, tokens / 1000), parts)[1])
            x = lowered(raw, known, np.zeros((len(known) + k) * k), k, l1, l2, rounds, tolerance, history, chained=False)
            kept = np.append(np.ones(k, bool), x[k * k :].reshape(-1, k).any(1))
            known, kept = known[kept[k:]], np.repeat(kept, k)
            x, history = x[kept], [(s[kept], y[kept], r) for s, y, r in history]
        while parts:
            x = lowered(raw, known, x, k, l1, l2, rounds, tolerance, history)
            order = np.argsort(known)
            total, new = outside(raw, known[order], x[k * k :].reshape(-1, k)[order], x[: k * k].reshape(k, k), l1, parts)
            value = -total + l1 * float(np.abs(x).sum()) + l2 / 2 * float(x @ x)
            if not len(new) or before - value <= tolerance * max(1.0, value):
                break
            known, before = np.append(known, new), value
            longer = lambda v: np.append(v, np.zeros((len(known) + k) * k - len(v)))
            x, history = longer(x), [(longer(s), longer(y), r) for s, y, r in history]
    finally:
        raw.unpersist()
    weights, order = x[k * k :].reshape(-1, k), np.argsort(known)
    order = order[weights[order].any(1)]
    return SequenceModel(weights[order], x[: k * k].reshape(k, k), list(labels), known[order])


def outside(raw: DataFrame, known: np.ndarray, weights: np.ndarray, steps: np.ndarray, bound: float, parts: int) -> tuple[float, np.ndarray]:
    """Log-likelihood over all rows, and the features, steepest first, that are not known and whose slope exceeds the bound in a
    label. A row leaves out slopes that over all rows can't add up to a tenth of the bound, so one of nine tenths counts."""
    k = len(steps)
    names = [f"g{j}" for j in range(k)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in loaded(CUT, batches):
            total, numbers, sums = steep_features(part, known, weights, steps, bound / 10 / parts)
            rest = ~np.isin(numbers, known)
            numbers, sums = np.append(numbers[rest].astype(np.int64), -1), np.vstack([sums[rest], [total] + [0.0] * (k - 1)])
            yield pa.RecordBatch.from_arrays([pa.array(numbers), *(pa.array(c) for c in sums.T)], names=["i", *names])

    sums = raw.mapInArrow(run, "i long, " + ", ".join(f"{c} double" for c in names)).groupBy("i").agg(*[F.sum(c).alias(c) for c in names])
    steep = F.greatest(*[F.abs(c) for c in names])
    found = sums.select("i", "g0", F.when(F.col("i") < 0, float("inf")).otherwise(steep).alias("steep")).filter(F.col("steep") > 0.9 * bound).orderBy(F.desc("steep"), "i").limit(MOST_NEW + 1).toArrow()
    return float(found.column("g0")[0].as_py()), found.column("i").to_numpy()[1:]


def lowered(raw: DataFrame, known: np.ndarray, x: np.ndarray, k: int, l1: float, l2: float, rounds: int, tolerance: float, history: list, chained: bool = True) -> np.ndarray:
    """Steps and weights (by feature, as known has them) of the greatest penalised likelihood, from x on; without chained the steps
    are left at 0. Each evaluation is one job with a task for each core; a task sends one sum of its rows."""
    order, kinds = np.argsort(known), MET if chained else APART
    ordered, cores = known[order], raw.sparkSession.sparkContext.defaultParallelism

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in loaded(CUT, batches):
            yield stored(kinds, contexts(part, ordered, k))

    met = raw.mapInArrow(meet, ddl(kinds)).persist(StorageLevel.DISK_ONLY)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        weights, steps = x[k * k :].reshape(-1, k)[order], x[: k * k].reshape(k, k)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros((1 + k + len(weights), k))
            for part in loaded(kinds, batches):
                total, by_weight, by_step = slopes(part, weights, steps) if chained else (*slopes_apart(part, weights), np.zeros((k, k)))
                sums += np.vstack([[total] + [0.0] * (k - 1), by_step, by_weight])
            yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], names=["sums"])

        sums = met.coalesce(cores).mapInArrow(run, "sums binary").toArrow().column("sums")
        out = sum(np.frombuffer(one.as_py()) for one in sums).reshape(-1, k)
        by_weight = np.empty_like(weights)
        by_weight[order] = out[1 + k :]
        return -float(out[0, 0]) + l2 / 2 * float(x @ x), l2 * x - np.concatenate([out[1 : 1 + k].ravel(), by_weight.ravel()])

    try:
        return descended(loss, x, rounds, tolerance, memory=20, l1=l1, history=history)
    finally:
        met.unpersist()


def predicted(df: DataFrame, model: SequenceModel, ids: str = "ids", out: str = "predicted") -> DataFrame:
    """df with the most likely labels of each token; an empty array for a row without tokens, null for null."""

    @F.arrow_udf("array<string>")
    def decode(column: pa.Array) -> pa.Array:
        full = np.flatnonzero(~column.is_null().to_numpy(zero_copy_only=False))
        done: list = [None] * len(column)
        for i, labels in zip(full.tolist(), model.best(column.take(pa.array(full))), strict=True):
            done[i] = labels
        return pa.array(done, pa.list_(pa.string()))

    return df.withColumn(out, decode(F.col(ids)))


def slices(texts: pa.Array) -> Iterator[list[str]]:
    """Texts (null: empty), a bounded number of characters or one text at a time."""
    part, room = [], SLICE_CHARS
    for t in texts:
        t = t.as_py() or ""
        if part and len(t) > room:
            yield part
            part, room = [], SLICE_CHARS
        part.append(t)
        room -= len(t)
    if part:
        yield part


def entity_spans(text: Column, labels: Callable[[list[list[str]]], np.ndarray]) -> Column:
    """The entities of whole texts (SPANS), as places of tokens and of characters, ends excluded; as from entities.ranges. labels
    gives the numbers (in LABELS) of the labels of token sequences, one after another."""

    @F.arrow_udf(SPANS)
    def run(column: pa.Array) -> pa.Array:
        counts, found = [np.zeros(0, np.int64)], [np.zeros((0, 4), np.int64)]
        for texts in slices(column):
            cut = [[m.span() for m in token.finditer(t)] for t in texts]
            y = labels([[t[a:b] for a, b in places] for t, places in zip(texts, cut, strict=True)])
            lengths = np.array([len(places) for places in cut], np.int64)
            offset = np.cumsum(lengths) - lengths
            first = np.zeros(len(y), bool)
            first[offset[lengths > 0]] = True
            begin = np.flatnonzero((y == 1) | ((y == 2) & (first | (np.append(0, y[:-1]) == 0))))
            stops = np.append(np.flatnonzero((y != 2) | first), len(y))
            end = stops[np.searchsorted(stops, begin, side="right")]
            row = np.searchsorted(offset + lengths, begin, side="right")
            flat = [p for places in cut for p in places]
            chars = [(flat[a][0], flat[b - 1][1]) for a, b in zip(begin.tolist(), end.tolist(), strict=True)]
            counts.append(np.bincount(row, minlength=len(texts)))
            found.append(np.column_stack([begin - offset[row], end - offset[row], np.array(chars, np.int64).reshape(-1, 2)]))
        fields = [pa.array(c, pa.int32()) for c in np.concatenate(found).T]
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(np.concatenate(counts))), pa.int32()), pa.StructArray.from_arrays(fields, names=["start", "end", "first_char", "end_char"]))

    return run(text)


def by_model(model: SequenceModel, dims: int = DIMS) -> Callable[[list[list[str]]], np.ndarray]:
    """Labels as entity_spans takes them."""
    number, vocabulary = np.array([LABELS.index(x) for x in model.labels], np.int8), Vocabulary(dims)
    return lambda rows: number[model.labelled(rows, vocabulary)]


def by_names(names: list[str]) -> Callable[[list[list[str]]], np.ndarray]:
    """Labels as entity_spans takes them."""
    label, number = labeller(names), {x: i for i, x in enumerate(LABELS)}
    return lambda rows: np.array([number[x] for words in rows for x in label(words)], np.int8)


def name_labels(words: Column, names: list[str]) -> Column:
    """Labels of tokens by a list of names (labeller)."""
    one = labeller(names)

    @F.pandas_udf("array<string>")
    def label(column: pd.Series) -> pd.Series:
        return column.map(lambda words: None if words is None else one(words))

    return label(F.transform(words, lambda w: w["token"]))


def mentions(df: DataFrame, text: str, words: str = "words", labels: str = "predicted") -> DataFrame:
    """A row for each entity of each row: the columns of df but words and labels, with mention, start and end in characters."""
    rest = [f"`{c}`" for c in df.columns if c not in (words, labels)]
    found = df.select(*rest, F.col(words).alias("_w"), F.explode(ranges(F.col(labels))).alias("_r"))
    begin, end = F.get("_w", F.col("_r.start"))["start"], F.get("_w", F.col("_r.end") - 1)["end"]
    return found.withColumns({"start": begin, "end": end}).withColumn("mention", F.substr(F.col(text), F.col("start") + 1, F.col("end") - F.col("start"))).drop("_w", "_r")
