"""Operator 12: importance resampling of documents towards the texts of a target.

Method: features are the words of a text and its pairs of neighbouring words, hashed into buckets by crc32. In each slice of
texts the distinct features are grouped by equal length into two-dimensional uint8 arrays, the CRCs of all of a group are
updated together column by column, and the buckets are scattered back to the places of the features. A bucket's gain is the
log-ratio of its smoothed shares in the target and in the corpus; a document's weight is its mean gain, to which noise of a
Gumbel distribution is added, so that the highest scores are a draw without replacement.

Plan: texts are read once; the buckets of each row are written (two bytes for each feature) and read twice, for the counts
and for the weights. Counts are summed inside tasks to one row per bucket; the gains, a list as long as there are buckets,
go to the tasks. The draw needs no global sort: rows are counted by score (whole numbers in a bounded range, at most some
100,000 of them), the counts are summed from above, and ids are ordered only inside one score, in which the noise puts at
most about 0.04 % of the rows, whatever the texts.

Defined results: a null or empty text, or one without words, has no features and a weight of 0; very long texts are used
whole; a null id is hashed as an empty one; repeated rows each take part, and among rows with one id and one score the one with
more features comes first; of an empty table nothing is drawn; without a target text all t are 0. Other columns than id and
text are not looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, sized, slices, staged, table, unstaged

BUCKETS, MIN_WORDS, PERCENT, SEED = 10_000, 20, 25, 7

#: Features longer than this are rare; each is summed by itself.
MATRIX_BYTES = 256
MATRIX_CELLS = 1 << 22


def crc_table() -> np.ndarray:
    x = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        x = np.where(x & 1, (x >> 1) ^ np.uint32(0xEDB88320), x >> 1)
    return x


def letter_table() -> np.ndarray:
    """Lower-cased byte of each byte of a word, 0 for the bytes between words."""
    x = np.arange(256, dtype=np.uint8)
    word = (x >= 0x80) | (x >= 0x30) & (x <= 0x39) | (x >= 0x61) & (x <= 0x7A)
    return np.where((x >= 0x41) & (x <= 0x5A), x + 32, np.where(word, x, 0)).astype(np.uint8)


CRC, LETTERS = crc_table(), letter_table()


def crc_columns(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """crc32 of each data[start : start + length]: one matrix for all of one length, updated column by column."""
    out = np.empty(len(starts), np.uint32)
    order = np.argsort(lengths, kind="stable")
    cuts = np.flatnonzero(np.diff(lengths[order])) + 1
    for group in np.split(order, cuts):
        length = int(lengths[group[0]]) if len(group) else 0
        if length > MATRIX_BYTES:
            for i in group:
                out[i] = zlib.crc32(data[starts[i] : starts[i] + length].tobytes())
            continue
        step = max(1, MATRIX_CELLS // max(1, length))
        for part in (group[i : i + step] for i in range(0, len(group), step)):
            matrix = data[starts[part] + np.arange(length)[:, None]]
            crc = np.full(len(part), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = CRC[(crc ^ column) & 0xFF] ^ (crc >> np.uint32(8))
            out[part] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def distinct(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each value the number of its distinct value, and for each distinct value the first place it is found at."""
    numbers = values.dictionary_encode()
    at = numbers.indices.to_numpy()
    first = np.empty(len(numbers.dictionary), np.int64)
    first[at[::-1]] = np.arange(len(at) - 1, -1, -1)
    return at, first


def feature_buckets(texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Of some texts (null: none) the number of words of each, and the buckets of all features, text after text."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    low = LETTERS[raw]
    inside = low != 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < len(raw))]  # words end with their text
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    owner = np.searchsorted(offsets, starts, "right") - 1
    n_words = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    if not len(starts):
        return n_words, np.empty(0, np.uint16)
    lengths = stops - starts
    # All words of the slice, with one space after each: every feature is a stretch of it.
    spaced = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    at = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    letters = low[inside]
    spaced[np.arange(len(letters)) + np.repeat(np.arange(len(lengths)), lengths)] = letters
    ends_of = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(ends_of.astype(np.int64)), pa.py_buffer(letters)])
    word, first = distinct(words)
    left = np.flatnonzero(owner[:-1] == owner[1:])
    pair, first_pair = distinct(pa.array(word[left].astype(np.int64) * len(first) + word[left + 1]))
    first_pair = left[first_pair]
    crc = crc_columns(spaced, np.concatenate([at[first], at[first_pair]]), np.concatenate([lengths[first], lengths[first_pair] + 1 + lengths[first_pair + 1]]))
    found = (crc % buckets).astype(np.uint16)
    # Back to their places: of each text first the words, then the pairs.
    before = np.concatenate([[0], np.cumsum(n_words)[:-1]])
    pairs_before = np.concatenate([[0], np.cumsum(np.maximum(n_words - 1, 0))[:-1]])
    out = np.empty(len(word) + len(pair), np.uint16)
    out[np.arange(len(word)) + pairs_before[owner]] = found[: len(first)][word]
    out[np.arange(len(pair)) + (before + n_words)[owner[left]]] = found[len(first) :][pair]
    return n_words, out


def bucket_rows(df: DataFrame, id_col: str, text_col: str, buckets: int) -> DataFrame:
    """(id, n_words, buckets): the buckets of a row's features, two bytes each."""
    kind = df.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                n_words, found = feature_buckets(part.column(1), buckets)
                ends = np.concatenate([[0], np.cumsum(n_words + np.maximum(n_words - 1, 0)) * 2]).astype(np.int32)
                packed = pa.BinaryArray.from_buffers(pa.binary(), len(n_words), [None, pa.py_buffer(ends), pa.py_buffer(found)])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n_words), packed], names=["id", "n_words", "buckets"])
        give_back()

    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_words long, buckets binary")


def bucket_counts(rows: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: one row per bucket and task is summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for x in batch.column(0):
                n += np.bincount(np.frombuffer(x.as_buffer(), np.uint16), minlength=buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in rows.select("buckets").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # one row per bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log-ratio of the smoothed shares, floored."""
    s_all, t_all, k = int(corpus.sum()), int(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log(float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(key: str) -> int:
    """Thousandths of a Gumbel variate made from a hash of the key, floored."""
    h = int(hashlib.sha256(key.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(rows: DataFrame, gain: np.ndarray, seed: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight, n_features = [], []
            for x in batch.column(2):
                found = np.frombuffer(x.as_buffer(), np.uint16)
                n_features.append(len(found))
                weight.append(int(gain[found].sum()) // len(found) if len(found) else 0)
            score = [w + noise(f"{seed}:{'' if i is None else i}") for w, i in zip(weight, batch.column(0).to_pylist(), strict=True)]
            made = [pa.array(v, pa.int64()) for v in (n_features, weight, score)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=["id", "n_words", "n_features", "weight", "score"])
        give_back()

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long, score long")


def importance_ranks(
    df: DataFrame,
    target: DataFrame,
    percent: int = PERCENT,
    min_words: int = MIN_WORDS,
    buckets: int = BUCKETS,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """A row for each row of df: its id, n_words, n_features, weight, score and rank; rank is null for rows that are not drawn.

    Of the rows with at least min_words words floor(percent * rows / 100) are drawn, the highest scores first. buckets is at
    most 65,536.
    """
    rows = staged(bucket_rows(df, id_col, text_col, buckets), "feature-buckets")
    wanted = bucket_counts(bucket_rows(target.select(F.lit(0).alias("__id"), target_col), "__id", target_col, buckets), buckets)
    scores = staged(scored(rows, gains(bucket_counts(rows, buckets), wanted), seed), "resampling-scores")
    unstaged(rows)
    able = scores.filter(F.col("n_words") >= min_words)
    above = F.sum("n").over(Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1))
    steps = staged(able.groupBy("score").agg(F.count("*").alias("n")).withColumn("above", F.coalesce(above, F.lit(0))), "score-counts")
    total = steps.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    draws = percent * total // 100
    near = able.join(sized(steps.filter(F.col("above") < draws).select("score", "above")), "score", "left")
    place = F.row_number().over(Window.partitionBy("score").orderBy("id", F.desc("n_features"), "weight", "n_words"))
    ranked = near.filter("above is not null").withColumn("rank", F.col("above") + place)
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")).cast("long"))
    others = near.filter("above is null").unionByName(scores.filter(F.col("n_words") < min_words), allowMissingColumns=True).withColumn("rank", F.lit(None).cast("long"))
    columns = ["n_words", "n_features", "weight", "score", "rank"]
    return ranked.unionByName(others).select(F.col("id").alias(id_col), *columns)


def resampled(df: DataFrame, target: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The rows of df whose id was drawn, as they are; rows that share an id come together."""
    drawn = importance_ranks(df, target, id_col=id_col, **options).filter("rank is not null").select(F.col(id_col).alias("__drawn")).distinct()
    return df.join(sized(drawn), F.col(f"`{id_col}`").eqNullSafe(F.col("__drawn")), "left_semi")


def op12_importance_resample(spark, sf_dir: str) -> DataFrame:
    """A quarter of the documents of at least 20 words, drawn towards the benchmark's texts."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranks = importance_ranks(docs, table(spark, sf_dir, "benchmark"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS n, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY n) AS crc FROM bits WHERE k = 8
), texts AS (
  SELECT 'd' AS side, doc_id AS id, text FROM documents UNION ALL SELECT 't', item_id, text FROM benchmark
), split AS (
  SELECT side, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts
), features AS (
  SELECT side, id, unnest(w) AS f FROM split
  UNION ALL SELECT side, id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split
), names AS (
  SELECT f, hex(encode(f)) AS h FROM (SELECT DISTINCT f FROM features)
), hashed AS (
  SELECT f, xor(list_reduce(list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1:2 * i + 2])::BIGINT),
    lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8), 4294967295::BIGINT), 4294967295::BIGINT) % 10000 AS bucket
  FROM names, crc_table
), counted AS (
  SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 't') AS t FROM features JOIN hashed USING (f) GROUP BY bucket
), gained AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counted) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counted) + 10000)::DOUBLE)))::BIGINT AS gain FROM counted
), weighed AS (
  SELECT id, count(*) AS n, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight
  FROM features JOIN hashed USING (f) JOIN gained USING (bucket) WHERE side = 'd' GROUP BY id
), scores AS (
  SELECT id AS doc_id, len(w) AS n_words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || left(sha256('7:' || id), 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM split LEFT JOIN weighed USING (id) WHERE side = 'd'
), ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scores WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 25 * n // 100 THEN r END AS rank FROM scores LEFT JOIN ranked USING (doc_id)
"""
