"""Operator 3: byte strings of a given length that repeat anywhere in the corpus.

Method: anchor and fingerprint matching, in place of prefix doubling over every byte, which at lengths 1, 2, 4 ... would move each
position about eight times; here only content decides which positions are looked at first. Of the starts of ANCHOR-byte strings inside any LENGTH-byte
string that with the smallest hash is its anchor, so equal strings have equal anchors at equal places, and about one position
in 70 is one. Strings with one anchor form a run. The rounds, each of which drops what has become unique:
1. ranks of the anchors (ANCHOR bytes); runs equal as a whole are settled by their hash, so long copies are never expanded.
2. runs that differ around a shared anchor are cut into STEPS parts by the place of the anchor: ranks of the longer stretches
   that the strings of a part have in common; parts equal as a whole are settled as runs were.
3. what is left, string by string: the pair of the ranks of its first half and of the half at the offset LENGTH / 2. That is
   the threshold, so the doubling ends.
Ranks are names, not order numbers: equal strings have equal names, and counting needs no more. A verdict rests on 128 bits;
where a collision only leaves more to do, names have 64.

Plan: one scan gives the runs; they are written once, counted by partial aggregates (a passage in a third of all documents is a
row per task), and met with the repeated names in joins that Spark can split at hot keys. Those tables grow with the corpus, so
these joins are shuffled at every size. Texts are met by id: broadcast of the other side up to a counted size, else a shuffle.

Defined results: a null text is an empty one; texts under LENGTH bytes lose nothing; rows with one id (or none) are told apart
by their text, and equal rows are copies of each other like any others; very long texts are worked on in pieces; an empty table
gives an empty one; only the id and the results come back, so that other columns can't clash.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tidemark.llm.common import give_back, sized, slices, staged, table, unstaged

LENGTH = 200
#: Bytes of an anchor, and parts of a run in the second round.
ANCHOR, STEPS = 60, 8

MASK = (1 << 64) - 1
FACTOR = 0xD6E8FEB86659FD93
INVERSE = pow(FACTOR, -1, 1 << 64)
BYTES = np.random.default_rng(3).integers(0, 2**64, (2, 256), dtype=np.uint64)
#: Bytes whose hashes are made at once: bounds memory for very long texts.
PIECE = 1 << 20


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    up[1:], down[1:] = FACTOR, INVERSE
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def rolling(data: np.ndarray, width: int, salt: int) -> np.ndarray:
    """64-bit hash of every substring of that width: a polynomial over random byte values, divided by its place."""
    up, down = powers(PIECE + 4 * LENGTH)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(BYTES[salt][data] * up[: len(data)], out=sums[1:])
    return mixed((sums[width:] - sums[: len(sums) - width]) * down[: len(data) - width + 1])


def pieces(n: int, length: int):
    """(first, last) byte ranges that overlap by length - 1, so that every string lies in one."""
    at = 0
    while at == 0 or at + length <= n:
        yield at, min(n, at + PIECE)
        at += PIECE - length + 1


def minima(h: np.ndarray, window: int) -> np.ndarray:
    """Leftmost place of the smallest of every window of h, by van Herk's two passes over blocks."""
    n = len(h) - window + 1
    pad = -len(h) % window
    full = np.concatenate([h, np.full(pad, MASK, np.uint64)]).reshape(-1, window)
    place = np.arange(full.size, dtype=np.int64).reshape(full.shape)
    left = np.minimum.accumulate(full, axis=1)
    new = np.ones(full.shape, bool)
    new[:, 1:] = full[:, 1:] < left[:, :-1]
    left_at = np.maximum.accumulate(np.where(new, place, -1), axis=1)
    back = full[:, ::-1]
    right = np.minimum.accumulate(back, axis=1)
    new = np.ones(full.shape, bool)
    new[:, 1:] = back[:, 1:] <= right[:, :-1]
    right_at = np.minimum.accumulate(np.where(new, place[:, ::-1], full.size), axis=1)[:, ::-1]
    right = right[:, ::-1]
    a, b = right.ravel()[:n], left.ravel()[window - 1 : window - 1 + n]
    return np.where(a <= b, right_at.ravel()[:n], left_at.ravel()[window - 1 : window - 1 + n])


def runs(data: bytes, length: int) -> tuple[np.ndarray, ...]:
    """Runs of starts of length-byte strings with one anchor: first start, number of starts,
    name of the anchor, hash of the run's bytes, place of the anchor after the first start."""
    short = min(ANCHOR, length)
    window = length - short + 1
    out = []
    raw = np.frombuffer(data, np.uint8)
    for lo, hi in pieces(len(data), length):
        part = raw[lo:hi]
        if len(part) < length:
            continue
        h = rolling(part, short, 0)
        at = minima(h, window)
        cut = np.flatnonzero(np.diff(at)) + 1
        first = np.concatenate([[0], cut])
        count = np.diff(np.concatenate([first, [len(at)]]))
        out.append((first + lo, count, h[at[first]], at[first] - first))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    first, count, name, off = (np.concatenate([o[k] for o in out]) for k in range(4))
    digest = np.array([xxhash.xxh3_64_intdigest(data[f : f + c + length - 1]) for f, c in zip(first.tolist(), count.tolist(), strict=True)], np.uint64)
    return first, count, name.astype(np.int64), digest.astype(np.int64), off


def run_rows(docs: DataFrame, length: int) -> DataFrame:
    """name, digest, id, tag, at, n, off for every run; docs: id, text, tag (hash of the text)."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 64):
                owner, columns = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    got = runs(data, length)
                    columns.append(got)
                    owner.append(np.full(len(got[0]), k, np.int64))
                first, count, name, digest, off = (np.concatenate([c[k] for c in columns]) for k in range(5))
                owner = pa.array(np.concatenate(owner))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(name), pa.array(digest), part.column(0).take(owner), part.column(2).take(owner), pa.array(first.astype(np.int32)), pa.array(count.astype(np.int32)), pa.array(off.astype(np.int32))],
                    names=["name", "digest", "id", "tag", "at", "n", "off"],
                )
        give_back()

    return docs.mapInArrow(run, f"name long, digest long, id {docs.schema['id'].dataType.simpleString()}, tag long, at int, n int, off int")


def looked_into(docs: DataFrame, spans: DataFrame, func, added: str) -> DataFrame:
    """Rows that func makes of the bytes of a document and each of its spans; spans: id, tag, at, n, off, single.

    func(bytes, span) returns a dict of equally long arrays, named and typed by the DDL string added; id, tag and single go
    along. A span travels as one number: 30 bits of place, 16 of length, 16 of offset, 1 of single. Rows with one id and text have
    the same spans, so a set of them is no larger for a row that is repeated.
    """
    packed = F.shiftleft(F.shiftleft(F.shiftleft(F.col("at").cast("long"), 16) + F.col("n"), 16) + F.col("off"), 1) + F.col("single").cast("long")
    own = spans.groupBy("id", "tag").agg(F.collect_set(packed).alias("spans"))
    own = sized(staged(own.select(F.col("id").alias("own"), F.col("tag").alias("own_tag"), "spans"), "spans"), weight=F.size("spans"))
    work = docs.join(own, F.col("id").eqNullSafe(F.col("own")) & (F.col("tag") == F.col("own_tag"))).select("id", "text", "tag", "spans")
    new = to_arrow_schema(StructType.fromDDL(added))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1, 32):
                made, owner, single = [], [], []
                for k, (text, own) in enumerate(zip(*[part.column(c).to_pylist() for c in (1, 3)], strict=True)):
                    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
                    for x in own:
                        made.append(func(data, {"at": x >> 33, "n": x >> 17 & 0xFFFF, "off": x >> 1 & 0xFFFF}))
                        m = len(made[-1]["at"])
                        owner.append(np.full(m, k))
                        single.append(np.full(m, bool(x & 1)))
                if made:
                    columns = [pa.array(np.concatenate([x[f.name] for x in made]).astype(f.type.to_pandas_dtype())) for f in new]
                    owner = pa.array(np.concatenate(owner))
                    yield pa.RecordBatch.from_arrays([part.column(0).take(owner), part.column(2).take(owner), pa.array(np.concatenate(single)), *columns], names=["id", "tag", "single", *new.names])
        give_back()

    return work.mapInArrow(run, f"id {docs.schema['id'].dataType.simpleString()}, tag long, single boolean, {added}")


def stretches(length: int):
    """Second round: a run is cut where the anchor's place in its strings passes a step, and each part is named by the
    bytes that any strings of that step share; digest is that of all its bytes."""
    short = min(ANCHOR, length)
    width = -(-(length - short + 1) // STEPS)

    def func(data: np.ndarray, s: dict) -> dict:
        anchor = s["at"] + s["off"]
        out = {"name": [], "digest": [], "at": [], "n": []}
        for q in range(STEPS):
            lo = max(s["at"], anchor - width * (q + 1) + 1)
            hi = min(s["at"] + s["n"] - 1, anchor - width * q)
            if lo > hi:
                continue
            shared = data[anchor - width * q : anchor - width * (q + 1) + 1 + length].tobytes()
            out["name"].append((xxhash.xxh3_64_intdigest(shared, seed=q) ^ 2**63) - 2**63)
            out["digest"].append((xxhash.xxh3_64_intdigest(data[lo : hi + length].tobytes()) ^ 2**63) - 2**63)
            out["at"].append(lo)
            out["n"].append(hi - lo + 1)
        return {k: np.array(v, np.int64) for k, v in out.items()}

    return func


def pairs_of_ranks(length: int):
    """Third round: for each string the names of its halves, both under two hashes, as two 64-bit numbers."""
    half, rest = length // 2, length - length // 2

    def func(data: np.ndarray, s: dict) -> dict:
        bit, n = data[s["at"] : s["at"] + s["n"] + length - 1], s["n"]
        a, b = (rolling(bit, rest, salt) for salt in (0, 1))
        return {"p1": mixed(a[:n] * np.uint64(FACTOR) + a[half : half + n]).view(np.int64), "p2": mixed(b[:n] * np.uint64(FACTOR) + b[half : half + n]).view(np.int64), "at": np.arange(s["at"], s["at"] + n)}

    return func


PLACE = ["id", "tag", "at", "n"]


def settled(rows: DataFrame, what: str) -> tuple[DataFrame, DataFrame]:
    """One round. rows: name, digest, id, tag, at, n, off, single (found nowhere else so far).

    Returns the places whose digest repeats, and, of names that go with several digests, one place of each digest for the next
    round: all those that are still single and what they may be equal to.
    """
    names = rows.groupBy("name").agg(F.count("*").alias("c"), F.min("digest").alias("lo"), F.max("digest").alias("hi"), F.max("single").alias("any")).filter("c > 1 and any")
    names = staged(names.select("name", (F.col("lo") == F.col("hi")).alias("same")), f"{what}-names")
    met = staged(rows.join(names, "name"), f"{what}-met")
    differ = met.filter("not same")
    ways = staged(differ.groupBy("name", "digest").agg(F.count("*").alias("copies"), F.min(F.xxhash64("id", "tag", "at")).alias("pick")), f"{what}-ways")
    mixed_rows = staged(differ.join(ways, ["name", "digest"]).select(*PLACE, "off", "copies", "single", (F.xxhash64("id", "tag", "at") == F.col("pick")).alias("picked")), f"{what}-mixed")
    unstaged(names, ways)
    hits = met.filter("same").select(*PLACE).unionByName(mixed_rows.filter("copies > 1").select(*PLACE))
    left = mixed_rows.filter("picked").select(*PLACE, "off", (F.col("single") & (F.col("copies") == 1)).alias("single"))
    return hits, left


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """id, tag, at, n: strings of that length that start at at ... at + n - 1 start elsewhere too. docs: id, text, tag."""
    found = staged(run_rows(docs, length), "runs")
    whole, work = settled(found.withColumn("single", F.lit(True)), "run")
    unstaged(found)
    parts = staged(looked_into(docs, work, stretches(length), "name long, digest long, at int, n int"), "parts")
    partly, left = settled(parts.withColumn("off", F.lit(0)), "part")
    unstaged(parts)
    strings = looked_into(docs, left, pairs_of_ranks(length), "p1 long, p2 long, at int")
    twice = staged(strings.groupBy("p1", "p2").agg(F.count("*").alias("c"), F.max("single").alias("any")).filter("c > 1 and any").select("p1", "p2"), "pairs")
    hits = strings.filter("single").join(twice, ["p1", "p2"]).select("id", "tag", "at", F.lit(1).alias("n"))
    return whole.unionByName(partly).unionByName(hits)


def covered(spans: DataFrame, length: int) -> DataFrame:
    """id, tag, cut: sorted disjoint byte ranges (start, end) that the strings cover; touching ones are one."""
    own = spans.groupBy("id", "tag").agg(F.collect_set(F.struct("at", "n")).alias("s"))

    def run(batches):
        for batch in batches:
            out = []
            for own in batch.column(2).to_pylist():
                merged: list[dict] = []
                for at, n in sorted((s["at"], s["n"]) for s in own):
                    end = at + n - 1 + length
                    if merged and at <= merged[-1]["end"]:
                        merged[-1]["end"] = max(merged[-1]["end"], end)
                    else:
                        merged.append({"start": at, "end": end})
                out.append(merged)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))], names=["id", "tag", "cut"])

    kind = spans.schema["id"].dataType.simpleString()
    merged = own.select("id", "tag", "s").mapInArrow(run, f"id {kind}, tag long, cut array<struct<start: int, end: int>>")
    return staged(merged, "cuts")


def repeats_removed(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col, n_bytes, n_removed, spans (byte ranges removed) and kept (the remaining bytes) for every row of df; no other column."""
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    docs = docs.withColumn("tag", F.xxhash64("text"))
    cuts = covered(repeated_spans(docs, length), length).select(F.col("id").alias("own"), F.col("tag").alias("own_tag"), "cut")
    both = docs.join(sized(cuts, weight=F.size("cut")), F.col("id").eqNullSafe(F.col("own")) & (F.col("tag") == F.col("own_tag")), "left").select("id", "text", "cut")
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                sizes, kept, spans = [], [], []
                for text, cut in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                    data = (text or "").encode("utf-8", "surrogatepass")
                    last, rest = 0, []
                    for c in cut or ():
                        rest.append(data[last : c["start"]])
                        last = c["end"]
                    kept.append(b"".join([*rest, data[last:]]))
                    sizes.append(len(data))
                    spans.append(cut or [])
                gone = [a - len(b) for a, b in zip(sizes, kept, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())], names=[id_col, "n_bytes", "n_removed", "spans", "kept"])
        give_back()

    return both.mapInArrow(run, f"`{id_col}` {docs.schema['id'].dataType.simpleString()}, n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary")


def op3_repeat_dedup(spark, sf_dir: str) -> DataFrame:
    """Every byte that lies in a 200-byte string found elsewhere is removed."""
    out = repeats_removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP3_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), b AS (  -- pieces of 1000 starts, so that cutting strings out of long texts stays cheap
  SELECT r, base, substr(h, 2 * base + 1, 2 * 1199) AS h FROM (SELECT r, unnest(range(0, length(h) // 2, 1000)) AS base, h FROM d)
), s AS (
  SELECT r, base + o AS p, substr(h, 2 * o + 1, 2) AS byte, CASE WHEN 2 * o + 400 <= length(h) THEN hash(substr(h, 2 * o + 1, 400)) END AS k
  FROM (SELECT r, base, h, unnest(range(0, least(1000, length(h) // 2))) AS o FROM b)
), n AS (
  SELECT k FROM s WHERE k IS NOT NULL GROUP BY k HAVING count(*) > 1
), c AS (
  SELECT r, p, byte, CAST(coalesce(p - max(CASE WHEN n.k IS NOT NULL THEN p END) OVER (PARTITION BY r ORDER BY p) < 200, false) AS INTEGER) AS gone FROM s LEFT JOIN n USING (k)
), g AS (
  SELECT r, p, byte, gone, gone = 1 AND lag(gone, 1, 0) OVER (PARTITION BY r ORDER BY p) = 0 AS opens FROM c
), m AS (
  SELECT r, sum(gone) AS n_removed, count(*) FILTER (opens) AS n_spans, string_agg(byte, '' ORDER BY p) FILTER (gone = 0) AS kept FROM g GROUP BY r
)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM d LEFT JOIN m USING (r)
"""
