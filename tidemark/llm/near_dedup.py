"""Operator 9: near duplicates by SetSketch.

Method: a document is the set of its word shingles. Its sketch has M registers; register i is the smallest of exponential hash
values over the set, on a scale of powers of BASE, truncated to 16 bits. Sketches of parts merge by the larger register, and
equal registers are about as likely as the sets are similar. BANDS groups of ROWS registers are bucket keys. The similarity of
a candidate pair is estimated from its registers by maximum likelihood together with the two set sizes, and again from BINS
registers of one byte that share the hash space out among them, which for sets of some hundred shingles is close to exact.
Pairs that cannot reach the threshold are dropped at five standard errors, and the others are confirmed on the full sets of
words.

How groups stay small: copies with one set of shingles are one class from the start. In a bucket every class meets the
smallest and the largest id only; what that links is one component. Only classes of one bucket that are still in different
components are compared further. That is done on their sketches, in blocks of BLOCK classes inside a task and once for each
pair (in the first band that it shares), and only pairs that may reach the threshold leave the task. No bucket and no number
of partners is capped.

Chance of a lost link: a pair at similarity 0.8 misses all 40 bands of 5 with probability 1e-7, and is estimated lower than
the slack of five standard errors allows with 3e-7.

Defined results: null and empty texts have no shingles and are alone; a text with fewer words than a shingle is one shingle;
words are as in the contract ([^\\x20\\x09-\\x0D]+, A-Z lower-cased); rows with one id are one document, whose set is that of the
text with the smallest hash, and get the same component, each with the size of its own set; a null id is linked with nothing,
has a null component and is kept; an empty table gives an empty one. Ids are integers; no column but the results comes back.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, sized, slices, staged, table, unstaged
from tidemark.llm.components import components

BANDS, ROWS = 40, 5
M = BANDS * ROWS
#: One-byte registers that share the hash space out; 0 is an empty one.
BINS = 512
#: SetSketch scale: base, rate of the exponential values, and the largest register.
BASE, RATE, TOP = 1.001, 20.0, 65535
#: Standard errors under the threshold from which an estimate is taken as too low.
SLACK = 5
#: Classes of a block in the comparison of an open bucket.
BLOCK = 512

MULTIPLIERS = np.random.default_rng(20).integers(0, 2**63, M, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str | None) -> list[bytes]:
    """Bytes split and lower-cased: exactly the six white-space characters and A-Z."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_set(text: str | None, size: int) -> set:
    w = words(text)
    if len(w) < size:
        return {tuple(w)} if w else set()
    return set(zip(*[w[k:] for k in range(size)], strict=False))


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """Distinct 64-bit hashes of the shingles, ascending."""
    w = words(text)
    if not w:
        return np.zeros(0, np.uint64)
    h = np.array(list(map(xxhash.xxh3_64_intdigest, w)), np.uint64)
    size = min(size, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = (out ^ h[k : k + n]) * MIX
        out ^= out >> np.uint64(29)
    return np.unique(out * MIX)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes."""
    least = np.full(M, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(hashes), 1024):
        np.minimum(least, np.multiply.outer(MULTIPLIERS, hashes[lo : lo + 1024]).min(axis=1), out=least)
    value = -np.log1p(-(least.astype(np.float64) + 0.5) / 2.0**64) / RATE
    return np.clip(np.floor(1 - np.log(value) / math.log(BASE)), 0, TOP).astype("<u2")


def shared_out(hashes: np.ndarray) -> bytes:
    """For each of BINS equal parts of the hash space eight bits of the smallest hash in it, not 0; 0 where there is none."""
    h = np.sort(hashes * MIX)
    place = (h >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.diff(place, prepend=-1))
    out = np.zeros(BINS, np.uint8)
    out[place[first]] = 1 + (h[first] >> np.uint64(8)) % np.uint64(255)
    return out.tobytes()


def near_enough(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the shared-out registers of pairs allow the threshold. The error is that of drawing, without putting back, as
    many shingles as there are filled registers from a union of the size that the threshold implies."""
    filled = np.maximum(((a > 0) | (b > 0)).sum(axis=1), 1)
    share = ((a == b) & (a > 0)).sum(axis=1) / filled
    union = (n_a + n_b) / (1 + threshold)
    error = np.sqrt(threshold * (1 - threshold) / filled * np.clip(1 - filled / union, 0.1, 1))
    return share >= threshold - SLACK * error - 2 / filled


def estimates(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of sketches, given the set sizes, on a grid of 1/200."""
    up, down = (a > b).sum(axis=1), (a < b).sum(axis=1)
    u = n_a / (n_a + n_b)
    v = 1 - u
    j = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)[:, None]

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    more, less = p(u[:, None] - v[:, None] * j), p(v[:, None] - u[:, None] * j)
    same = np.maximum(1 - more - less, 1e-12)
    fit = up[:, None] * np.log(np.maximum(more, 1e-12)) + down[:, None] * np.log(np.maximum(less, 1e-12)) + (a.shape[1] - up - down)[:, None] * np.log(same)
    return j[np.arange(len(j)), fit.argmax(axis=1)]


def sketches(df: DataFrame, size: int) -> DataFrame:
    """id, tag, n (set size), s1, s2 (digest of the set), regs and bins; from id, text and tag."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, 1):
                n, digests, regs, bins = [], [], [], []
                for text in part.column(1).to_pylist():
                    h = shingle_hashes(text, size)
                    n.append(len(h))
                    digests.append(xxhash.xxh3_128_digest(h.tobytes()))
                    regs.append(registers(h).tobytes() if len(h) else None)
                    bins.append(shared_out(h) if len(h) else None)
                d = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(d[:, 0]), pa.array(d[:, 1]), pa.array(regs, pa.binary()), pa.array(bins, pa.binary())], names=["id", "tag", "n", "s1", "s2", "regs", "bins"])
        give_back()

    return df.select("id", "text", "tag").mapInArrow(run, "id long, tag long, n long, s1 long, s2 long, regs binary, bins binary")


def members_of(pairs: DataFrame) -> DataFrame:
    """The ids of pairs, each once."""
    return staged(pairs.select(F.col("a").alias("id")).distinct().unionByName(pairs.select(F.col("b").alias("id")).distinct()).distinct(), "pair-ids")


def likely(pairs: DataFrame, sketch: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose sketches allow the threshold."""
    ids = sized(members_of(pairs))
    own = sketch.join(ids, "id", "left_semi").select("id", "n", "regs", "bins")
    both = pairs.join(own.toDF("a", "n_a", "r_a", "s_a"), "a").filter("n_a > 0").join(own.toDF("b", "n_b", "r_b", "s_b"), "b")
    both = both.filter(F.least("n_a", "n_b") >= F.lit(threshold - 1e-9) * F.greatest("n_a", "n_b"))
    slack = SLACK * math.sqrt(threshold * (1 - threshold) / M)

    def run(batches):
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                x, y = (np.frombuffer(b"".join(part.column(k).to_pylist()), "<u2").reshape(-1, M) for k in (3, 5))
                p, q = (np.frombuffer(b"".join(part.column(k).to_pylist()), np.uint8).reshape(-1, BINS) for k in (6, 7))
                n, m = (part.column(k).to_numpy().astype(float) for k in (2, 4))
                keep = pa.array(np.flatnonzero(near_enough(p, q, n, m, threshold) & (estimates(x, y, n, m) >= threshold - slack)))
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)], names=["a", "b"])
        give_back()

    return both.select("a", "b", "n_a", "r_a", "n_b", "r_b", "s_a", "s_b").mapInArrow(run, "a long, b long")


def confirmed(pairs: DataFrame, docs: DataFrame, size: int, threshold: float) -> DataFrame:
    """Pairs whose full sets reach the threshold."""
    ids = sized(members_of(pairs))
    texts = docs.join(ids, "id", "left_semi").select("id", "text")
    both = pairs.join(texts.toDF("b", "t_b"), "b").join(texts.toDF("a", "t_a"), "a").select("a", "b", "t_a", "t_b")
    percent = round(100 * threshold)

    def run(batches):
        seen: dict[int, set] = {}

        def of(i: int, text: str) -> set:
            if i not in seen:
                if len(seen) >= 64:
                    seen.clear()
                seen[i] = shingle_set(text, size)
            return seen[i]

        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                keep = []
                for k, (i, j, x, y) in enumerate(zip(*[part.column(c).to_pylist() for c in range(4)], strict=True)):
                    x, y = of(i, x), of(j, y)
                    both = len(x & y)
                    if 100 * both >= percent * (len(x) + len(y) - both):
                        keep.append(k)
                keep = pa.array(keep, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(keep), part.column(1).take(keep)], names=["a", "b"])
        give_back()

    return both.mapInArrow(run, "a long, b long")


def band_rows(reps: DataFrame) -> DataFrame:
    """key, band, id for every band of every sketch."""
    width = 2 * ROWS
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(F.xxhash64(F.substr(F.col("regs"), i * width + 1, F.lit(width)), i).alias("key"), i.alias("band")))
    return reps.select("id", F.explode(keys).alias("k")).select("k.key", "k.band", "id")


def ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter(F.col("a") < F.col("b")).distinct()


def near_groups(df: DataFrame, size: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For every row of df: id_col, n_shingles, component_id (smallest id reachable over links), kept (it is that id)."""
    if df.schema[id_col].dataType.typeName() not in ("byte", "short", "integer", "long"):
        return by_numbers(df, size, threshold, id_col, text_col)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("tag"))
    docs = rows.filter(F.col("id").isNotNull() & F.col("text").isNotNull())
    sketch = staged(sketches(rows, size), "sketches")
    own = sketch.filter("id is not null")
    again = staged(own.groupBy("id").agg(F.count("*").alias("c"), F.min("tag").alias("first")).filter("c > 1").select("id", "first"), "repeated-ids")
    if again.limit(1).count():  # one text for each id, here and where links are confirmed
        own = staged(one_of_id(own, again), "one-of-id")
        docs = one_of_id(docs, again)
    full = own.filter("n > 0")

    # classes of equal sets
    classes = staged(full.groupBy("s1", "s2").agg(F.min("id").alias("rep"), F.max("id").alias("last")).filter("rep < last").drop("last"), "classes")
    copies = staged(full.select("id", "s1", "s2").join(sized(classes), ["s1", "s2"]).filter("id > rep").select("id", "rep").distinct(), "copies")
    reps = full.join(sized(copies.select("id")), "id", "left_anti")

    # classes that share a bucket
    bands = band_rows(reps)
    shared = bands.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    shared = staged(shared, "buckets")
    members = staged(bands.join(sized(shared), "key"), "members")
    pivots = members.select("id", "lo", "hi").distinct()
    pivots = pivots.select(F.col("id").alias("b"), F.col("lo").alias("a")).unionByName(pivots.select(F.col("id").alias("b"), F.col("hi").alias("a")))
    tested = staged(ordered(pivots), "pairs")
    links = staged(confirmed(staged(likely(tested, own, threshold), "likely"), docs, size, threshold), "links")

    label = components(links) if links.limit(1).count() else links.select(F.col("a").alias("id"), F.col("a").alias("c"))
    in_bucket = members.select("key", "band", "id").join(sized(label), "id", "left").withColumn("c", F.coalesce("c", "id"))
    still = in_bucket.groupBy("key").agg(F.min("c").alias("x"), F.max("c").alias("y"), F.count("*").alias("size")).filter("x < y").select("key", "size")
    still = staged(in_bucket.join(sized(staged(still, "open-buckets")), "key"), "open-members")
    if still.limit(1).count():
        pairs = staged(crossed(still, reps, threshold).join(tested, ["a", "b"], "left_anti"), "pairs")
        links = links.unionByName(staged(confirmed(pairs, docs, size, threshold), "links"))
        label = components(links) if links.limit(1).count() else label
    unstaged(shared, members, tested, still)

    mapped = sketch.select("id", "n").join(sized(copies), "id", "left").withColumn("top", F.coalesce("rep", "id"))
    out = mapped.join(sized(label.select(F.col("id").alias("top"), "c")), "top", "left")
    found = F.coalesce("c", "top")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), found.alias("component_id"), (F.col("id").isNull() | (found == F.col("id"))).alias("kept"))


def by_numbers(df: DataFrame, size: int, threshold: float, id_col: str, text_col: str) -> DataFrame:
    """near_groups of ids that are no whole numbers: each gets a number in their order, under which the work is done."""
    rows = df.select(F.col(f"`{id_col}`").alias("name"), F.col(f"`{text_col}`").alias("text"))
    names = rows.select("name").filter("name is not null").distinct()
    numbers = staged(names.repartitionByRange("name").sortWithinPartitions("name").select("name", F.monotonically_increasing_id().alias("id")), "numbers")
    groups = near_groups(rows.join(sized(numbers), "name", "left").select("id", "text"), size, threshold, "id")
    out = groups.join(sized(numbers), "id", "left").withColumnRenamed("name", "own")
    tops = numbers.select(F.col("id").alias("component_id"), F.col("name").alias("top"))
    out = out.join(sized(tops), "component_id", "left")
    return out.select(F.col("own").alias(id_col), "n_shingles", F.col("top").alias("component_id"), "kept")


def one_of_id(rows: DataFrame, again: DataFrame) -> DataFrame:
    """Of rows with an id of again only one with its first tag; the others are as they were."""
    met = rows.join(sized(again), "id", "left")
    one = met.filter("tag = first").dropDuplicates(["id"])
    return met.filter("first is null").unionByName(one).drop("first")


def crossed(still: DataFrame, reps: DataFrame, threshold: float) -> DataFrame:
    """Likely pairs of one open bucket in different components; still: key, band, id, c, size.

    A bucket is dealt into blocks by id, and each pair of blocks is a group of at most about two blocks of rows.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    other = F.explode(F.sequence(F.lit(0), blocks - 1))
    dealt = still.select("key", "band", "id", "c", mine.alias("mine"), other.alias("other"))
    dealt = dealt.select("key", "band", "id", "c", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine")
    rows = dealt.join(reps.select("id", "n", "regs", "bins"), "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    slack = SLACK * math.sqrt(threshold * (1 - threshold) / M)

    def pairs(g: dict) -> tuple[list, list]:
        regs = np.frombuffer(b"".join(g["regs"]), "<u2").reshape(-1, M)
        bins = np.frombuffer(b"".join(g["bins"]), np.uint8).reshape(-1, BINS)
        ids, c, n, mine = (np.array(g[k]) for k in ("id", "c", "n", "mine"))
        band, out_a, out_b = g["band"][0], [], []
        two = g["i"][0] != g["j"][0]
        for k in range(len(ids)):
            # partners: the other block, or the later rows of the only one
            if two and mine[k] != g["i"][0]:
                continue
            to = np.flatnonzero(mine == g["j"][0]) if two else np.arange(k + 1, len(ids))
            to = to[(c[to] != c[k]) & (np.minimum(n[to], n[k]) >= (threshold - 1e-9) * np.maximum(n[to], n[k]))]
            if not len(to):
                continue
            size = np.full(len(to), float(n[k]))
            close = near_enough(bins[to], np.broadcast_to(bins[k], (len(to), BINS)), n[to].astype(float), size, threshold)
            to, size = to[close], size[close]
            first = (regs[to] == regs[k]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            to, size = to[first == band], size[first == band]
            if len(to):
                fit = estimates(np.broadcast_to(regs[k], (len(to), M)), regs[to], size, n[to].astype(float))
                to = to[fit >= threshold - slack]
                out_a += np.minimum(ids[to], ids[k]).tolist()
                out_b += np.maximum(ids[to], ids[k]).tolist()
        return out_a, out_b

    def run(batches):
        names = ["key", "i", "j", "band", "id", "c", "mine", "n", "regs", "bins"]
        group: dict = {}
        for batch in batches:
            part = {k: batch.column(i).to_pylist() for i, k in enumerate(names)}
            mark = list(zip(part["key"], part["i"], part["j"], strict=True))
            cuts = [0, *[k for k in range(1, len(mark)) if mark[k] != mark[k - 1]], len(mark)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if group and (group["key"][0], group["i"][0], group["j"][0]) != mark[lo]:
                    a, b = pairs(group)
                    group = {}
                    if a:
                        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
                for k in names:
                    group.setdefault(k, []).extend(part[k][lo:hi])
        if group:
            a, b = pairs(group)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        give_back()

    return rows.select("key", "i", "j", "band", "id", "c", "mine", "n", "regs", "bins").mapInArrow(run, "a long, b long").distinct()


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles have a Jaccard similarity of at least 0.8."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_groups(docs, size=4, threshold=0.8)


OP9_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i : i + 3], ' '))) AS s FROM w WHERE len(w) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), i AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), r AS (
  SELECT doc_id AS id, doc_id AS c FROM w UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.id WHERE r.c < l.b
), m AS (
  SELECT id, min(c) AS component_id FROM r GROUP BY id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM w LEFT JOIN n USING (doc_id) JOIN m ON m.id = doc_id
"""
