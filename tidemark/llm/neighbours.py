"""Operator 13: the nearest vectors by Euclidean distance.

Method: multiprobe p-stable hashing. A table cuts random projections of the vectors into cells of one width; a bucket is one
cell of each projection. A query visits its own bucket and perturbed ones in the order of their estimated success (the sum of
squared distances to the cells' borders), in each of several tables, and what the tables give is merged and ranked by the
exact distance in double precision, summed component by component.

The width of cells follows the measured distance of the tenth neighbour. Numbers of tables, projections and probes are those of
least estimated cost whose recall reaches 0.97 on SAMPLE_QUERIES queries (the smallest hashes) that were first compared with
all vectors. That fit is the only sample: every vector is indexed and every query answered.

Plan: copies of one vector are one class with its eleven smallest ids (more can't be among the ten nearest), so a hot vector is
one row, for queries as well. Vectors are hashed in tasks, twice: to count buckets and to ship them, once for each table, to
the tasks where the probes meet them. A bucket with many vectors or probes is cut into a grid of chunks, so that a task never
holds more than a chunk. Inside a chunk distances are computed in blocks and only the eleven nearest of each probe leave it.
Queries that found less than they should (outliers) are compared with all vectors, in blocks of SCAN_QUERIES.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part, nor do rows without an
id; vectors of different lengths are not compared; rows with the query's id are its own; repeated rows count once; of several
vectors of one query id the smallest is the query; distances beyond the range of doubles are infinite, ties to the smaller id;
an empty table gives an empty one. Other columns are not looked at.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import give_back, sized, staged, table, unstaged

K = 10
RECALL = 0.97
SAMPLE_QUERIES, SAMPLE_ROWS, MOST_PROBES, REACH = 32, 512, 256, 3
TABLES = (2, 4, 8)
CHUNK_ROWS, CHUNK_PROBES, SCAN_QUERIES, BLOCK_CELLS = 4_096, 16_384, 1_000, 1 << 20

#: Microseconds of one distance, of one probe of a bucket and of one vector in one table, as measured; they only steer the choice.
COST_PAIR, COST_PROBE, COST_ROW = 0.1, 20.0, 5.0


def matrix(column: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray]]:
    """Each length of vectors with the places that have it."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    for length in np.unique(size):
        yield int(length), np.flatnonzero(size == length)


class Hashes:
    """Tables of projections, the same in every task: made from a seed, the table and the vectors' length."""

    def __init__(self, tables: int, projections: int, width: float, seed: int = 13):
        self.tables, self.projections, self.width, self.seed = tables, projections, width, seed

    def places(self, t: int, vectors: np.ndarray) -> np.ndarray:
        """Coordinates in cells; the whole part names the cell."""
        rng = np.random.default_rng([self.seed, t, vectors.shape[1]])
        lines, shift = rng.standard_normal((vectors.shape[1], self.projections)), rng.uniform(0, 1, self.projections)
        with np.errstate(all="ignore"):
            return np.clip(np.nan_to_num(vectors @ lines / self.width + shift), -(2.0**50), 2.0**50)

    def names(self, t: int, length: int, cells: np.ndarray) -> np.ndarray:
        """64-bit names of rows of cells; two buckets with one name are only looked at together."""
        x = np.full(len(cells), (t * 1_000_003 + length) * 2 + 1, np.uint64)
        for column in cells.T:
            x = (x ^ column.astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            x ^= x >> np.uint64(29)
        return x.view(np.int64)


def perturbations(place: np.ndarray, n: int) -> list[tuple[int, ...]]:
    """The n most promising offsets of cells around a place, best first; the first is the place's own cell.

    The score of an offset is the sum of squared distances to the borders that it crosses. Offsets are grown from the best by
    moving the last moved projection or a later one to its next best cell, which reaches each once and never lowers a score.
    """
    inside = place - np.floor(place)
    steps = np.arange(-REACH, REACH + 1)
    score = np.where(steps == 0, 0.0, np.where(steps < 0, inside[:, None] - steps - 1, steps - inside[:, None])) ** 2
    order = np.argsort(score, axis=1, kind="stable")
    score, steps = np.take_along_axis(score, order, 1).tolist(), (order - REACH).tolist()
    m, most = len(score), 2 * REACH
    heap, out = [(0.0, 0, (0,) * m)], []
    while heap and len(out) < n:
        total, last, state = heapq.heappop(heap)
        out.append(tuple([steps[i][s] for i, s in enumerate(state)]))
        for i in range(last, m):
            s = state[i]
            if s < most:
                heapq.heappush(heap, (total - score[i][s] + score[i][s + 1], i, (*state[:i], s + 1, *state[i + 1 :])))
    return out


def nearest_pairs(queries: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query's number, place, distance) of the k nearest of each query, ties to the smaller id.

    A matrix product picks those that can be among the k, with room for its rounding; their distances are then computed exactly.
    """
    rows, places, scores = [], [], []
    block = max(1, BLOCK_CELLS // max(1, len(vectors)))
    with np.errstate(all="ignore"):
        norms = (vectors**2).sum(1)
        for at in range(0, len(queries), block):
            q = queries[at : at + block]
            sizes = (q**2).sum(1)[:, None] + norms
            about = sizes - 2 * (q @ vectors.T)
            if not np.isfinite(about).all():
                row, place = np.divmod(np.arange(about.size), len(vectors))
            elif len(vectors) <= k:
                row, place = np.divmod(np.arange(about.size), len(vectors))
            else:
                room = 1e-12 * queries.shape[1] * sizes
                bound = np.partition(about + room, k - 1, axis=1)[:, k - 1 : k]
                row, place = np.nonzero(about - room <= bound)
            distance = np.empty(len(row))
            for i in range(0, len(row), BLOCK_CELLS // 16):
                part = slice(i, i + BLOCK_CELLS // 16)
                total = np.zeros(len(row[part]))
                for a, b in zip(q.T, vectors.T, strict=True):  # component by component: the same sum everywhere
                    total += (a[row[part]] - b[place[part]]) ** 2
                distance[part] = np.sqrt(total)
            order = np.lexsort((ids[place], distance, row))
            row, place, distance = row[order], place[order], distance[order]
            first = np.searchsorted(row, row, "left")
            keep = np.arange(len(row)) - first < k
            rows.append(row[keep] + at)
            places.append(place[keep])
            scores.append(distance[keep])
    return np.concatenate(rows), np.concatenate(places), np.concatenate(scores)


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, h1, h2): rows that take part; h1 and h2 name the vector."""
    vec = F.col(f"`{vec_col}`")
    good = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(vec, lambda x: x != 0)
    rows = df.filter(F.col(f"`{id_col}`").isNotNull() & vec.isNotNull()).filter(good)
    return rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec"), F.xxhash64(vec).alias("h1"), F.xxhash64(F.lit(1), vec).alias("h2"))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(cid, ids, vec): one row per distinct vector, its smallest id and its k + 1 smallest ones. Copies are cut inside map tasks."""
    place = F.row_number().over(Window.partitionBy("h1", "h2").orderBy("id"))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    ids = F.array_sort(F.collect_set("id"))
    return few.groupBy("h1", "h2").agg(F.min("id").alias("cid"), ids.alias("ids"), F.min_by("vec", "place").alias("vec")).select("cid", "ids", "vec")


def scanned(vectors: DataFrame, asked: list[tuple[int, list[float]]], k: int, with_vec: bool = False) -> DataFrame:
    """(query, cid, score[, vec]): the k nearest classes of the queries asked (number, vector) among all, each task giving its own k."""
    numbers = np.array([n for n, _ in asked], np.int64)
    lengths = np.array([len(v) for _, v in asked])
    data = {int(x): np.array([v for _, v in asked if len(v) == x], np.float64) for x in np.unique(lengths)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at in by_length(batch.column(1)):
                if length not in data:
                    continue
                part = batch.take(pa.array(at))
                row, place, score = nearest_pairs(data[length], matrix(part.column(1)), part.column(0).to_numpy(), k)
                out = [pa.array(numbers[lengths == length][row]), part.column(0).take(pa.array(place)), pa.array(score)]
                yield pa.RecordBatch.from_arrays([*out, *([part.column(1).take(pa.array(place))] if with_vec else [])], names=["query", "cid", "score", "vec"][: 4 if with_vec else 3])
        give_back()

    kind = vectors.schema["vec"].dataType.simpleString()
    found = vectors.select("cid", "vec").mapInArrow(run, "query long, cid long, score double" + f", vec {kind}" * with_vec)
    return found.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "cid"))).filter(F.col("place") <= k).drop("place")


def chosen(vectors: DataFrame, queries: DataFrame, n: int, k: int) -> tuple[Hashes, int, dict]:
    """Hashes and number of probes of least estimated cost among those that reach RECALL on the sample, and what was measured."""
    asked = [(i, list(r.vec)) for i, r in enumerate(queries.orderBy(F.xxhash64("qid"), "qid").limit(SAMPLE_QUERIES).select("vec").collect())]
    near = [r for r in scanned(vectors, asked, k + 1, with_vec=True).collect() if r.score > 0]
    some = [list(r.vec) for r in vectors.orderBy(F.xxhash64("cid"), "cid").limit(SAMPLE_ROWS).select("vec").collect()]
    far = sorted(max([r.score for r in near if r.query == i], default=0.0) for i, _ in asked)
    width = next((x for x in [far[len(far) // 2] if far else 0.0, max(far, default=0.0)] if 0 < x < math.inf), 1.0)
    each = COST_ROW * n / max(1, queries.count())  # of hashing all vectors into a table, for each query
    best = None
    for factor in (1.0, 2.0):
        for projections in range(1, 13):
            if projections > 1 and (6 / factor) ** projections > 4 * n:
                break
            reached = False
            for tables, hit, seen in ranks(Hashes(max(TABLES), projections, factor * width), asked, [(r.query, list(r.vec)) for r in near], some):
                if tables not in TABLES:
                    continue
                for probes in [2**i for i in range(MOST_PROBES.bit_length())]:
                    recall = float((hit < probes).mean()) if len(hit) else 1.0
                    if recall >= RECALL:
                        share = float((seen < probes).mean()) if seen.size else 1.0
                        cost = tables * (probes * COST_PROBE + each) + share * n * COST_PAIR
                        if best is None or cost < best[0]:
                            best = (cost, Hashes(tables, projections, factor * width), probes, {"recall": recall, "share": share})
                        reached = True
                        break
            if not reached:  # more projections lose more neighbours
                break
    if best is None:  # not even one projection: neighbours lie at very different distances; wide cells hold nearly all
        return Hashes(2, 1, 16 * width), MOST_PROBES, {}
    return best[1], best[2], best[3]


def ranks(hashes: Hashes, asked, near, some) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """After each table: at which probe, in the best table so far, each true neighbour is met, and each sampled row by each query."""
    none = MOST_PROBES + 1
    hit, seen = np.full(len(near), none), np.full((len(asked), len(some)), none)
    by = {x: np.array([i for i, v in enumerate(some) if len(v) == x]) for x in {len(v) for v in some}}
    mine = [[i for i, (q, v) in enumerate(near) if q == number and len(v) == len(vector)] for number, vector in asked]
    for t in range(hashes.tables):
        rows = {x: np.floor(hashes.places(t, np.array([some[i] for i in at], np.float64))) for x, at in by.items()}
        for n, (_, vector) in enumerate(asked):
            place = hashes.places(t, np.array([vector], np.float64))[0]
            own, order = np.floor(place), {p: i for i, p in enumerate(perturbations(place, MOST_PROBES))}
            at = lambda cells: [order.get(x, none) for x in map(tuple, (cells - own).astype(np.int64).tolist())]  # noqa: B023,E731
            if mine[n]:
                hit[mine[n]] = np.minimum(hit[mine[n]], at(np.floor(hashes.places(t, np.array([near[i][1] for i in mine[n]], np.float64)))))
            if len(vector) in rows:
                seen[n, by[len(vector)]] = np.minimum(seen[n, by[len(vector)]], at(rows[len(vector)]))
        yield t + 1, hit, seen


def hashed(df: DataFrame, id_col: str, hashes: Hashes, probes: int, with_vec: bool) -> DataFrame:
    """(bucket, id[, vec]) for each table, and for each of so many probes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in range(0, batch.num_rows, 512):
                some = batch.slice(small, 512)
                for length, at in by_length(some.column(1)):
                    part = some.take(pa.array(at))
                    vectors = matrix(part.column(1))
                    for t in range(hashes.tables):
                        places = hashes.places(t, vectors)
                        cells = np.floor(places)
                        if probes > 1:
                            offsets = [perturbations(p, probes) for p in places]
                            owner = np.repeat(np.arange(len(offsets)), [len(o) for o in offsets])
                            cells = cells[owner] + np.array([x for o in offsets for x in o])
                        else:
                            owner = np.arange(len(vectors))
                        owner = pa.array(owner)
                        out = [pa.array(hashes.names(t, length, cells)), part.column(0).take(owner)]
                        yield pa.RecordBatch.from_arrays([*out, *([part.column(1).take(owner)] if with_vec else [])], names=["bucket", "id", "vec"][: 3 if with_vec else 2])
        give_back()

    kind = df.schema["vec"].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), "vec").mapInArrow(run, "bucket long, id long" + f", vec {kind}" * with_vec)


def met(rows: DataFrame, k: int) -> DataFrame:
    """(query, cid, score) from rows (bucket, a, b, asks, id, vec), dealt by bucket and chunk: the vectors of a chunk are held, the
    probes stream past them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, parts, vectors, ids = None, [], {}, {}
        for batch in batches:
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(4)])
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
                if begin == end:
                    continue
                part, name, asks = batch.slice(begin, end - begin), tuple(key[:3, begin].tolist()), key[3, begin]
                if not asks:
                    if name != held:
                        held, parts = name, []
                    parts.append(part)
                    vectors = {}
                    continue
                if name != held:
                    continue  # no vector in this bucket
                if not vectors:
                    whole = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
                    for length, at in by_length(whole.column(5)):
                        some = whole.take(pa.array(at))
                        vectors[length], ids[length] = matrix(some.column(5)), some.column(4).to_numpy()
                for length, at in by_length(part.column(5)):
                    if length in vectors:
                        some = part.take(pa.array(at))
                        row, place, score = nearest_pairs(matrix(some.column(5)), vectors[length], ids[length], k)
                        yield pa.RecordBatch.from_arrays([some.column(4).take(pa.array(row)), pa.array(ids[length][place]), pa.array(score)], names=["query", "cid", "score"])
        give_back()

    return rows.mapInArrow(run, "query long, cid long, score double")


def met_in_buckets(vectors: DataFrame, queries: DataFrame, hashes: Hashes, probes: int, k: int) -> DataFrame:
    """(query, cid, score): up to k nearest classes of each query among those that its probes meet."""
    counts = hashed(vectors, "cid", hashes, 1, False).groupBy("bucket").agg(F.count("*").alias("n"))
    asks = hashed(queries, "qid", hashes, probes, False).groupBy("bucket").agg(F.count("*").alias("m"))
    grid = counts.filter(F.col("n") > CHUNK_ROWS).join(asks, "bucket", "left").select("bucket", F.ceil(F.col("n") / CHUNK_ROWS).cast("int").alias("na"), F.ceil(F.coalesce("m", F.lit(1)) / CHUNK_PROBES).cast("int").alias("nb"))
    grid = grid.unionByName(asks.filter(F.col("m") > CHUNK_PROBES).join(counts.filter(F.col("n") <= CHUNK_ROWS), "bucket").select("bucket", F.lit(1).alias("na"), F.ceil(F.col("m") / CHUNK_PROBES).cast("int").alias("nb")))
    grid = staged(grid, "open-grids")
    chunks = sized(grid)
    cut = lambda df: df.join(chunks, "bucket", "left").withColumns({c: F.coalesce(c, F.lit(1)) for c in ("na", "nb")})
    each = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    stored = cut(hashed(vectors, "cid", hashes, 1, True)).select("bucket", own("na").alias("a"), each("nb").alias("b"), F.lit(0).alias("asks"), "id", "vec")
    asked = cut(hashed(queries, "qid", hashes, probes, True)).select("bucket", each("na").alias("a"), own("nb").alias("b"), F.lit(1).alias("asks"), "id", "vec")
    dealt = stored.unionByName(asked).repartition("bucket", "a", "b").sortWithinPartitions("bucket", "a", "b", "asks")
    found = met(dealt, k).groupBy("query", "cid").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "cid"))
    out = staged(found.withColumn("place", place).filter(F.col("place") <= k).drop("place"), "near-classes")
    unstaged(grid)
    return out


def nearest(df: DataFrame, query: str, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, id_col, score): the k nearest found of each row that the SQL condition query names, nearest first."""
    rows = usable(df, id_col, vec_col)
    vectors = staged(classes(rows, k), "vector-classes")
    wanted = usable(df.filter(query), id_col, vec_col)
    # Of one id the smallest vector; of one vector one search, named by its smallest id.
    wanted = wanted.groupBy("id").agg(F.min(F.struct("vec", "h1", "h2")).alias("x")).select("id", "x.*")
    wanted = staged(wanted.withColumn("qid", F.min("id").over(Window.partitionBy("h1", "h2"))), "asked")
    queries = staged(wanted.filter("id = qid").select("qid", "vec"), "queries")
    n = vectors.count()
    hashes, probes, _ = chosen(vectors, queries, n, k)
    found = met_in_buckets(vectors, queries, hashes, probes, k + 1)
    members = vectors.select("cid", "ids")
    named = found.join(members, "cid").select("query", "score", F.explode("ids").alias("other"))
    lists = staged(named.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "other"))).filter(F.col("place") <= k + 1).drop("place"), "near-ids")
    full = lists.groupBy("query").agg(F.count("*").alias("m")).filter(F.col("m") > k)
    short = staged(queries.join(full, queries["qid"] == full["query"], "left_anti"), "short-queries")
    others = exact_lists(vectors, members, short, k)
    unstaged(queries)
    every = lists.join(sized(short.select(F.col("qid").alias("query"))), "query", "left_anti")
    if others is not None:
        every = every.unionByName(others)
    out = wanted.select("id", F.col("qid").alias("query")).join(every, "query").filter("other <> id")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("score", "other")).cast("int")
    return out.withColumn("rank", rank).filter(F.col("rank") <= k).select(F.col("id").alias("query_id"), "rank", F.col("other").alias(id_col), "score")


def exact_lists(vectors: DataFrame, members: DataFrame, short: DataFrame, k: int) -> DataFrame | None:
    """(query, score, other) of queries that found too few: compared with all vectors, a block at a time; None without any."""
    out, above = None, None
    while True:
        rest = short if above is None else short.filter(F.col("qid") > above)
        block = rest.orderBy("qid").limit(SCAN_QUERIES).collect()
        if not block:
            return out
        above = block[-1].qid
        near = scanned(vectors, [(r.qid, list(r.vec)) for r in block], k + 1)
        named = near.join(members, "cid").select("query", "score", F.explode("ids").alias("other"))
        part = staged(named.withColumn("place", F.row_number().over(Window.partitionBy("query").orderBy("score", "other"))).filter(F.col("place") <= k + 1).drop("place"), "exact-ids")
        out = part if out is None else out.unionByName(part)


def op13_nearest(spark, sf_dir: str) -> DataFrame:
    """The ten nearest of every vector whose id is divisible by 100."""
    return nearest(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id % 100 = 0")


#: All pairs of queries and vectors; equal where the search finds every neighbour.
OP13_SQL = """
WITH good AS (
  SELECT DISTINCT vec_id, embedding::DOUBLE[] AS v FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_distance(q.v, c.v) AS score
  FROM good q JOIN good c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM pairs
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""
