"""Operator 11: the trie of conversation prefixes, with totals over subtrees.

Method: time-forward processing. Nodes are dealt in ranges of (smallest member, depth) to shards; a parent always comes before
its children in that order. Inside a shard nodes are sorted externally by reverse level order, and each hands its subtree's
totals to its parent through a priority queue that spills to disk; a message to a parent in an earlier shard is summed with
others to that parent and enters its shard in the next round, so that totals then travel across the shards' roots. Each round
reads only shards that got messages, and shards of messages only go down, so there are at most as many rounds as shards;
usually there are two or three.

Plan: turns are sorted by range, so that a conversation with a third of all turns lies in several parts; numbers and prefix
names are windows inside (conversation, part), carried over the parts of the few conversations that span them. After that only
digests of turns travel, not texts. A prefix is named by two 64-bit sums (exclusive or) of hashes of the positions and SHA-256
digests of its turns, so a node's parent is named by leaving out its last turn. Members are counted by partial aggregates: a
first turn that many share is one row per task. Shards are cut at a bounded sample, two for each core. The digest of the ids that end in a node, which SHA-256 must take in one
order, is fed in blocks of ids made beforehand, in bounded memory.

Defined results: turns are ordered by turn (null first), then role, then text; a null role or text is empty; repeated rows are
turns of their own; rows without a conversation take no part; very long texts and conversations are used whole; an empty table
gives an empty one, without a root. Other columns are not looked at.
"""

from __future__ import annotations

import bisect
import functools
import hashlib
import heapq
import pickle
import tempfile
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import sized, staged, table, unstaged

BLOCK_BITS = 12  # ids in a block: 4,096
QUEUE_ROOM = 200_000
RUN_STEP = 4_096
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def numbered(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, list[int]]:
    """(conv, part, pos, d1, d2, chars, last): turns numbered from 1 in each conversation, with digests for role and text; and the
    conversations that lie in several parts."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    rows = df.filter(F.col(f"`{conv_col}`").isNotNull()).select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), role.alias("role"), text.alias("text"))
    dealt = rows.repartitionByRange("conv", "turn", "role", "text").sortWithinPartitions("conv", "turn", "role", "text")
    digest = F.sha2(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), "utf-8"), 256)
    sixty = lambda at: F.conv(F.substring("digest", at, 15), 16, 10).cast("long")
    kept = dealt.select("conv", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"), digest.alias("digest"), F.length("text").cast("long").alias("chars"))
    parts = staged(kept.select("conv", "part", "at", sixty(1).alias("d1"), sixty(16).alias("d2"), "chars"), "turns")
    ends = parts.groupBy("part").agg(F.min("conv").alias("low"), F.max("conv").alias("high")).collect()  # one row per part
    held = Counter(c for r in ends for c in {r.low, r.high})
    spans = [c for c, n in held.items() if n > 1]
    counted = F.count("*").alias("n")
    carry = carried(parts, spans, [counted], lambda before, own: (before[0] + own.n,), (0,))
    own = Window.partitionBy("conv", "part")
    turns = parts.withColumn("in_part", F.row_number().over(own.orderBy("at"))).withColumn("n", F.count("*").over(own))
    turns = turns.join(carry.toDF("conv", "part", "before", "ends"), ["conv", "part"], "left")
    last = (F.col("in_part") == F.col("n")) & F.coalesce("ends", F.lit(True))
    out = staged(turns.select("conv", "part", (F.col("in_part") + F.coalesce("before", F.lit(0))).cast("long").alias("pos"), "d1", "d2", "chars", last.alias("last")), "numbered")
    unstaged(parts)
    return out, spans


def carried(parts: DataFrame, spans: list[int], sums: list[Column], add, start: tuple) -> DataFrame:
    """(conv, part, sums over the parts before it ..., whether it is the last part) of conversations in several parts. Each border
    between parts cuts one conversation at most, so these are at most two rows per part; they are summed on the driver."""
    rows = parts.filter(F.col("conv").isin(spans)).groupBy("conv", "part").agg(*sums).orderBy("conv", "part").collect() if spans else []
    out, before = [], start
    for i, r in enumerate(rows):
        before = before if i and rows[i - 1].conv == r.conv else start
        out.append((r.conv, r.part, *before, i + 1 == len(rows) or rows[i + 1].conv != r.conv))
        before = add(before, r)
    names = ", ".join(["conv long, part int", *(f"b{i} long" for i in range(len(start))), "ends boolean"])
    return F.broadcast(parts.sparkSession.createDataFrame(out, names))


def with_shared_heads(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt, as rows of turns, and all of them, as (conv, silent): the first h turns of conversation c - c % 100,
    then the turns of c after its own first h; h is crc32 of c in decimals, modulo 6. A silent one has no turn."""
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("n"), F.min("part").alias("part"), F.sort_array(F.collect_list(F.when(F.col("pos") <= 5, F.struct("pos", "d1", "d2", "chars")))).alias("firsts"))
    lengths = staged(lengths, "lengths")
    h = (F.crc32(F.encode(F.col("conv").cast("string"), "utf-8")) % 6).cast("long")
    bases = lengths.filter("conv % 100 = 0").select(F.col("conv").alias("base"), F.col("n").alias("base_n"), "firsts")
    convs = lengths.drop("firsts").withColumn("h", h).withColumn("base", F.col("conv") - F.col("conv") % 100).join(bases, "base", "left")
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = staged(convs.select("conv", "part", "n", "h", taken.alias("g"), F.slice(F.coalesce("firsts", F.array().cast(lengths.schema["firsts"].dataType)), F.lit(1), taken.cast("int")).alias("firsts")), "heads")
    heads = convs.select("*", F.explode("firsts").alias("x"))
    heads = heads.select("conv", "part", "x.pos", "x.d1", "x.d2", "x.chars", ((F.col("x.pos") == F.col("g")) & (F.col("n") <= F.col("h"))).alias("last"))
    own = turns.filter(F.col("pos") > h).join(sized(convs.select("conv", (F.col("g") - F.col("h")).alias("shift"))), "conv")
    own = own.select("conv", "part", (F.col("pos") + F.col("shift")).alias("pos"), "d1", "d2", "chars", "last")
    out = staged(heads.unionByName(own), "rebuilt")
    unstaged(lengths)
    return out, convs.select("conv", ((F.col("g") == 0) & (F.col("n") <= F.col("h"))).alias("silent"))


def prefixes(turns: DataFrame, spans: list[int]) -> DataFrame:
    """turns with the name of the prefix that each ends (k1, k2) and of the prefix before it (p1, p2)."""
    rows = turns.withColumns({"t1": F.xxhash64("pos", "d1", "d2"), "t2": F.xxhash64(F.lit("second"), "pos", "d1", "d2")})
    carry = carried(rows, spans, [F.bit_xor("t1").alias("x"), F.bit_xor("t2").alias("y")], lambda before, own: (before[0] ^ own.x, before[1] ^ own.y), (0, 0))
    own = Window.partitionBy("conv", "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"r1": F.bit_xor("t1").over(own), "r2": F.bit_xor("t2").over(own)}).join(carry.toDF("conv", "part", "c1", "c2", "ends"), ["conv", "part"], "left")
    name = lambda i: F.col(f"r{i}").bitwiseXOR(F.coalesce(F.col(f"c{i}"), F.lit(0)))
    rows = rows.withColumns({"k1": name(1), "k2": name(2)})
    return rows.select("conv", "pos", "chars", "last", "k1", "k2", F.col("k1").bitwiseXOR(F.col("t1")).alias("p1"), F.col("k2").bitwiseXOR(F.col("t2")).alias("p2"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, ends_sha256) from rows (depth, k1, k2, conv): of the ids in numeric order, joined by commas."""
    key = ["depth", "k1", "k2"]
    block = ends.groupBy(*key, F.shiftright("conv", BLOCK_BITS).alias("block")).agg(F.concat_ws(",", F.transform(F.array_sort(F.collect_list("conv")), lambda x: x.cast("string"))).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, running = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                if own != name:
                    if name is not None:
                        done.append((*name, running.hexdigest()))
                    name, running = own, hashlib.sha256(ids.encode())
                else:
                    running.update(b"," + ids.encode())
            yield batch_of(done, ["depth", "k1", "k2", "ends_sha256"])
        if name is not None:
            yield batch_of([(*name, running.hexdigest())], ["depth", "k1", "k2", "ends_sha256"])

    dealt = block.repartition(*key).sortWithinPartitions(*key, "block").select(*key, "block", "ids")
    return dealt.mapInArrow(run, "depth long, k1 long, k2 long, ends_sha256 string")


def batch_of(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string() if n == "ends_sha256" else pa.int64()) for c, n in zip(columns, names, strict=True)], names=names)


def nodes_of(turns: DataFrame, convs: DataFrame, spans: list[int]) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_ends, chars, ends_sha256) of every node, the root included."""
    rows = staged(prefixes(turns, spans), "prefixes")
    key = [F.col("pos").alias("depth"), "k1", "k2"]
    nodes = rows.groupBy(*key).agg(
        F.min("conv").alias("conv_id"), F.count("*").alias("n_convs"), F.count_if("last").alias("n_ends"), F.min("chars").alias("chars"), F.min("p1").alias("p1"), F.min("p2").alias("p2")
    )
    nodes = staged(nodes, "nodes")
    zero = [F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2")]
    digests = ends_digests(rows.filter("last").select(*key, "conv").unionByName(convs.filter("silent").select(*zero, "conv")))
    total, first, quiet = convs.agg(F.count("*"), F.min("conv"), F.count_if("silent")).first()
    root = rows.sparkSession.createDataFrame([(0, 0, 0, first, None, total, quiet, 0)] if total else [], "depth long, k1 long, k2 long, conv_id long, parent_conv_id long, n_convs long, n_ends long, chars long")
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    deep = nodes.filter("depth > 1").join(above, ["depth", "p1", "p2"])
    top = nodes.filter("depth = 1").withColumn("parent_conv_id", F.lit(first).cast("long"))
    columns = root.columns
    every = root.unionByName(top.select(columns)).unionByName(deep.select(columns)).join(digests, ["depth", "k1", "k2"], "left")
    out = staged(every.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_ends", "chars", F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")), "trie")
    unstaged(rows, nodes)
    return out


class SpillingQueue:
    """A priority queue of messages (-depth, id, leaves, saved). What exceeds its room goes to disk in sorted runs, which are read
    back from the front, a step at a time; the files have no names and end with the task."""

    def __init__(self, room: int = QUEUE_ROOM):
        self.room, self.heap, self.runs, self.spilled = room, [], [], 0

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.room:
            self.spill()
        heapq.heappush(self.heap, item)

    def spill(self) -> None:
        run = tempfile.TemporaryFile()  # noqa: SIM115  closed when it is read
        self.heap.sort()
        for at in range(0, len(self.heap), RUN_STEP):
            pickle.dump(self.heap[at : at + RUN_STEP], run)
        run.seek(0)
        self.heap, self.spilled = [], self.spilled + 1
        self.refill(run, self.spilled)

    def refill(self, run, number: int) -> None:
        """The next step of a run becomes its front."""
        try:
            step = pickle.load(run)[::-1]
        except EOFError:
            run.close()
            return
        heapq.heappush(self.runs, (step[-1], number, step, run))

    def received(self, depth: int, name: int) -> tuple[int, int]:
        """Sums of the messages to one node; those to nodes before it are gone by then."""
        key, leaves, saved = (-depth, name), 0, 0
        while True:
            if self.heap and self.heap[0][:2] == key:
                item = heapq.heappop(self.heap)
            elif self.runs and self.runs[0][0][:2] == key:
                _, number, step, run = heapq.heappop(self.runs)
                item = step.pop()
                if step:
                    heapq.heappush(self.runs, (step[-1], number, step, run))
                else:
                    self.refill(run, number)
            else:
                return leaves, saved
            leaves, saved = leaves + item[2], saved + item[3]


def forwarded(rows: DataFrame, lows: list[tuple[int, int]], room: int) -> DataFrame:
    """One round over rows (shard, depth, conv_id, node, parent_conv_id, leaves, saved), sorted by shard, falling depth, conv_id
    and node; rows with node 0 are messages to the node after them. lows: the first (conv_id, depth) of each shard.

    Gives (conv_id, depth, leaves, saved, shard): what is added to a node (shard null), or a message to one in an earlier shard."""
    names = ["conv_id", "depth", "leaves", "saved", "shard"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, queue, leaves, saved = None, None, 0, 0
        for batch in batches:
            done = []
            for s, depth, conv, node, parent, own_leaves, own_saved in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s != shard:
                    shard, queue, leaves, saved = s, SpillingQueue(room), 0, 0
                leaves, saved = leaves + own_leaves, saved + own_saved
                if not node:
                    continue
                more = queue.received(depth, conv)
                leaves, saved = leaves + more[0], saved + more[1]
                if leaves or saved:
                    done.append((conv, depth, leaves, saved, None))
                    if depth and (parent, depth - 1) >= lows[shard]:
                        queue.push((1 - depth, parent, leaves, saved))
                    elif depth:
                        done.append((parent, depth - 1, leaves, saved, bisect.bisect_right(lows, (parent, depth - 1)) - 1))
                leaves, saved = 0, 0
            yield batch_of(done, names)

    return rows.mapInArrow(run, "conv_id long, depth long, leaves long, saved long, shard long")


def sharded(nodes: DataFrame) -> tuple[DataFrame, list[tuple[int, int]]]:
    """nodes with their shard, and the lower bounds of the shards: ranges of (conv_id, depth) of about equal size, cut at a
    bounded sample (the smallest hashes), two for each core."""
    wanted = 2 * nodes.sparkSession.sparkContext.defaultParallelism
    sample = nodes.select("conv_id", "depth").orderBy(F.xxhash64("conv_id", "depth")).limit(32 * wanted).collect()
    found = sorted({(r.conv_id, r.depth) for r in sample})
    lows = [(-(2**63), 0), *found[len(found) // wanted :: max(1, len(found) // wanted)][: wanted - 1]]
    names = nodes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(lows, x) - 1 for x in zip(batch.column("conv_id").to_pylist(), batch.column("depth").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int64())], names=[*names, "shard"])

    return nodes.mapInArrow(run, ", ".join(f"{c} long" for c in [*names, "shard"])), lows


def subtree_totals(nodes: DataFrame, room: int = QUEUE_ROOM) -> DataFrame:
    """(conv_id, depth, n_children, n_leaves, saved_tokens) of every node of nodes_of."""
    own = nodes.select("conv_id", "depth", "parent_conv_id", (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaves"), ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    dealt, lows = sharded(own)
    shards = staged(dealt, "trie-shards")
    node = lambda df: df.select("shard", "depth", "conv_id", F.lit(1).cast("long").alias("node"), "parent_conv_id", "leaves", "saved")
    rows, rounds = node(shards), []
    while True:
        ordered = rows.repartition("shard").sortWithinPartitions("shard", F.desc("depth"), "conv_id", "node")
        out = staged(forwarded(ordered, lows, room), "trie-round")
        rounds.append(out)
        sent = out.filter("shard IS NOT NULL")
        reached = [r.shard for r in sent.groupBy("shard").count().collect()]  # at most all shards
        if not reached:
            break
        quiet = shards.filter(F.col("shard").isin(reached)).withColumns({c: F.lit(0).cast("long") for c in ("leaves", "saved")})
        sent = sent.groupBy("shard", "depth", "conv_id").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        rows = node(quiet).unionByName(sent.select("shard", "depth", "conv_id", F.lit(0).cast("long").alias("node"), F.lit(None).cast("long").alias("parent_conv_id"), "leaves", "saved"))
    zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    parts = [r.filter("shard IS NULL").select("conv_id", "depth", zero.alias("children"), "leaves", "saved") for r in rounds]
    parts.append(nodes.filter("depth > 0").select(F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth"), one.alias("children"), zero.alias("leaves"), zero.alias("saved")))
    every = functools.reduce(DataFrame.unionByName, parts)
    out = every.groupBy("conv_id", "depth").agg(F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"))
    out = staged(out, "trie-totals")
    unstaged(shards, *rounds)
    return out


def prefix_trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", shared_heads: bool = False) -> DataFrame:
    """A row for each distinct sequence of first turns of the conversations in df: conv_id (smallest member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens and ends_sha256. With shared_heads conversations are rebuilt
    first, as with_shared_heads says."""
    turns, spans = numbered(df, conv_col, turn_col, role_col, text_col)
    convs = turns.filter("pos = 1").select("conv", F.lit(False).alias("silent"))
    rebuilt, convs = with_shared_heads(turns) if shared_heads else (turns, convs)
    nodes = nodes_of(rebuilt, convs, spans)
    totals = subtree_totals(nodes)
    return nodes.join(totals, ["conv_id", "depth"]).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def op11_prefix_trie(spark, sf_dir: str) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(table(spark, sf_dir, "conversations"), shared_heads=True)


OP11_SQL = r"""
WITH RECURSIVE bits AS (
  SELECT i::BIGINT AS n, 0 AS k, i::BIGINT AS v FROM range(256) t(i)
  UNION ALL SELECT n, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END FROM bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY n) AS crc FROM bits WHERE k = 8
), numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT)),
      lambda c, b: xor(crc[(xor(c, b) & 255) + 1], c >> 8)), 4294967295::BIGINT) % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM numbered), crc_table
), turns AS (
  SELECT c.conv_id, 0 AS own, n.pos, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.base AND n.pos <= c.h
  UNION ALL SELECT c.conv_id, 1, n.pos, n.role, n.text FROM convs c JOIN numbered n ON n.conv_id = c.conv_id AND n.pos > c.h
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM turns
), keyed AS (
  SELECT conv_id, depth, length(text) AS chars, count(*) OVER (PARTITION BY conv_id) AS len,
    string_agg(length(role) || ':' || length(text) || ':' || role || text, '') OVER (PARTITION BY conv_id ORDER BY depth) AS key FROM placed
), every AS (
  SELECT conv_id, depth, chars, len = depth AS ends, sha256(key) AS key FROM keyed
  UNION ALL SELECT c.conv_id, 0, 0, NOT EXISTS (SELECT 1 FROM placed p WHERE p.conv_id = c.conv_id), '' FROM convs c
), nodes AS (
  SELECT depth, key, min(conv_id) AS conv_id, count(*) AS n_convs, min(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM every GROUP BY depth, key
), parents AS (
  SELECT n.*, p.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN every e ON e.conv_id = n.conv_id AND e.depth = n.depth - 1 LEFT JOIN nodes p ON p.depth = e.depth AND p.key = e.key
), children AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM parents WHERE depth > 0 GROUP BY ALL
), leafy AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM parents n LEFT JOIN children c USING (conv_id, depth)
), totals AS (
  SELECT e.depth, e.key, count(*) FILTER (n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved_tokens
  FROM leafy n JOIN every e ON e.conv_id = n.conv_id AND e.depth <= n.depth GROUP BY e.depth, e.key
)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM leafy JOIN totals USING (depth, key)
"""
