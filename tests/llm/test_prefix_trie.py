"""Operator 11 against a plain version, its parts, and odd cases."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from compare import duck_rows, spark_rows

from tidemark.llm import common, prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string, n_convs string"


def plain(rows, shared_heads=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared_heads else 0
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in sorted(members, key=len, reverse=True):
        leaves[p] += not children[p]
        saved[p] += (len(members[p]) - 1) * (len(p[-1][1]) if p else 0)
        if p:
            for x, v in ((children, 1), (leaves, leaves[p]), (saved, saved[p])):
                x[p[:-1]] += v
    out = set()
    for p, convs in members.items():
        ends = ",".join(map(str, sorted(c for c in convs if len(built[c]) == len(p))))
        out.add((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "own", "own") for r in rows], SCHEMA).repartition(3)
    out = prefix_trie.prefix_trie(df, **options)
    assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.fixture
def shards(spark):
    """Many small parts, so that conversations span parts and the trie spans shards."""
    held = {"spark.sql.shuffle.partitions": "7", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def conversations():
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["user", "assistant"]), rnd.choice(["yes", "no", "é😀", ""])) for c in [*range(0, 260), *range(-120, -80), 400, 407, 999_999_999_999] for t in range(rnd.choice([1, 1, 2, 4, 7]))]
    rows += [(c, t, "user", f"common {t}") for c in range(1000, 1200) for t in range(8)]  # one conversation of many
    rows += [(50, t, "user", "long" if t % 3 else None) for t in range(10, 700)]  # one conversation with a third of all turns
    rows += [(300, None, None, None), (300, None, "a", None), (300, 5, None, "x" * 100_000), (300, 5, None, "x" * 100_000), (None, 1, "user", "no conversation"), (301, 1, "user", "b"), (302, None, None, None)]
    return rows


@pytest.mark.parametrize("broadcast", [True, False])
def test_over_shards(spark, shards, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(prefix_trie, "sized", lambda df: common.sized(df, 0))
    monkeypatch.setattr(prefix_trie, "BLOCK_BITS", 3)
    rounds, forwarded = [], prefix_trie.forwarded
    monkeypatch.setattr(prefix_trie, "forwarded", lambda rows, lows, room: rounds.append(len(lows)) or forwarded(rows, lows, 5))
    rows = conversations()
    assert found(spark, rows, shared_heads=True) == plain(rows)
    assert len(rounds) > 1 and rounds[0] > 3


def test_one_shard_and_no_heads(spark):
    rows = conversations()[::2]
    assert found(spark, rows) == plain(rows, shared_heads=False)
    assert found(spark, rows, shared_heads=True) == plain(rows)


def test_few_and_none(spark):
    assert found(spark, [], shared_heads=True) == set()
    assert found(spark, [(None, 1, "user", "x")]) == set()
    silent = [(c, 0, "user", "x") for c in range(101, 140)]  # no base: some are left without a turn
    assert found(spark, silent, shared_heads=True) == plain(silent)
    assert any(r[1] == 0 and r[3] > r[4] for r in plain(silent))


def test_queue_spills_and_merges():
    rnd = random.Random(9)
    for room in (1, 3, 50, 10**6):
        queue, want = prefix_trie.SpillingQueue(room), defaultdict(lambda: [0, 0])
        for _ in range(2000):
            d, name, a, b = rnd.randint(0, 4), rnd.randint(0, 30), rnd.randint(0, 9), rnd.randint(0, 9)
            queue.push((-d, name, a, b))
            want[-d, name][0] += a
            want[-d, name][1] += b
        assert bool(queue.spilled) == (room < 2000)
        for (d, name), sums in sorted(want.items()):
            assert queue.received(-d, name - 1 if (d, name - 1) not in want and name else name + 1000) == (0, 0)
            assert list(queue.received(-d, name)) == sums
        assert not queue.heap and not queue.runs


def test_sql_on_a_given_table(spark, shards):
    assert spark_rows(prefix_trie.op11_prefix_trie(spark, "/root/testdata/sf0.01")) == duck_rows(prefix_trie.OP11_SQL, "/root/testdata/sf0.01")
