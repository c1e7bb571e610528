from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barloom.llm import trie

CONVS = "conv_id long, turn long, role string, text string, depth int, a long, root string, part int, ends string"


def convs_of(spark, rows):
    """Turns with extra columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, 2, "x", 3, "y") for r in rows], CONVS)


def digest(role, text):
    role, text = role or "", text or ""
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()


def brute_force(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            turns[c].append((t is not None, t or 0, digest(role, text), (role or "", text or "")))
    turns = {c: [x[3] for x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        path = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[k] for k in kids[p]) or 1
        saved[p] = (len(members[p]) - 1) * (len(p[-1][1]) if p else 0) + sum(saved[k] for k in kids[p])
    return Counter(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()) for p, m in members.items())


def got(df):
    return Counter(tuple(r) for r in df.collect())


def some(seed, convs=230, most=9, words=2):
    rng = random.Random(seed)
    out = []
    for c in rng.sample(range(-150, 450), convs):
        for t in range(rng.randint(1, most)):
            turn = rng.choice([None, t, t, t, t])
            out.append((c, turn, rng.choice(["user", "assistant", None, ""]), rng.choice(["", None, "é" * 3, "x", *"ab"][-words - 2:])))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("heavy", "pieces", "bucket"), [(1 << 16, 1 << 16, 1 << 20), (40, 7, 50), (3, 2, 10), (1, 1, 1 << 20)])
def test_trie_equals_brute_force(spark, monkeypatch, heavy, pieces, bucket):
    monkeypatch.setattr(trie, "PIECE_IDS", pieces)
    monkeypatch.setattr(trie, "BUCKET_ROWS", bucket)
    rows = some(heavy)
    df = convs_of(spark, rows).repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many small ranges
    try:
        out = trie.prefix_trie(df, heavy_nodes=heavy)
        assert out.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                               "ends_sha256"]
        assert got(out) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("heavy", [1 << 16, 5])
def test_long_and_copied_conversations_spread_over_ranges(spark, heavy):
    rng = random.Random(9)
    rows = [(c, t, "user", rng.choice("ab")) for c in (0, 3, 105) for t in range(400)]
    rows += [(c, t, "assistant", f"copy {t}") for c in range(10, 90) for t in range(6)]
    rows += [(7, t, *x[2:]) for t, x in enumerate(r for r in rows if r[0] == 3)] + [(8, 1, None, None)] * 300
    rows += [(None, 1, "user", "of none")]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert got(trie.prefix_trie(convs_of(spark, rows).repartition(5), heavy_nodes=heavy)) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_empty_and_single(spark):
    assert trie.prefix_trie(convs_of(spark, [])).count() == 0
    one = [(5, None, None, None)]
    assert got(trie.prefix_trie(convs_of(spark, one))) == brute_force(one)


def test_perfect_hash_is_minimal_and_compares_keys():
    rng = np.random.default_rng(1)
    keys = (rng.integers(0, 9, 5000), rng.integers(0, 1 << 62, 5000).astype(np.uint64), rng.integers(0, 3, 5000).astype(np.uint64))
    table = trie.NodeTable(tuple(np.r_[k, k] for k in keys))
    assert sorted(table.slots(keys)) == list(range(5000))
    other = (keys[0], keys[1] + np.uint64(1), keys[2])
    assert (table.slots(other, all_known=False) == -1).all()
    with pytest.raises(ValueError):
        table.slots(other)
    with pytest.raises(ValueError, match="one digest"):
        one = np.ones(2, np.int64)
        lanes = np.ones(2, np.uint64)
        trie._scattered(one, lanes, lanes, lanes, lanes, one, np.array([1, 2]), one)
