"""Prefix trie: equal to a plain dictionary of prefixes, whatever the size of the shards."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from ledgerlake.llm import common, queries, trie

SF = "/root/testdata/sf0.001"


def brute(paths):
    """paths: conv_id -> list of (role, text)."""
    members, ends = {}, {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    below = {}
    for p in members:
        for d in range(len(p) + 1):
            below.setdefault(p[:d], []).append(p)
    children = {p: sum(len(q) == len(p) + 1 for q in below[p]) for p in members}

    def saved(p):
        return (len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0

    return sorted((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p],
                   sum(children[q] == 0 for q in below[p]), sum(map(saved, below[p])),
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()) for p, m in members.items())


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def key(row):
    return tuple((v is None, v) for v in row)


def frames(spark, paths):
    turns = [(c, d, role, text) for c, p in paths.items() for d, (role, text) in enumerate(p)]
    return (spark.createDataFrame(turns, "conv_id long, position long, role string, text string"),
            spark.createDataFrame([(c,) for c in paths], "conv_id long"))


def test_query_equals_brute_force(spark):
    rows = {}
    for r in common.read(spark, SF, "conversations").collect():
        rows.setdefault(r.conv_id, []).append((r.turn is not None, r.turn or 0, r.role or "", r.text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in rows.items()}
    paths = {}
    for c, p in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = own.get(c - c % 20, [])[:h] + p[h:]
    assert sorted(rows_of(queries.op12_prefixtrie(spark, SF)), key=key) == sorted(brute(paths), key=key)


@pytest.mark.parametrize("shard_turns", [2, 9, 40, 100_000])
def test_random_paths(spark, shard_turns):
    rng = random.Random(shard_turns)
    paths = {}
    for c in range(-20, 150):
        hot = [("user", "hello there"), ("assistant", "hi"), ("user", "a b c")] * 3 if rng.random() < 0.4 else []
        paths[c * 7] = hot[:rng.randrange(0, 10)] + [(rng.choice("ua"), rng.choice(["x", "y z", ""])) for _ in range(rng.randrange(0, 5))]
    paths |= {c: [("user", "hello there")] * 4 for c in range(5000, 5700)}
    got = rows_of(trie.nodes(*frames(spark, paths), shard_turns=shard_turns))
    assert sorted(got, key=key) == sorted(brute(paths), key=key)


def test_double_array():
    rng = random.Random(5)
    paths = sorted({tuple(rng.randrange(1, 30) for _ in range(rng.randrange(0, 6))) for _ in range(400)})
    flat = np.array([c for p in paths for c in p], np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in paths])))
    states = trie.DoubleArray(flat, offsets).walk(flat, offsets)
    at = {}
    for p, a in zip(paths, offsets):
        for d in range(len(p)):
            assert at.setdefault(p[:d + 1], int(states[a + d])) == states[a + d]
    assert len(set(at.values())) == len(at)


def test_edge_cases(spark):
    turns = spark.createDataFrame(
        [(1, 0, None, None, "x"), (1, 1, "u", "a", "x"), (1, 1, "u", "a", "x"), (None, 0, "u", "lost", "x"), (2, 5, "", "", None)],
        "conv_id long, position long, role string, text string, node string")
    convs = spark.createDataFrame([(1,), (2,), (3,), (3,), (None,)], "conv_id long")
    want = brute({1: [("", ""), ("u", "a"), ("u", "a")], 2: [("", "")], 3: []})
    assert sorted(rows_of(trie.nodes(turns, convs)), key=key) == sorted(want, key=key)
    assert trie.nodes(turns.limit(0), convs.limit(0)).count() == 0
    assert [tuple(r)[:7] for r in trie.nodes(turns.limit(0), convs).collect()] == [(1, 0, None, 3, 0, 1, 0)]
