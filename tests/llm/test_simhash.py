"""SimHash near-duplicates against brute force."""

import random

import xxhash
from pyspark.sql import functions as F

from ledgerlake.llm import common, queries, simhash
from ledgerlake.llm.components import connected_components

SF = "/root/testdata/sf0.001"


def plain_simhash(text, k=3):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute(rows, max_bits=3):
    fps = [plain_simhash(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        r = find(i)
        if d is not None:
            least[r] = min(d, least.get(r, d))
    return sorted((-1 if d is None else d, f"{fps[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows))


def test_query_equals_brute_force(spark):
    got = sorted(tuple(r) for r in queries.op3_simhash(spark, SF).collect())
    rows = [(r.doc_id, r.text) for r in common.read(spark, SF, "documents").collect()]
    assert got == brute(rows)


def test_edge_cases(spark):
    long = "long " * 70000 + "end"
    rows = [(5, None), (2, ""), (7, " \t\n"), (None, "A b"), (3, "a B"), (3, "a B"), (9, long), (8, long),
            (4, "ünï   code"), (None, "alone here now")]
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in rows], "doc_id long, text string, fp int, component_id string")
    got = sorted((-1 if r[0] is None else r[0], r.fingerprint, r.component_id)
                 for r in simhash.near_duplicates(df, "doc_id", "text").drop("text_key").collect())
    assert got == brute(rows)
    kept = simhash.keep_one(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted((-1 if r.doc_id is None else r.doc_id) for r in kept.collect()) == [-1, -1, 2, 3, 4, 8]
    assert simhash.near_duplicates(df.limit(0), "doc_id", "text").count() == 0
    assert simhash.keep_one(df.limit(0), "doc_id", "text").count() == 0


def test_links_find_every_pair(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(150)}
    for f in list(fps):
        for d in (1, 2, 3, 4):
            x = f
            for b in rng.sample(range(64), d):
                x ^= 1 << b
            fps.add(x)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3}
    for segments in (2, 3, 4):
        got = [tuple(r) for r in simhash.links(df, 3, segments).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + \
        [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)] + [(7, 7), (None, 3)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    root = {}

    def find(x):
        root.setdefault(x, x)
        return x if root[x] == x else find(root[x])
    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in root}


def test_multiset_of_rows_is_kept(spark):
    df = spark.range(50).select(F.col("id").alias("doc_id"), F.concat(F.lit("same words here "), F.col("id") % 2).alias("text"))
    assert simhash.near_duplicates(df, "doc_id", "text").count() == 50


def test_the_balls_are_not_broadcast(spark):
    """Spark sizes an exploded table as before explode, so it would send all balls through the driver."""
    fps = [0, 1, 6, 1 << 40, (1 << 40) | 1, 1 << 20 | 0xff]
    found = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    assert sorted(map(tuple, found.collect())) == sorted(
        (a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
