"""Nearest neighbours: recall against brute force, exact radius retrieval, odd rows."""

import math

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm import ann, common, queries

SCHEMA = "vec_id long, embedding array<float>, label int, id string"


def brute(rows, k=10):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            d = {}
            for i, w in rows:
                if i != q:
                    x = math.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))
                    d[i] = min(x, d.get(i, x))
            out[q] = sorted((x, i) for i, x in d.items())[:k]
    return out


def test_query_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in common.read(spark, "/root/testdata/sf0.01", "embeddings").collect()]
    want, got = brute(rows), {}
    for r in queries.op5_ann(spark, "/root/testdata/sf0.01").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hit = 0
    for q, found in got.items():
        found.sort()
        assert [f[0] for f in found] == list(range(1, 11))
        true = {i: x for x, i in want[q]}
        hit += sum(i in true for _, i, _ in found)
        assert all(abs(true[i] - s) < 1e-12 for _, i, s in found if i in true)
        assert [(s, i) for _, i, s in found] == sorted((s, i) for _, i, s in found)
    assert hit >= 0.9 * 10 * len(want)


def test_every_code_within_the_radius_is_found():
    rng = np.random.default_rng(4)
    for dim in (5, 16, 24, 40, 64, 90):
        x = rng.normal(size=(400, dim))
        coder = ann.fit_coder(x[:200])
        block = ann.Block(coder, np.arange(400), x)
        for q in range(0, 400, 57):
            for radius in (0, 1, 2, 3, 7, 12, coder.rotation.shape[1]):
                far = np.bitwise_count(block.codes ^ block.codes[q])
                assert np.array_equal(block.within(block.codes[q], radius), np.flatnonzero(far <= radius))


def test_edge_cases(spark):
    rng = np.random.default_rng(5)
    good = [(i, rng.normal(size=8).tolist()) for i in range(40)] + [(100, [1.0] * 8), (200, [1.0] * 8), (300, [1.0] * 8), (7, [1.0] * 8), (200, [1.0] * 8)]
    good = [(i, [float(np.float32(x)) for x in v]) for i, v in good]
    bad = [(400, None), (500, []), (600, [0.0] * 8), (700, [float("nan")] + [1.0] * 7), (800, [float("inf")] + [1.0] * 7),
           (900, [None] + [1.0] * 7), (None, [1.0] * 8), (1000, [1.0] * 9)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in good + bad], SCHEMA)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 100 == 0, wanted=1.0, index_block=16, query_block=2).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    want = brute(good)
    assert set(got) == set(want)
    for q in want:
        assert len(got[q]) == 10 and got[q][:3] == want[q][:3] if q else True
        assert len({i for _, i in got[q]} & {i for _, i in want[q]}) >= 9
    few = spark.createDataFrame([(i, v, 1, "x") for i, v in good[:3] + good[40:41]], SCHEMA)
    assert ann.search(few, F.col("vec_id") == 100).count() == 3
    assert ann.search(df.limit(0), F.col("vec_id") == 100).count() == 0
    assert ann.search(df, F.lit(False)).count() == 0
