"""Quality network: brute-force convolution, held-out accuracy, odd inputs."""

import zlib

import numpy as np

from ledgerlake.llm import common, quality, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    docs = common.read(spark, SF, "documents").collect()
    assert set(got) == {r.doc_id for r in docs}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    labels = [(got[r.doc_id], r.quality) for r in common.read(spark, SF, "labels").collect()]
    seen = [(g.predicted, y) for g, y in labels if g.held_out]
    assert np.mean([p == y for p, y in seen]) >= 0.9
    assert np.mean([p for p, y in seen if y == 1]) >= 0.95


def slow_logits(model, text):
    """The network written out position by position."""
    width, half, F = len(model.tables), model.chunk // 2, model.tables.shape[2]
    n = max(1, len(text) - width + 1)
    text = text + bytes(width)
    at = [[sum(model.tables[j][text[i + j]][f] for j in range(width)) for f in range(F)] for i in range(n)]
    out = []
    for c in range(max(1, -(-n // half) - 1)):
        top = np.max(at[c * half:c * half + model.chunk], axis=0)
        out.append(np.maximum(top + model.offset, 0) @ model.weights + model.bias)
    return np.array(out)


def test_chunks_cover_the_whole_text():
    rng = np.random.default_rng(1)
    model = quality.Model(rng.normal(size=(3, 256, 4)).astype(np.float32), rng.normal(size=4), rng.normal(size=4),
                          0.1, (1.0, 0.0), 16)
    for n in (0, 1, 2, 3, 9, 10, 11, 17, 18, 19, 40, 700, 1300):
        text = rng.integers(0, 256, n, np.uint8).tobytes()
        assert np.allclose(model.chunk_logits(text), slow_logits(model, text), atol=1e-4)


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "x" * 500_000), (None, "no id"), (4, "same"), (4, "same")]
    df = spark.createDataFrame([(d, t, 0.5, "z") for d, t in rows], "doc_id long, text string, score double, `a b` string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.fit(df, none, "doc_id", "text", "quality")
    assert model.constant == 0.5
    odd = spark.createDataFrame([(1, None), (3, 1), (3, 1), (None, 0), (9, 7)], "doc_id long, quality int")
    assert 0.5 < quality.fit(df, odd, "doc_id", "text", "quality").constant < 1
    both = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    texts = spark.createDataFrame([(i, ("good words here " if i % 2 else "%%% ### ") * 9) for i in range(20)], "doc_id long, text string")
    model = quality.fit(texts, both, "doc_id", "text", "quality", epochs=60)
    scored = quality.with_score(df, "text", model, "s2")
    assert scored.columns == [*df.columns, "s2"] and scored.count() == len(rows)
    assert all(0 <= r.s2 <= 1 for r in scored.collect())
    assert quality.keep_good(texts, "text", model).columns == texts.columns
    assert {r.doc_id % 2 for r in quality.keep_good(texts, "text", model).collect()} == {1}
    assert quality.with_score(df.limit(0), "text", model, "s2").count() == 0
