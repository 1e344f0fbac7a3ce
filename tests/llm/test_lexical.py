"""Ranked lexical search: equal to scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerlake.llm import common, lexical, queries

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    """Rows (item_id, rank, score, doc_id); ids may repeat."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, n_terms = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in items:
        found = []
        for i, c in counted:
            n = sum(c.values())
            m = 100 - 25 + 25 * n * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, r + 1, -s, None if none else i) for r, (s, none, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(((r.item_id, r.rank, r.score, r.doc_id) for r in df.collect()), key=repr)


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.read(spark, SF, "documents").collect()]
    items = [(r.item_id, r.text) for r in common.read(spark, SF, "benchmark").collect()]
    assert rows_of(queries.op13_lexical(spark, SF)) == brute(docs, items)


@pytest.mark.parametrize("blocks", [{}, {"block_items": 7}, {"block_bytes": 300}])
def test_random_texts(spark, blocks):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)] + ["Ünï", "中文", "A1", "a1"]
    cuts = [" ", ", ", "-", "\x00", "\n", "_", "{", "\x7f"]

    def text(n):
        return "".join(rng.choice(words[:rng.choice([5, 44])]) + rng.choice(cuts) for _ in range(rng.randrange(n)))

    docs = [(rng.randrange(400) if rng.random() < 0.95 else None, text(30)) for _ in range(600)] + [(7, "w1 w2")] * 50
    items = [(i % 25, text(12)) for i in range(30)]
    got = lexical.search(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), k=5, **blocks)
    assert rows_of(got) == brute(docs, items, 5)


def some_batch(rng, n, topics):
    """Documents of so many topics, as the arrays of a batch."""
    found = [Counter(rng.choices(range(20 * (topic := rng.randrange(topics)), 20 * topic + 20), k=rng.randrange(5, 60))) for _ in range(n)]
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in found])))
    term = np.array([t for c in found for t in sorted(c)])
    tf = np.array([c[t] for c in found for t in sorted(c)])
    return np.array([sum(c.values()) for c in found]), offsets, term, tf


@pytest.mark.parametrize("exact", [True, False])
def test_bounds_prune_and_lose_nothing(exact):
    rng = random.Random(9)
    topics, n = 50, 6000
    weights = np.array([rng.randrange(1, 9000) for _ in range(20 * topics)])
    asked = [{rng.randrange(20 * (t := rng.randrange(topics)), 20 * t + 20): rng.randrange(1, 3) for _ in range(6)} for _ in range(100)]
    tree, compared = lexical.ItemTree(asked, weights, 10), []
    tree.exact = exact
    every = [[] for _ in asked]
    for batch in range(3):
        numbers, offsets, term, tf = some_batch(rng, n, topics)
        ids = list(range(batch * n, (batch + 1) * n))
        docs = lexical.DocTree(numbers, offsets, term, tf, 3 * n, 3 * n * 30, weights)
        compared.append(lexical.search_batch(tree, docs, n, ids))
        value = lexical.impact(tf, (75 + 25 * numbers * 3 * n // (3 * n * 30))[np.repeat(np.arange(n), np.diff(offsets))])
        scores = np.zeros((len(asked), n), np.int64)
        for row, item in enumerate(asked):
            for t, c in item.items():
                here = term == t
                scores[row, np.repeat(np.arange(n), np.diff(offsets))[here]] += c * weights[t] * value[here]
            every[row] += [(-int(s), False, ids[d]) for d, s in enumerate(scores[row]) if s > 0]
    for at, row in enumerate(tree.order):
        assert tree.best[at] == sorted(every[row])[:10]
    assert max(compared[1:]) < len(asked) * n / 4


def test_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "?!", None), (None, "Rain rain", "x"), (5, "rain", "x"), (6, "rain", "x"),
                                  (6, "rain", "x"), (7, "sun " * 100_000, "x")], "doc_id long, text string, score string")
    items = spark.createDataFrame([(1, "RAIN", 1), (1, "RAIN", 1), (2, None, 1), (None, "sun", 1), (4, "--", 1)], "item_id long, text string, n int")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(lexical.search(docs, items)) == want and len(want) == 9
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0
