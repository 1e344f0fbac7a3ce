"""Decontamination against brute force."""

import math
import random
import re

from ledgerlake.llm import common, decontam, queries

SF = "/root/testdata/sf0.001"


def grams(text, k=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(docs, bench, threshold=0.8):
    out = set()
    for item, t in bench:
        want = grams(t)
        for doc, text in set(docs):
            n = len(want & grams(text))
            if want and n >= math.ceil(threshold * len(want) - 1e-9):
                out.add((doc, item, len(want), n))
    return out


def test_query_equals_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in common.read(spark, SF, "documents").collect()]
    bench = [(r.item_id, r.text) for r in common.read(spark, SF, "benchmark").collect()]
    got = [tuple(r) for r in queries.op8_decontamination(spark, SF).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(docs, bench) and got


def test_edges_of_the_threshold(spark):
    rng = random.Random(8)
    w = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    bench = [(i, w(rng.choice([4, 5, 6, 9, 12, 13, 19, 20, 21, 36, 68]))) for i in range(60)]
    docs = []
    for i in range(200):
        item = list(bench[rng.randrange(len(bench))][1])
        for _ in range(rng.randrange(0, 4)):
            item[rng.randrange(len(item))] = "changed"
        text = w(rng.randrange(0, 3000)) + item + w(rng.randrange(0, 30))
        docs.append((i, rng.choice([" ", "\n", " \t "]).join(text).title()))
    bench = [(i, " ".join(t)) for i, t in bench] + [(100, None), (101, ""), (102, "too few words here"), (3, "x y z u v w")]
    docs += [(900, None), (901, ""), (902, "a " * 50000), (None, docs[0][1]), (5, docs[5][1]), (5, "x y z u v w"), (5, "x y z u v w")]
    d = spark.createDataFrame([(a, b, 1, "q") for a, b in docs], "doc_id long, text string, item_id int, words string")
    b = spark.createDataFrame([(a, b, 2) for a, b in bench], "item_id long, text string, doc_id int")
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontam.contaminated(d, b).collect()}
    assert got == brute(docs, bench)
    assert {(r.doc_id, r.item_id, r.n_shingles, r.n_found) for r in decontam.contaminated(d, b, broadcast_rows=0).collect()} == got
    bad = {(x, t) for x, t in docs for y, *_ in got if x == y and any((x, i) in {(g[0], g[1]) for g in got} for i, s in bench
                                                                    if grams(s) and len(grams(s) & grams(t)) >= math.ceil(.8 * len(grams(s)) - 1e-9))}
    kept = decontam.keep_clean(d, b)
    assert kept.columns == d.columns
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=key) == sorted(((x, t) for x, t in docs if (x, t) not in bad), key=key)
    assert decontam.contaminated(d.limit(0), b).count() == 0 and decontam.contaminated(d, b.limit(0)).count() == 0
    assert decontam.keep_clean(d, b.limit(0)).count() == len(docs)


def test_no_python_in_the_plan(spark):
    d, b = common.read(spark, SF, "documents"), common.read(spark, SF, "benchmark")
    plan = decontam.contaminated(d, b)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
