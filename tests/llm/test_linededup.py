"""Line dedup against a word-by-word walk, and planted passages."""

import random
import re

import numpy as np
import pytest

from ledgerlake.llm import common, linededup, queries

SF = "/root/testdata/sf0.001"
LINE, WINDOW, MIN = 26, 25, 50


def hashes_of(text):
    data = text.encode()
    starts, ends = linededup.words_of(data)
    if len(starts) < LINE:
        return np.empty(0, np.uint64)
    return linededup.line_hashes(data, starts, ends, LINE, linededup.Powers(linededup.BYTE_BASE), linededup.Powers(linededup.WORD_BASE))


def winnow(h):
    """Window by window: keep the last pick while it is in the window and smallest, else the last smallest."""
    out, now = [], None
    for i in range(len(h) - WINDOW + 1):
        least = min(h[i:i + WINDOW])
        if now is None or now < i or h[now] != least:
            now = max(j for j in range(i, i + WINDOW) if h[j] == least)
            out.append(now)
    return out


def brute(rows):
    """{(id, text): (clean text, spans)} by the rule in the module's docstring, comparing words only."""
    texts = sorted({(2**63 - 1 if d is None else d, t) for d, t in rows if t is not None})
    words, picks, first = {}, {}, {}
    for name in texts:
        words[name] = re.findall(r"[^\x20\x09-\x0D]+", name[1])
        h = hashes_of(name[1]).tolist()
        picks[name] = winnow(h)
        assert len(set(h)) == len({tuple(words[name][i:i + LINE]) for i in range(len(h))})
    # only the order of equal ids depends on the text hash; the tests use distinct ids
    for name in texts:
        for p in picks[name]:
            first.setdefault(tuple(words[name][p:p + LINE]), (name, p))
    out = {}
    for name in texts:
        w, gone, matches = words[name], set(), {}
        for p in picks[name]:
            src, q = first[tuple(w[p:p + LINE])]
            if (src, q) == (name, p) or (src == name and p - q < MIN):
                continue
            matches.setdefault((src, p - q), []).append(p)
        for (src, shift), ps in matches.items():
            v, groups = words[src], []
            for p in ps:
                if groups and p <= groups[-1][1]:
                    groups[-1][1] = p + LINE
                else:
                    groups.append([p, p + LINE])
            for a, z in groups:
                reach = LINE + WINDOW - 1
                a0, z0 = a, z
                while a > 0 and a - shift > 0 and a0 - a < reach and w[a - 1] == v[a - 1 - shift]:
                    a -= 1
                while z < len(w) and z - shift < len(v) and z - z0 < reach and w[z] == v[z - shift]:
                    z += 1
                if z - a >= MIN:
                    gone.update(range(a, z))
        places = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", name[1])]
        text, spans, i, at = "", [], 0, 0
        while i < len(w):
            if i in gone:
                j = i
                while j in gone:
                    j += 1
                spans.append(f"{places[i][0]}:{places[j - 1][1]}")
                text += name[1][at:places[i][0]]
                at = places[j][0] if j < len(w) else len(name[1])
                i = j
            else:
                i += 1
        out[name] = (text + name[1][at:], ",".join(spans))
    return out


def compare(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = [(r.doc_id, r.old, r.text, r.removed) for r in linededup.dedup(
        df.withColumn("old", df.text), "doc_id", "text", spans_col="removed").collect()]
    want = brute(rows)
    assert len(got) == len(rows)
    for d, old, new, spans in got:
        if old is None:
            assert new is None and spans == ""
        else:
            assert (new, spans) == want[2**63 - 1 if d is None else d, old], d
    return got


def prose(rng, n, vocabulary=5000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def test_query_equals_the_walk(spark):
    rows = [(r.doc_id, r.text) for r in common.read(spark, SF, "documents").collect()]
    compare(spark, rows)
    assert queries.op10_linededup(spark, SF).count() == len(rows)


def test_planted_passages_go_and_clean_texts_stay(spark):
    rng = random.Random(4)
    passage, short, rows = prose(rng, 51), prose(rng, 40), []
    for i in range(40):
        own = prose(rng, rng.randrange(0, 300))
        at = rng.randrange(len(own) + 1)
        inner = passage if i % 3 == 0 else short if i % 3 == 1 else []
        rows.append((i, "\n".join(" ".join(x) for x in (own[:at], inner + own[at:])).strip()))
    got = {d: (new, spans) for d, old, new, spans in compare(spark, rows)}
    for d, old in rows:
        if d % 3 or d == 0:
            assert got[d] == (old, "")
        else:
            assert not set(passage) - set(got[0][0].split()) and " ".join(passage[5:40]) not in got[d][0] and got[d][1]


def test_edge_cases(spark):
    rng = random.Random(9)
    long = " ".join(prose(rng, 30000, 100000))
    junk = "the " * 3000
    rows = [(1, None), (2, ""), (3, "one"), (4, long), (5, long + " tail"), (6, junk), (7, "x " + junk),
            (8, " \t\n"), (9, long), (9, long), (None, long[:5000]), (10, "é ü " * 400)]
    got = compare(spark, rows)
    by = {d: new for d, old, new, _ in got if d is not None}
    assert by[4] == long and by[5] == "tail" and by[9] == "" and len(by[6].split()) < 110
    df = spark.createDataFrame([(1, "a", 2, "b")], "doc_id long, text string, `__x` int, pos string")
    assert linededup.dedup(df, "doc_id", "text").columns == df.columns
    assert linededup.dedup(df.limit(0), "doc_id", "text").count() == 0


def test_window_guarantee():
    rng = np.random.default_rng(3)
    for _ in range(50):
        h = rng.integers(0, 5, 200).astype(np.uint64)
        at = linededup.selected(h, 25)
        assert np.diff(at).max() <= 25 and at[0] < 25 and at[-1] >= 175
        assert at.tolist() == winnow(h.tolist())


def test_parameters_that_lose_runs_are_refused(spark):
    with pytest.raises(ValueError):
        linededup.dedup(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "doc_id", "text", line=30, window=25)


def every_window(rows):
    """{doc: words left} if a word goes when some window of MIN words around it occurred before."""
    first, out = {}, {}
    for d, t in sorted(rows):
        w, gone = t.split(), set()
        for p in range(len(w) - MIN + 1):
            src, q = first.setdefault(tuple(w[p:p + MIN]), (d, p))
            if src != d or p - q >= MIN:
                gone.update(range(p, p + MIN))
        out[d] = [x for i, x in enumerate(w) if i not in gone]
    return out


def test_runs_whose_lines_were_first_seen_elsewhere_go(spark):
    rng = random.Random(21)
    run = prose(rng, 160)
    rows = [(i, prose(rng, 20) + run[at:at + 40] + prose(rng, 20)) for i, at in enumerate(range(0, 160, 9))]  # pieces only
    rows += [(100, prose(rng, 60) + run + prose(rng, 60)), (101, prose(rng, 30) + run + prose(rng, 30)),      # whole, twice
             (102, prose(rng, 30) + run[30:90] + prose(rng, 9)),
             (103, run[:45] + prose(rng, 60) + run[:70] + prose(rng, 5) + run[20:75])]
    pool = [prose(rng, rng.randrange(20, 140), 30) for _ in range(25)]
    for i in range(200, 320):
        parts = [rng.choice(pool) for _ in range(rng.randrange(1, 5))]
        rows.append((i, [x for part in parts for x in part[rng.randrange(20):len(part) - rng.randrange(10)]]))
    rows = [(d, " ".join(w)) for d, w in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = {r.doc_id: r.text.split() for r in linededup.dedup(df, "doc_id", "text").collect()}
    want = every_window(rows)
    assert got == want
    old = brute(rows)
    assert sum(len(old[x][0].split()) > len(want[x[0]]) for x in old) > 3 and len(want[101]) == 60
