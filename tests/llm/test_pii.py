"""Personal data against plain regular expressions, and bootstrapping on planted contexts."""

import hashlib
import random
import re

from ledgerlake.llm import common, pii, queries

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(p) <= 255 for p in m.split("."))
    if kind == "card":
        return 14 <= len(d) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0
    return kind != "phone" or 10 <= len(d) <= 15


def brute(text):
    spans = [(m.start(), i, m.end(), k) for i, (k, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if passes(k, m.group())]
    return [f"{k}:{a}:{z}" for a, _, z, k in sorted(spans)]


def check(row, text):
    want = brute(text)
    assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s.startswith(k) for s in want) for k in pii.KINDS]
    assert set(want) <= set(row.spans.split(",")) or not want
    return ",".join(want)


def test_query_equals_plain_patterns(spark):
    texts = {r.doc_id: r.text for r in common.read(spark, SF, "documents").collect()}
    rows = queries.op4_pii(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        assert r.base_sha256 == hashlib.sha256(check(r, texts[r.doc_id]).encode()).hexdigest()
    assert sum(r.n_email for r in rows) and sum(r.n_card for r in rows)


def test_patterns_on_random_strings(spark):
    rng = random.Random(11)
    parts = ["a", "B7", "@", ".", "-", "_", "%", "+", "1", "25", "256", "0", " ", "(", ")", "x.y", "é", "😀", "\n",
             "4111 1111 1111 1111", "4539578763621486", "+1 (269) 555-3296", "1.2.3.4", "me@x.org"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(1500)]
    texts += [None, "", "1" * 30000, "1 " * 20000, "a" * 30000, "a@" * 5000, "+1" + " (" * 20000, "a.b@c.d-e@f.g_h@i.j"]
    df = spark.createDataFrame([(i, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, kind string")
    rows = pii.find(df, rounds=1).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert r.base == check(r, texts[r.doc_id]), texts[r.doc_id]


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    docs = []
    for i in range(12):
        card = "4539578763621486" if i == 0 else None
        docs.append((i, f"{word()} {word()} reach me on +1 (269) 555-{1000 + i} {word()} then mail user{i}@example.com"))
    docs.append((50, f"{word()} reach me on 555-8842, {word()}"))          # no plus sign: unseen
    docs.append((51, f"{word()} {word()} 555-8843 {word()}"))              # no context: stays
    docs.append((52, f"{word()} reach me on Friday or in room 12"))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.find(df).collect()}
    at = docs[12][1].index("555-8842")
    assert got[50].spans == f"phone:{at}:{at + 8}" and got[50].base == "" and got[50].n_phone == 0
    assert got[51].spans == "" and got[52].spans == ""
    assert all(got[i].spans == got[i].base for i in range(12))


def test_edge_cases(spark):
    rows = [(None, "x me@x.org"), (3, "y me@x.org"), (3, "y me@x.org"), (3, "z 1.2.3.4"), (4, None)]
    df = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, start int")
    got = sorted((str(r.doc_id), r.spans) for r in pii.find(df).collect())
    assert got == [("3", "email:2:10"), ("3", "email:2:10"), ("3", "ip:2:9"), ("4", ""), ("None", "email:2:10")]
    assert pii.find(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pii.find(common.read(spark, SF, "documents"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)


def test_contexts_cross_neighbouring_units(spark):
    far = "z" * 150
    text = f"the ids: 111222333, 444555666, 777888999 end\nline 2 id 44556677 {far} x {far} 99887766 {far}"
    found = pii.matches(pii._named(spark.createDataFrame([(1, text)], "doc_id long, text string"), "doc_id", "text"))
    got = {r.unit: r.patterns for r in pii.units(found, pii.base_entities(found)).collect()}
    assert got == {
        "111222333": ["2:the ids:", "1:ids: _ <id>"], "444555666": ["2:ids: <id>", "1:<id> _ <id>"],
        "777888999": ["2:<id> <id>", "1:<id> _ end"], "2": ["2:end line", "1:line _ id"],
        "44556677": ["2:<id> id", f"1:id _ {far}"], "99887766": [f"2:x {far}", f"1:{far} _ {far}"]}
