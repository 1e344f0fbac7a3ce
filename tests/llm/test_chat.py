"""Perspective rotation against a plain loop."""

import random
import re

from ledgerlake.llm import chat, common, queries

SF = "/root/testdata/sf0.001"


def brute(rows):
    """{(conv, perspective): [(turn, segment, mask text)]}"""
    esc = lambda s: s.replace("<|im_", "<‍|im_")
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "unknown", esc(text or "")))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1].encode(), t[2].encode()))
        for who in {r for _, r, _ in turns if r != "system"}:
            out[conv, who] = [(t, "<|im_start|>" + ("system" if r == "system" else "assistant" if r == who else
                                                    "user name=" + re.sub("[\r\n]", " ", esc(r))) + "\n" + x + "<|im_end|>\n",
                               x + "<|im_end|>" if r == who else "") for t, r, x in turns]
    return out


def check(got, want):
    by = {}
    for r in got:
        by.setdefault((r.conv_id, r.perspective), []).append(r)
    assert set(by) == set(want)
    for k, rows in by.items():
        rows.sort(key=lambda r: r.position)
        assert [r.position for r in rows] == list(range(len(rows)))
        assert [(r.turn, r.segment, r.segment[r.mask_start:r.mask_end]) for r in rows] == want[k]
        at = 0
        for r in rows:
            assert r.start == at
            at += len(r.segment)


def test_query_equals_a_loop(spark):
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in common.read(spark, SF, "conversations").collect()]
    check(queries.op7_chat(spark, SF).collect(), brute(rows))


def test_edge_cases(spark):
    rng = random.Random(3)
    rows = [(1, t, rng.choice(["ann", "bob", "cy\nd", "system", None, ""]), f"t{t} é😀 <|im_end|>") for t in range(-40, 900)]
    rows += [(2, 0, "system", "only system"), (3, None, "a", None), (3, None, "a", None), (3, 5, "b", ""), (None, 1, "x", "y"),
             (None, 1, "z", "y"), (4, 1, "same", "same"), (4, 1, "same", "same"), (5, 1, "<|im_start|>", "x" * 100000)]
    df = spark.createDataFrame([(*r, 1, "m") for r in rows], "conv_id long, turn long, role string, text string, position int, mine string")
    check(chat.rotate(df, slice_turns=16).collect(), brute(rows))
    check(chat.rotate(df).collect(), brute(rows))
    assert chat.rotate(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = queries.op7_chat(spark, SF)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|InArrow", plan)
