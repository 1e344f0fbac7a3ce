"""Temporal list join against a day-by-day replay of the list."""

import datetime
import random
import re

from ledgerlake.llm import queries, urlfilter

DAY = datetime.date(2024, 1, 1)


def patterns(url):
    url = (url or "").lower()
    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([a-z0-9._-]*[a-z0-9_-])", url)
    if not m:
        return None, []
    host, labels = m[1], m[1].split(".")
    path = re.match(r"[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)?", url)[1] or ""
    dirs = path.split("/")[1:-1][:4]
    return host, [".".join(labels[i:]) for i in range(max(1, len(labels) - 1))] + \
        [host + "/" + "/".join(dirs[:i]) + "/" for i in range(1, len(dirs) + 1)]


def brute(captures, entries):
    out = []
    for i, url, day in captures:
        host, found = patterns(url)
        best = None
        for p in found if day else []:
            log = sorted((d, s, a, c) for q, a, c, d, s in set(entries) if q is not None and d is not None and a is not None and q.lower() == p and d <= day)
            by_day = {d: (a, c) for d, s, a, c in log}
            days = sorted(by_day)
            if days and by_day[days[-1]][0] != "remove":
                since = days[-1]
                while days.index(since) and by_day[days[days.index(since) - 1]] == by_day[since]:
                    since = days[days.index(since) - 1]
                best = max(best or (0,), (len(p), p, *by_day[since], since))
        out.append((i, host, day, best[2] if best else "allow", *((best[1], best[3], best[4]) if best else (None,) * 3)))
    return sorted(out, key=str)


def test_replay(spark):
    rng = random.Random(2)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.y.z.org", "localhost", "1.2.3.4"]
    dirs = ["", "/", "/p/", "/p/q/r.html", "/p/q/r/s/t/u", "/P/Q/"]
    caps = [(i, f"{rng.choice(['http', 'HTTPS'])}://{rng.choice(['', 'me@'])}{rng.choice(hosts)}{rng.choice(['', ':80'])}{rng.choice(dirs)}{rng.choice(['', '?q=/x/'])}",
             DAY + datetime.timedelta(days=rng.randrange(300))) for i in range(400)]
    caps += [(900, None, DAY), (901, "not a url", DAY), (902, "http:///x", DAY), (903, "http://example.com/", None), (None, "http://example.com/", DAY),
             (5, caps[5][1], caps[5][2])]
    pats = ["example.com", "A.example.com", "z.org", "x.y.z.org", "localhost", "a.example.com/p/", "b.example.com/p/q/", "a.example.com/P/", "3.4"]
    ents = [(rng.choice(pats), rng.choice(["block", "allow", "remove"]), rng.choice(["c1", "c2"]), DAY + datetime.timedelta(days=rng.randrange(-50, 300)), s) for s in range(300)]
    ents += [ents[0], (None, "block", "c1", DAY, 999), ("example.com", "block", "c1", None, 998), ("example.com", None, "c", DAY, 997)]
    c = spark.createDataFrame([(*x, "z", 1) for x in caps], "page_id long, url string, fetch_day date, pattern string, bucket int")
    e = spark.createDataFrame([(*x, "z") for x in ents], "pattern string, action string, category string, day date, seq long, host string")
    want = brute(caps, ents)
    for width in (7, 32):
        got = sorted(map(tuple, urlfilter.judge(c, e, "page_id", "url", "fetch_day", bucket_days=width).collect()), key=str)
        assert got == want
    assert urlfilter.judge(c.limit(0), e, "page_id", "url", "fetch_day").count() == 0
    none = urlfilter.judge(c, e.limit(0), "page_id", "url", "fetch_day").collect()
    assert len(none) == len(caps) and {r.action for r in none} == {"allow"}


def test_query(spark):
    rows = queries.op2_urlfilter(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 250 and {"block", "allow"} <= {r.action for r in rows}


def test_deep_entries_match(spark):
    deep = "a.example.com/1/2/3/4/5/6/"
    c = spark.createDataFrame([(1, f"http://{deep}x", DAY), (2, "http://a.example.com/1/2/3/4/5/x", DAY), (3, "http://a.example.com", DAY)],
                              "page_id long, url string, fetch_day date")
    e = spark.createDataFrame([(deep, "block", "c", DAY, 1)], "pattern string, action string, category string, day date, seq long")
    got = {r.page_id: (r.action, r.pattern) for r in urlfilter.judge(c, e, "page_id", "url", "fetch_day").collect()}
    assert got == {1: ("block", deep), 2: ("allow", None), 3: ("allow", None)}
