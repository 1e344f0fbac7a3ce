"""WARC archives: exact round trip, revisits, validation of damaged records."""

import hashlib

import pytest
import zstandard

from ledgerlake.llm import common, queries, warc

SF = "/root/testdata/sf0.001"


def brute(rows):
    bodies = [(i, (h or "").encode()) for i, h in rows]
    first = {}
    for i, b in bodies:
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    return sorted((str(i), len(b), hashlib.sha256(b).hexdigest(), *(("revisit", first[b]) if i is not None and first.get(b, i) < i else ("response", None)))
                  for i, b in bodies)


def test_query_equals_brute_force(spark):
    rows = [(r.page_id, r.html) for r in common.read(spark, SF, "pages").collect()]
    got = [(str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in queries.op1_warc(spark, SF).collect()]
    assert sorted(got) == brute(rows)


def test_round_trip_and_odd_rows(spark):
    big = "long é " * 60000
    rows = [(5, "http://x/ y\r\nX: 1", big), (2, None, big), (9, "u", "short"), (1, "u", "short"), (7, "u", None), (8, "u", ""),
            (None, "u", big), (None, "u", "z" * 100), (4, "u", "q" * 100), (4, "u", "q" * 100), (6, "u", "q" * 100), (3, "u", "q" * 99), (10, "u", "q" * 99)]
    df = spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, payload int")
    typed = warc.with_record_types(df, "page_id", "html", "url")
    read = warc.read_archives(warc.archives(typed, archive_bytes=1000)).collect()
    assert sorted((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in read) == brute([(a, c) for a, b, c in rows])
    kept = {r.payload_digest: r.payload for r in read if r.record_type == "response"}
    for r in read:
        assert r.error is None and hashlib.sha256(kept[r.payload_digest]).hexdigest() == r.payload_digest
        assert r.target_uri is None or "\r" not in r.target_uri
    assert len({r.path for r in read}) == len({r.path for r in warc.archives(typed, archive_bytes=1000).collect()}) > 1
    assert warc.read_archives(warc.archives(warc.with_record_types(df.limit(0), "page_id", "html", "url"))).count() == 0


def records(n=400):
    body = lambda i: f"<html><head><title>page {i}</title></head>{'word ' * (i % 50)}</html>".encode()
    return [warc.build_record(i, f"http://x/{i}", body(i), hashlib.sha256(body(i)).hexdigest(), None, "2024-01-01T00:00:00Z") for i in range(n)]


def test_dictionary_frame_and_single_frames():
    made = warc.build_archive(records(), dictionary_bytes=1024)
    assert int.from_bytes(made[:4], "little") == warc.DICTIONARY_FRAME
    dictionary, at = warc.split_dictionary(made)
    assert at > 8 and list(warc.frames(made)) == records()
    # each record is a frame of its own, readable with the dictionary alone
    one = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompressobj()
    assert one.decompress(made[at:]) == records()[0] and one.unused_data
    # a plain (uncompressed) dictionary and none at all
    plain = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary + made[at:]
    assert list(warc.frames(plain)) == records()
    few = warc.build_archive(records(3))
    assert warc.split_dictionary(few) == (None, 0) and list(warc.frames(few)) == records(3)
    assert list(warc.frames(b"")) == []
    for broken in (made[:-3], plain[:20]):
        with pytest.raises(ValueError):
            list(warc.frames(broken))


def test_damaged_records_are_refused(spark):
    good = records(1)[0]
    body = good.index(b"<html>")
    bad = {
        "version": good.replace(b"WARC/1.1", b"WARC/9.9", 1),
        "missing": good.replace(b"WARC-Date: 2024-01-01T00:00:00Z\r\n", b"", 1),
        "repeated": good.replace(b"WARC-Type: response\r\n", b"WARC-Type: response\r\nWARC-Type: response\r\n", 1),
        "header line": good.replace(b"WARC-Type: response", b"WARC-Type response", 1),
        "content-length": good[:-6] + good[-4:],
        "whole number": good.replace(b"\r\nContent-Length: ", b"\r\nContent-Length: x", 1),
        "digest": good[:body] + b"<HTML>" + good[body + 6:],
        "no end of headers": b"WARC/1.1\r\n",
        "record type": good.replace(b"WARC-Type: response", b"WARC-Type: whatever", 1),
    }
    assert warc.parse_record(good)["page_id"] == 0
    for what, raw in bad.items():
        with pytest.raises(ValueError):
            warc.parse_record(raw)
    df = spark.createDataFrame([("a", bytearray(warc.build_archive([good, *bad.values(), good])))], warc.ARCHIVE_SCHEMA)
    read = warc.read_archives(df, strict=False).collect()
    assert [r.error is None for r in read] == [True, *[False] * len(bad), True]
    with pytest.raises(Exception, match="bad version line|version"):
        warc.read_archives(df).collect()
