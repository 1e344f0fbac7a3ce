"""Packing: same ids as the tokenizer, gapless sequences, fullest combinations."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerlake.llm import common, packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


def brute_pieces(tokenizer, rows, size=1024):
    out = []
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        n = -(-len(ids) // size)
        starts = [0] + [len(ids) - size * k for k in range(n - 1, 0, -1)]
        for k, (a, b) in enumerate(zip(starts, starts[1:] + [len(ids)])):
            out.append((doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check_bins(rows, size=1024):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(bins)


def test_query_equals_the_tokenizer(spark):
    docs = [(r.doc_id, r.text) for r in common.read(spark, SF, "documents").collect()]
    got = queries.op9_packing(spark, SF).collect()
    want = brute_pieces(Tokenizer.from_file(PATH), docs)
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    least = -(-sum(w[3] for w in want) // 1024)
    assert least <= check_bins(got) <= least * 1.03 + 1


def test_encoders_agree():
    encoder, plain = packing.Encoder(open(PATH).read()), Tokenizer.from_file(PATH)
    assert encoder.fast is not None
    rng = random.Random(5)
    letters = [chr(c) for c in (9, 10, 13, *range(32, 127), *range(0xA1, 0x250))]
    odd = ["\x85", "\x1c", " ", "中", "᠎", "é", "🙂", "<|endoftext|>", "'ll", "  ", "\n "]
    for i in range(4000):
        text = "".join(rng.choice(letters if rng.random() < .8 or i % 2 else odd) for _ in range(rng.randrange(40)))
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "word " * 5000), (4, "中文 text"), (4, "中文 text"), (None, "no id")]
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, piece int, length int")
    got = packing.pack_documents(df, "doc_id", "text", PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=key) == \
        sorted(brute_pieces(Tokenizer.from_file(PATH), rows), key=key)
    check_bins(got)
    assert packing.pack_documents(df.limit(0), "doc_id", "text", PATH).count() == 0


def test_slices_of_a_hot_length(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "0 AS piece", "0L AS start",
                                      "CASE WHEN id % 3 = 0 THEN 512L ELSE id % 90 + 1 END AS length", "id AS ids_crc32")
    got = packing.pack(df, slice_rows=100).collect()
    assert len(got) == 3000
    assert check_bins(got) == -(-sum(r.length for r in got) // 1024)


def test_fullest_is_the_best_combination():
    rng = random.Random(6)
    for _ in range(300):
        counts = {rng.randrange(1, 40): rng.randrange(1, 4) for _ in range(rng.randrange(0, 5))}
        room = rng.randrange(0, 70)
        chosen = packing.fullest(counts, room)
        assert all(c <= counts[n] for n, c in chosen.items())
        best = max(s for ks in itertools.product(*(range(c + 1) for c in counts.values()))
                   if (s := sum(k * n for k, n in zip(ks, counts))) <= room)
        assert sum(n * c for n, c in chosen.items()) == best


def test_bin_table_uses_every_piece():
    rng = random.Random(7)
    counts = {rng.randrange(1, 1025): rng.randrange(1, 500) for _ in range(200)}
    table = packing.bin_table(counts, 1024)
    for n, c in counts.items():
        ranges = sorted((t[1], t[2]) for t in table if t[0] == n)
        assert ranges[0][0] == 0 and ranges[-1][1] == c
        assert all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))


def test_too_long_pieces_are_refused(spark):
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 0, 2000, 0)], packing.PIECES), 1024)


@pytest.mark.parametrize("text", [" " * 2_000_000, "\n" * 2_000_000, "a" + " \n" * 600_000 + "b", "ab" * 300_000,
                                  "x " * (packing.UNBROKEN // 2 + 5), " " * (packing.UNBROKEN - 1), " " * packing.UNBROKEN,
                                  "w" * (packing.UNBROKEN - 1) + " w"], ids=lambda t: f"{t[:3]!r}{len(t)}")
def test_long_unbroken_runs(text):
    encoder, plain = packing.Encoder(open(PATH).read()), Tokenizer.from_file(PATH)
    want = np.array(plain.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
    assert encoder.encode(text) == want
