"""Best-fit packing of tokenised documents by minimum bin slack.

A document becomes its token ids plus one end id.  Documents of at most ``size`` tokens are one
piece; longer ones are cut into pieces of ``size`` tokens, of which the first may be shorter.

Minimum bin slack works on the number of pieces of each length, at most ``size`` numbers whatever
the corpus: a bin starts with the longest length left, a bitset subset-sum dynamic program over
the lengths still available finds the fullest combination that fits beside it, and as many bins
of that combination as the counts allow are closed at once.  The resulting table says, for each
length, which ranks go to which sequence and offset.  Pieces are ranked within their length in
slices of bounded size (a length may hold a third of all rows), so no task holds a whole length.

Defined cases: a null or empty text is the end id alone (one piece of length 1); repeated rows
are packed once each; rows without an id are packed like others; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import cut, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# ---------------------------------------------------------------- tokens

#: Fixed value: how byte-level BPE splits a text before its merges.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters on which both libraries agree about letters, numbers and white space.
PLAIN = re.compile(r"[\t\n\r -~\u00a1-\u024f]*")
#: The rank encoder's splitting fails on white space of a million characters; words this long also go to the other.
UNBROKEN = 20_000
LONG_RUN = re.compile(r"\s{%d}|\S{%d}" % (UNBROKEN, UNBROKEN))


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level BPE writes for each byte: itself if printable, else from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(others)}


class Encoder:
    """Ids of whole texts by a tokenizer definition, as little-endian 32-bit values.

    If the definition is byte-level BPE whose merges are numbered in order, texts of PLAIN
    characters without very long runs of white space or of anything else go through the faster
    rank encoder built from that same definition, which gives the same ids (tests compare the
    two); every other text goes through ``tokenizers`` itself.
    """

    def __init__(self, definition: str):
        self.tokenizer = Tokenizer.from_str(definition)
        self.fast = self._fast(json.loads(definition))

    @staticmethod
    def _fast(d: dict):
        model, before = d["model"], d.get("pre_tokenizer") or {}
        if (model.get("type") != "BPE" or d.get("normalizer") or model.get("dropout")
                or model.get("ignore_merges") or before.get("type") != "ByteLevel"
                or before.get("add_prefix_space") or not before.get("use_regex", True)
                or any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in d["added_tokens"])):
            return None
        special, byte = {t["content"]: t["id"] for t in d["added_tokens"]}, byte_alphabet()
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
        if merged != sorted(merged) or not all(c in model["vocab"] for c in byte):
            return None
        ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items() if token not in special}
        return tiktoken.Encoding("definition", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)

    def encode(self, text: str) -> bytes:
        if self.fast is not None and PLAIN.fullmatch(text) and (len(text) < UNBROKEN or not LONG_RUN.search(text)):
            ids = self.fast.encode_to_numpy(text, allowed_special="all")
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, "<u4").tobytes()


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, size: int = 1024,
           end_id: int = 2) -> DataFrame:
    """PIECES rows of every document."""
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = Encoder(definition.value)
        for b in batches:
            rows = ([], [], [], [], [])
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = encoder.encode(text.as_py()) + end
                total = len(ids) // 4
                first = (total - 1) % size + 1
                for n, stop in enumerate(range(first, total + 1, size)):
                    start = stop - (size if n else first)
                    for column, value in zip(rows, (doc_id, n, start, stop - start,
                                                    zlib.crc32(ids[4 * start:4 * stop]))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text")) \
        .mapInArrow(run, PIECES)


# ---------------------------------------------------------------- minimum bin slack

def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The combination of available lengths (length -> copies) with the largest sum up to room.

    Bitset subset-sum: bit s of ``reach`` says that the sum s can be made.  Copies of a length are
    taken in powers of two; the search ends as soon as the room can be filled exactly.
    """
    mask, reach, steps = (2 << room) - 1, 1, []
    for length in sorted((n for n, c in counts.items() if c and n <= room), reverse=True):
        left, batch = min(counts[length], room // length), 1
        while left:
            take = min(batch, left)
            steps.append((length, take, reach))
            reach |= reach << length * take & mask
            left, batch = left - take, batch * 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def bin_table(counts: dict[int, int], size: int) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, end rank, first sequence, copies a sequence, first offset) for all pieces."""
    left = {n: c for n, c in counts.items() if c > 0}
    used, out, sequence = dict.fromkeys(left, 0), [], 0
    while left:
        longest = max(left)
        left[longest] -= 1
        combination = fullest(left, size - longest)
        left[longest] += 1
        combination[longest] = combination.get(longest, 0) + 1
        times = min(left[n] // c for n, c in combination.items())
        offset = 0
        for n in sorted(combination, reverse=True):
            c = combination[n]
            out.append((n, used[n], used[n] + c * times, sequence, c, offset))
            used[n] += c * times
            left[n] -= c * times
            offset += n * c
            if not left[n]:
                del left[n]
        sequence += times
    return out


def pack(found: DataFrame, size: int = 1024, slice_rows: int = 100_000) -> DataFrame:
    """PIECES rows with sequence_id and offset; sequences are gapless from offset 0."""
    found = cut(found)
    histogram = {r["length"]: r["n"] for r in found.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    if any(n > size or n < 1 for n in histogram):
        raise ValueError(f"a piece is longer than {size} tokens or empty")
    table = np.array(sorted(bin_table(histogram, size)), np.int64).reshape(-1, 6)
    lengths, firsts, _, sequences, copies, offsets = table.T
    slices = -(-max(histogram.values(), default=1) // slice_rows)

    cells = found.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    before = (cells.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n"))
              .withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("slice")) - F.col("n"))
              .select("length", "slice", "before"))
    place = Window.partitionBy("length", "slice").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (cells.withColumn("nth", F.row_number().over(place).cast("long"))
              .join(before, ["length", "slice"])
              .select(*found.columns, (F.col("before") + F.col("nth") - 1).alias("rank")))

    # all entries of one length are contiguous and ordered by first rank
    starts = {int(n): int(i) for n, i in zip(*np.unique(lengths, return_index=True))}
    ends = {n: i + int(np.sum(lengths == n)) for n, i in starts.items()}

    def run(batches):
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            at = np.empty(len(rank), np.int64)
            for n in np.unique(length):
                rows, lo, hi = length == n, starts[int(n)], ends[int(n)]
                at[rows] = lo + np.searchsorted(firsts[lo:hi], rank[rows], "right") - 1
            nth = rank - firsts[at]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in found_columns]
                + [pa.array(sequences[at] + nth // copies[at]), pa.array(offsets[at] + nth % copies[at] * length)],
                [*found_columns, "sequence_id", "offset"])

    found_columns = found.columns
    return ranked.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, id_col: str, text_col: str, tokenizer_path: str, size: int = 1024,
                   end_id: int = 2) -> DataFrame:
    return pack(pieces(docs, id_col, text_col, tokenizer_path, size, end_id), size)
