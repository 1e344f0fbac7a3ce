"""SimHash near-duplicates by multi-index hashing.

Fingerprint: A-Z lower-cased, words are runs of non-white-space (space, U+0009 to U+000D),
shingles of ``shingle`` words joined by a space (all of the words if there are fewer), hashed
with XXH64 over UTF-8; a bit is 1 if it is set in over half the hashes.  No words: zero.

Links: two fingerprints that differ in at most ``max_bits`` bits.  The 64 bits are cut into
``segments``; by the pigeonhole principle two linked fingerprints differ in at most
``max_bits // segments`` bits of some segment.  Each distinct fingerprint enters one table per
segment, looks up the whole Hamming ball of that radius around its own segment value, and the
complete distance of every match is verified.  Copies share a fingerprint and enter once.

Defined cases: a null text is empty; all empty texts have fingerprint zero and are linked like
any other; rows are the nodes, so repeated rows and rows without an id have the component of
their fingerprint; component_id is the smallest non-null id (null if no row has one); an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, free_names, text_or_empty
from .components import connected_components

BLOCK = 1 << 15


def simhash(text: bytes, shingle: int = 3, seed: int = 42) -> int:
    """The unsigned 64-bit fingerprint of a UTF-8 text, in blocks of bounded size."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, BLOCK):
        part = words[at:at + BLOCK + shingle - 1]
        grams = zip(*(part[i:] for i in range(shingle))) if len(words) >= shingle else [words]
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, grams), repeat(seed)), np.uint64)
        ones += np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fp) per row; fp is the fingerprint as a signed long, text_key a hash of the text."""

    def run(batches):
        for b in batches:
            fps = [simhash(t.as_py(), shingle, seed) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(np.array(fps, np.uint64).view(np.int64))],
                ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, text_key long, fp long")


def _segments(fp: Column, segments: int) -> list[tuple[Column, int]]:
    """The value of each segment of a 64-bit column, and its width."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [(F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1)), hi - lo)
            for lo, hi in zip(edges, edges[1:])]


def links(fps: DataFrame, max_bits: int = 3, segments: int = 2) -> DataFrame:
    """(u, v), u < v: all pairs of distinct fingerprints that differ in at most max_bits bits."""
    radius = max_bits // segments
    fp = F.col("fp")

    def entries(ball: int) -> Column:
        """The keys of every value within the ball around each segment's value."""
        return F.array(*(value.bitwiseXOR(F.lit(sum(1 << b for b in bits))) * segments + i
                         for i, (value, width) in enumerate(_segments(fp, segments))
                         for d in range(ball + 1) for bits in combinations(range(width), d)))

    distinct = fps.select("fp").distinct()
    table = distinct.select(F.explode(entries(0)).alias("key"), fp.alias("v"))
    probes = distinct.select(F.explode(entries(radius)).alias("key"), fp.alias("u"))
    differ = F.col("u").bitwiseXOR(F.col("v"))
    near = F.bit_count(differ) <= max_bits
    # a pair is emitted only by the first segment in which it is this near
    seen = F.lit(False)
    once = F.lit(False)
    for i, (value, _) in enumerate(_segments(differ, segments)):
        close = F.bit_count(value) <= radius
        once = once | ((F.pmod(F.col("key"), F.lit(segments)) == i) & close & ~seen)
        seen = seen | close
    # merged, whatever Spark makes of their size: it takes a table of one row a ball for no larger than before explode
    return (table.hint("merge").join(probes.hint("merge"), "key")
            .filter((F.col("u") < F.col("v")) & near & once).select("u", "v"))


def near_duplicates(docs: DataFrame, id_col: str, text_col: str, shingle: int = 3, max_bits: int = 3,
                    segments: int = 2, seed: int = 42) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id) per row of docs."""
    fps = cut(fingerprints(docs, id_col, text_col, shingle, seed))
    least = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = connected_components(links(fps, max_bits, segments)).withColumnRenamed("node", "fp")
    classes = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    classes = cut(classes)
    firsts = classes.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = classes.join(firsts, "root").select("fp", "component_id")
    return fps.join(of_fp, "fp").select(
        "doc_id", "text_key", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str, text_col: str, **how) -> DataFrame:
    """docs with one row of each group: the one with the smallest id (of equal ids the smallest
    text hash, of equal rows any).  Rows without an id cannot be named, so they all stay."""
    found = near_duplicates(docs, id_col, text_col, **how).filter("doc_id IS NOT NULL")
    keeper = found.groupBy("component_id").agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.*")
    id_, key, gone_, nth_ = free_names(docs, "id", "key", "gone", "nth")
    gone = (found.select("doc_id", "text_key").distinct().join(keeper, ["doc_id", "text_key"], "left_anti")
            .select(F.col("doc_id").alias(id_), F.col("text_key").alias(key), F.lit(True).alias(gone_)))
    rows = docs.withColumns({id_: F.col(f"`{id_col}`").cast("long"),
                             key: F.xxhash64(text_or_empty(F.col(f"`{text_col}`")))})
    left = rows.join(gone, [id_, key], "left").filter(F.col(gone_).isNull())
    nth = F.row_number().over(Window.partitionBy(id_, key).orderBy(id_))
    return (left.withColumn(nth_, nth).filter((F.col(nth_) == 1) | F.col(id_).isNull())
            .select(*(F.col(f"`{c}`") for c in docs.columns)))
