"""Approximate nearest neighbours by multi-index hashing of learned binary codes.

Codes: principal axes and an iteratively learned rotation (each bit's sign should lose as little
as possible) are fitted on a bounded sample, the ``sample_rows`` rows with the smallest hash of
their id; a code has one bit per rotated coordinate, at most 64.  The search radius is fitted on
the same sample: it holds the codes of ``wanted`` of the sample's own nearest neighbours.

Search: rows are dealt by id into index blocks and queries into query blocks, so memory is
bounded and every query meets every row once (a stated query set against all rows).  Within a
block the codes are split into substrings of up to 16 bits, each indexed by its value.  By the
pigeonhole principle a code within the radius is, in some substring, within radius // substrings
bits (one less from the (radius mod substrings)-th substring on), so probing these balls retrieves
every code within the radius; its full distance is verified and the vectors are reranked by
Euclidean distance in double precision.  A query with fewer than ``k`` codes within the radius of a
block probes further until it has them or the block is exhausted, so no query comes back short.

Defined cases: rows whose vector is null, empty, all zero, or holds null or non-finite
components, and rows of another length than the commonest one (of equally common ones the
smaller), take no part, as do rows without an id; rows are identified by id, so a query never
finds a row with its own id, and of repeated ids the nearest row counts once; ties go to the
smaller id; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 16


@dataclass
class Coder:
    mean: np.ndarray
    rotation: np.ndarray  # dimensions x bits
    radius: int

    @property
    def widths(self) -> list[int]:
        bits = self.rotation.shape[1]
        return [min(WIDTH, bits - at) for at in range(0, bits, WIDTH)]

    def codes(self, vectors: np.ndarray) -> np.ndarray:
        ones = (vectors - self.mean) @ self.rotation > 0
        return ones @ (np.uint64(1) << np.arange(ones.shape[1], dtype=np.uint64))


def fit_coder(sample: np.ndarray, wanted: float = 0.97, k: int = 10, rounds: int = 30, queries: int = 200, seed: int = 0) -> Coder:
    """Mean, rotation and radius from sample vectors (rows x dimensions)."""
    rng = np.random.default_rng(seed)
    bits = min(64, sample.shape[1])
    mean = sample.mean(axis=0)
    _, axes = np.linalg.eigh((sample - mean).T @ (sample - mean))  # ascending
    axes = axes[:, ::-1][:, :bits]
    flat = (sample - mean) @ axes
    turn = np.linalg.qr(rng.normal(size=(bits, bits)))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(flat @ turn > 0, 1.0, -1.0).T @ flat)
        turn = (u @ w).T
    coder = Coder(mean, axes @ turn, bits)
    codes, far = coder.codes(sample), []
    for q in range(min(queries, len(sample))):
        d = ((sample - sample[q]) ** 2).sum(axis=1)
        d[q] = np.inf
        near = np.argsort(d, kind="stable")[:min(k, len(sample) - 1)]
        far.extend(np.bitwise_count(codes[near] ^ codes[q]).tolist())
    coder.radius = int(np.ceil(np.quantile(far, wanted))) if far else bits
    return coder


class Block:
    """Substring tables over the codes of one index block."""

    def __init__(self, coder: Coder, ids: np.ndarray, vectors: np.ndarray):
        self.coder, self.ids, self.vectors, self.codes = coder, ids, vectors, coder.codes(vectors)
        self.tables = []
        for at, width in zip(range(0, 64, WIDTH), coder.widths):
            values = (self.codes >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << width) + 1))))
        masks = np.arange(1 << WIDTH)
        self.masks = masks[np.argsort(np.bitwise_count(masks), kind="stable")]

    def within(self, code: np.uint64, radius: int) -> np.ndarray:
        """Rows whose code differs from code in at most radius bits."""
        parts, m = [], len(self.tables)
        for i, ((order, starts), width) in enumerate(zip(self.tables, self.coder.widths)):
            ball = min(width, radius // m - (i > radius % m))
            if ball < 0:
                continue
            masks = self.masks[self.masks < 1 << width]
            values = masks[:np.searchsorted(np.bitwise_count(masks), ball, "right")] ^ int(code >> np.uint64(WIDTH * i) & np.uint64((1 << width) - 1))
            lo, n = starts[values], starts[values + 1] - starts[values]
            lo, n = lo[n > 0], n[n > 0]
            at = np.arange(n.sum()) + np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n)
            parts.append(order[at])
        rows = np.unique(np.concatenate(parts)) if parts else np.empty(0, np.int64)
        return rows[np.bitwise_count(self.codes[rows] ^ code) <= radius]

    def nearest(self, own: int, vector: np.ndarray, code: np.uint64, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and distances of the k nearest rows found, without rows of the own id."""
        radius, bits = self.coder.radius, self.coder.rotation.shape[1]
        while True:
            rows = self.within(code, radius)
            rows = rows[self.ids[rows] != own]
            if radius >= bits or len(rows) >= k and len(np.unique(self.ids[rows])) >= k:
                break
            radius += len(self.tables)
        d = np.sqrt(((self.vectors[rows] - vector) ** 2).sum(axis=1))
        order = np.lexsort((self.ids[rows], d))
        ids, d = self.ids[rows][order], d[order]
        _, first = np.unique(ids, return_index=True)
        first = np.sort(first)[:k]
        return ids[first], d[first]


def _usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def search(vectors: DataFrame, query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 10,
           sample_rows: int = 8192, wanted: float = 0.97, index_block: int = 16384, query_block: int = 4096) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row where query holds."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"), query.alias("asks")) \
        .filter(F.col("id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col("asks"), 1)).alias("q"))
    common = sizes.orderBy(F.desc("n"), "dim").limit(1).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not common:
        return vectors.sparkSession.createDataFrame([], result)
    dim, n, asked = common[0]
    rows = rows.filter(F.size("v") == dim)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow()
    coder = fit_coder(_matrix(sample.column("v"), dim), wanted, k)
    index_blocks, query_blocks = -(-n // index_block), max(1, -(-asked // query_block))

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    indexed = rows.select("id", "v", F.pmod(F.xxhash64("id"), F.lit(index_blocks)).cast("int").alias("i")).withColumn("q", every(query_blocks))
    asking = rows.filter("asks").select("id", "v", F.pmod(F.xxhash64("id", F.lit("q")), F.lit(query_blocks)).cast("int").alias("q")) \
        .withColumn("i", every(index_blocks))

    def run(index: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if index.num_rows and queries.num_rows:
            block = Block(coder, index.column("id").to_numpy(), _matrix(index.column("v"), dim))
            asked = _matrix(queries.column("v"), dim)
            for own, vector, code in zip(queries.column("id").to_pylist(), asked, coder.codes(asked)):
                ids, d = block.nearest(own, vector, code, k)
                out["query_id"] += [own] * len(ids)
                out["vec_id"] += ids.tolist()
                out["score"] += d.tolist()
        return pa.table({"query_id": pa.array(out["query_id"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    found = indexed.groupBy("i", "q").cogroup(asking.groupBy("i", "q")).applyInArrow(run, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))  # repeated query ids
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
