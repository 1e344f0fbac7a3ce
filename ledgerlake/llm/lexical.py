"""Ranked lexical search of documents for a set of query items, by dual trees.

A term is a run of ASCII letters and digits and of all characters beyond ASCII, with A to Z in
lower case.  A document's score for an item sums, over the item's terms with repeats, the term's
weight times its saturated frequency in the document (``weight`` and ``impact``), in whole numbers.

One pass counts, for every document, its terms and its occurrences of the items' terms, and writes
these vectors to the shared folder; another gives the numbers of documents per term.  Then each
task scores the documents of one batch of vectors at a time.  Both sides are hierarchies: items,
put in order of their rarest term, in nodes of 512, 64, 8 and 1; documents, in order of their
strongest term, in nodes of 4096, 256, 16 and 1.  A node holds the maximum of each coordinate over
its members (item nodes: weight times repeats, document nodes: impact), so the product of two nodes
is an upper bound of all their pairs' scores.  A pair of nodes whose bound is below the weakest
k-th score that any of the node's items has so far, or zero, is dropped with all its pairs;
otherwise both are split.  At single items and documents the bound is the score itself, so the
result is exact.  Each task keeps k documents an item, and these are merged by rank.

Items are the query set: they are taken in blocks of bounded size (``block_items``,
``block_bytes``; one longer item is a block), each held by the driver and every task, and each
block searches all documents.  Nothing else that grows with the data is held whole.

Defined cases: a null or empty text has no terms; such documents are not counted and such items
get no rows; every row of items is an item and every row of documents a document, also if ids
repeat or are null (null document ids come after all others of the same score); of rows alike in
score and id any come first; no items or no documents give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import new_folder, text_or_empty

ITEM_NODES, DOC_NODES = (512, 64, 8, 1), (4096, 256, 16, 1)
#: The largest sum that double precision adds exactly.
EXACT = 1 << 53
FOUND = "item int, item_id long, doc_id long, score long"
#: Every byte that separates terms becomes a space, and A to Z lower case.
FOLD = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def terms(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def vectors(docs: DataFrame, id_col: str, text_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, counts) of every document with terms: all its terms, and those of the vocabulary."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        get = known.value.get
        for b in batches:
            ids, sizes, numbers, found, counts = [], [], [], [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                words = terms(text.as_py())
                if not words:
                    continue
                here = np.fromiter(map(get, words, repeat(-1)), np.int32, len(words))
                term, tf = np.unique(here[here >= 0], return_counts=True)
                ids.append(doc_id)
                numbers.append(len(words))
                sizes.append(len(term))
                found.append(term)
                counts.append(tf.astype(np.int32))
            if ids:
                offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(numbers, pa.int64()),
                     *(pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(c))) for c in (found, counts))],
                    ["doc_id", "n", "terms", "counts"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).cast("binary").alias("text")) \
        .mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<int>")


class ItemTree:
    """Items with the coordinate maxima of their nodes, and the k best documents of each so far."""

    def __init__(self, items: list[dict[int, int]], weights: np.ndarray, k: int):
        """items: for each, its terms and how often it has them."""
        self.weights, self.k = weights, k
        rarest = [max(((int(weights[t]), t) for t in item), default=(0, -1)) for item in items]
        self.order = sorted(range(len(items)), key=lambda i: (rarest[i], i))
        self.levels = []
        leaves = [{t: c * int(weights[t]) for t, c in items[i].items() if weights[t] > 0} for i in self.order]
        for size in ITEM_NODES:
            nodes = []
            for at in range(0, len(leaves), size):
                most: dict[int, int] = {}
                for leaf in leaves[at:at + size]:
                    for t, c in leaf.items():
                        if c > most.get(t, 0):
                            most[t] = c
                nodes.append((np.array(sorted(most), np.int64), np.array([most[t] for t in sorted(most)], np.int64)))
            self.levels.append(nodes)
        # an impact is below 1,000,000
        self.exact = max((sum(leaf.values()) for leaf in leaves), default=0) * 1_000_000 < EXACT
        self.kth = np.zeros(len(items), np.int64)
        self.best: list[list[tuple]] = [[] for _ in items]

    def offer(self, at: int, scores: np.ndarray, docs: np.ndarray, ids: list) -> None:
        rows = [(-s, ids[d] is None, ids[d] or 0) for s, d in zip(scores.tolist(), docs.tolist())]
        self.best[at] = sorted(self.best[at] + rows)[:self.k]
        if len(self.best[at]) == self.k:
            self.kth[at] = -self.best[at][-1][0]


class DocTree:
    """A batch of documents with the coordinate maxima of their nodes, term by term."""

    def __init__(self, n: np.ndarray, offsets: np.ndarray, term: np.ndarray, tf: np.ndarray, n_docs: int, n_terms: int, weights: np.ndarray):
        doc = np.repeat(np.arange(len(n)), np.diff(offsets))
        value = impact(tf, (75 + 25 * n * n_docs // n_terms)[doc])
        keep = (value > 0) & (weights[term] > 0)
        doc, term, value = doc[keep], term[keep], value[keep]
        strongest = np.full(len(n), -1)
        by_strength = np.argsort(weights[term] * value, kind="stable")
        strongest[doc[by_strength]] = term[by_strength]      # the last one written is the strongest
        self.order = np.lexsort((n, strongest))
        rank = np.empty(len(n), np.int64)
        rank[self.order] = np.arange(len(n))
        place = np.lexsort((rank[doc], term))
        term, at, value = term[place], rank[doc][place], value[place]
        self.levels = []
        for size in DOC_NODES:
            node = at // size
            if len(term):
                fresh = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (node[1:] != node[:-1])])
                top = np.maximum.reduceat(value, fresh)
                self.levels.append((np.searchsorted(term[fresh], np.arange(len(weights) + 1)), node[fresh], top))
            else:
                self.levels.append((np.zeros(len(weights) + 1, np.int64), at, value))

    def products(self, level: int, terms: np.ndarray, coordinates: np.ndarray, active: np.ndarray, exact: bool) -> np.ndarray:
        """The product of an item node with every node of a level; inactive nodes have 0."""
        starts, node, top = self.levels[level]
        lo, hi = starts[terms], starts[terms + 1]
        counts = hi - lo
        places = np.repeat(lo - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        nodes, values = node[places], np.repeat(coordinates, counts) * top[places]
        here = active[nodes]
        nodes, values = nodes[here], values[here]
        if exact:
            return np.bincount(nodes, weights=values, minlength=len(active)).astype(np.int64)
        out = np.zeros(len(active), np.int64)
        np.add.at(out, nodes, values)
        return out


def _below(values: np.ndarray, depth: int, n: int) -> np.ndarray:
    """The values of document nodes, given to their children."""
    wide = DOC_NODES[depth] // DOC_NODES[depth + 1]
    return np.repeat(values, wide)[:-(-n // DOC_NODES[depth + 1])]


def search_batch(items: ItemTree, tree: DocTree, n: int, ids: list) -> int:
    """Offer the documents of a batch to the items; returns the pairs of nodes compared.

    A pair is looked at again when its turn comes, as scores have grown by then; for a single item,
    the document nodes with the highest bounds come first.
    """
    last, compared = len(DOC_NODES) - 1, 0
    todo = [(0, node, 0, np.full(-(-n // DOC_NODES[0]), 1 << 62)) for node in range(len(items.levels[0]))]
    while todo:
        level, node, depth, bounds = todo.pop()
        size = ITEM_NODES[level]
        weakest = max(1, int(items.kth[node * size:(node + 1) * size].min()))
        active = bounds >= weakest
        if not active.any():
            continue
        compared += int(active.sum())
        bounds = tree.products(depth, *items.levels[level][node], active, items.exact)
        active = bounds >= weakest
        if not active.any():
            continue
        if level < len(ITEM_NODES) - 1:
            wide = size // ITEM_NODES[level + 1]
            below = _below(bounds, depth, n) if depth < last else bounds
            todo += [(level + 1, c, min(depth + 1, last), below)
                     for c in range(node * wide, min((node + 1) * wide, len(items.levels[level + 1])))]
        elif depth < last:
            best = np.zeros(len(bounds), bool)
            best[np.argsort(bounds)[-4:]] = True
            todo += [(level, node, depth + 1, _below(np.where(best == first, bounds, 0), depth, n)) for first in (False, True)]
        else:
            found = np.flatnonzero(active)
            if len(found) > items.k:    # ties of the k-th stay
                found = found[bounds[found] >= np.partition(bounds[found], -items.k)[-items.k]]
            items.offer(node, bounds[found], tree.order[found], ids)
    return compared


def _block(docs: DataFrame, id_col: str, text_col: str, items: list[tuple], k: int) -> DataFrame:
    """FOUND rows of the k best documents of each item (item_id, text)."""
    spark = docs.sparkSession
    counted = [Counter(terms((text or "").encode())) for _, text in items]
    names = sorted({t for c in counted for t in c})
    vocabulary = {t: i for i, t in enumerate(names)}
    path = new_folder(spark, "lexical")
    vectors(docs, id_col, text_col, vocabulary).write.parquet(path)
    rows = spark.read.parquet(path)
    n_docs, n_terms = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = rows.select(F.explode("terms").alias("term")).groupBy("term").count().toArrow()
    weights = np.zeros(len(names), np.int64)
    for t, d in zip(df.column("term").to_pylist(), df.column("count").to_pylist()):
        weights[t] = weight(n_docs, d)
    given = spark.sparkContext.broadcast(([{vocabulary[t]: c for t, c in found.items()} for found in counted],
                                          [i for i, _ in items], weights))

    def run(batches):
        found, item_ids, weights = given.value
        tree = ItemTree(found, weights, k)
        for b in batches:
            lists, ids = b.column("terms"), b.column("doc_id").to_pylist()
            offsets = lists.offsets.to_numpy().astype(np.int64)
            docs = DocTree(b.column("n").to_numpy(), offsets - offsets[0], lists.flatten().to_numpy().astype(np.int64),
                           b.column("counts").flatten().to_numpy().astype(np.int64), n_docs, n_terms, weights)
            search_batch(tree, docs, len(ids), ids)
        out = [(tree.order[at], item_ids[tree.order[at]], None if none else doc, -score)
               for at, rows in enumerate(tree.best) for score, none, doc in rows]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                                             ["item", "item_id", "doc_id", "score"])

    return rows.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", k: int = 20, block_items: int = 20_000, block_bytes: int = 16 << 20) -> DataFrame:
    """(item_id, rank, doc_id, score) of the k highest-scoring documents of every item, ties to the smaller doc_id."""
    asked = items.select(F.col(item_col).cast("long").alias("item_id"), text_or_empty(F.col(item_text_col)).alias("text"))
    n, size = asked.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // block_items), -(-size // block_bytes))
    dealt = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for number in range(blocks):
        block = [(r["item_id"], r["text"]) for r in dealt.filter(F.col("block") == number).collect()]
        here = _block(docs, id_col, text_col, block, k)
        best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        here = here.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
        found = here if found is None else found.unionByName(here)
    return found
