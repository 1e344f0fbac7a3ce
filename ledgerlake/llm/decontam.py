"""Benchmark decontamination by size-partitioned MinHash containment search.

Words are runs of non-white-space (space and U+0009 to U+000D separate) of the lower-cased text;
a shingle is ``shingle`` consecutive words.  A document is contaminated by an item if it has at
least ``threshold`` of the item's distinct shingles.

Search: items are partitioned by size (powers of two of their shingle count).  An item's sketch
is its k smallest shingle hashes, where k is one more than the number of shingles that the
largest item of its partition may miss.  A document that reaches the threshold misses fewer than
k of the item's shingles, so it has at least one of any k: no contaminated document escapes, and
the sketch is sought among all shingles of the document however long it is.  Verification counts
the item's distinct shingles, as text, in the candidates.

The items' tables are broadcast only if they have at most ``broadcast_rows`` rows, else joined by
a shuffle; candidates likewise.  Only DataFrame functions are used.

Defined cases: null or empty texts have no shingles; an item or document of fewer than
``shingle`` words is never matched; rows are told apart by id and text, so repeated rows give one
pair; rows without an id are judged too (their pair has a null id); an item id given to several
texts is several items; empty tables give no rows; other columns are ignored, or passed through by
``keep_clean``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, fits_broadcast, free_names, text_or_empty

BROADCAST_ROWS = 200_000
WHITE = " \t\n\u000b\f\r"


def words(text: Column) -> Column:
    """Lower-cased words; an empty text has the one word ''."""
    return F.split(F.btrim(F.lower(text), F.lit(WHITE)), r"[\x20\x09-\x0D]+")


def _each(found: Column, shingle: int, of) -> Column:
    """of(first word, second word, ...) for every shingle.

    found must be a column of its own, not an expression: it is read once for every word.
    """
    places = F.when(F.size(found) >= shingle, F.sequence(F.lit(0), F.size(found) - shingle))
    return F.transform(F.coalesce(places, F.array().cast("array<int>")),
                       lambda i: of(*(F.get(found, i + k) for k in range(shingle))))


def shingle_hashes(found: Column, shingle: int) -> Column:
    return _each(found, shingle, F.xxhash64)


def shingle_texts(found: Column, shingle: int) -> Column:
    return _each(found, shingle, lambda *w: F.concat_ws(" ", *w))


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if fits_broadcast(df, rows) else df


def _items(bench: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float) -> DataFrame:
    """(item_id, item, grams, n, need): the distinct shingles of each item and how many must be found."""
    text = text_or_empty(F.col(text_col))
    found = bench.select(F.col(id_col).cast("long").alias("item_id"), F.xxhash64(F.col(id_col).cast("string"), text).alias("item"),
                         words(text).alias("words"))
    found = found.select("item_id", "item", F.array_distinct(shingle_texts(F.col("words"), shingle)).alias("grams"))
    return (found.filter(F.size("grams") > 0).dropDuplicates(["item"]).withColumn("n", F.size("grams"))
            .withColumn("need", F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)).cast("int")))


def contaminated(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_col: str = "item_id", item_text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
                 broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """(doc_id, text_key, item_id, n_shingles, n_found) of every pair at or above the threshold."""
    items = cut(_items(bench, item_col, item_text_col, shingle, threshold))
    # the largest size of an item's partition, and how many shingles a match of that size may miss
    largest = F.pow(F.lit(2), F.length(F.bin("n"))) - 1
    allowed = (largest - F.ceil(largest * F.lit(threshold) - F.lit(1e-9))).cast("int")
    hashes = F.transform("grams", lambda g: F.xxhash64(*(F.get(F.split(g, " "), k) for k in range(shingle))))
    sketch = items.select("item", F.explode(F.slice(F.array_sort(hashes), F.lit(1), allowed + 1)).alias("hash"))

    text = text_or_empty(F.col(text_col))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), words(text).alias("words"))
    hits = rows.select("doc_id", "text_key", F.explode(shingle_hashes(F.col("words"), shingle)).alias("hash"))
    candidates = cut(hits.join(_small(sketch, broadcast_rows), "hash").select("doc_id", "text_key", "item").distinct())

    # candidates only: all their shingles as text against those of the items
    named = candidates.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k")).distinct()
    again = (rows.join(_small(named, broadcast_rows), F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")), "left_semi")
             .select("doc_id", "text_key", F.explode(shingle_texts(F.col("words"), shingle)).alias("gram")).distinct())
    grams = items.select("item", "item_id", "n", "need", F.explode("grams").alias("gram"))
    found = again.join(_small(grams, broadcast_rows), "gram").select("doc_id", "text_key", "item", "item_id", "n", "need")
    pairs = candidates.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), F.col("item").alias("i"))
    return (found.groupBy("doc_id", "text_key", "item", "item_id", "n", "need").agg(F.count(F.lit(1)).alias("n_found"))
            .filter("n_found >= need")
            .join(pairs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")) & (F.col("item") == F.col("i")), "left_semi")
            .select("doc_id", "text_key", "item_id", F.col("n").alias("n_shingles"), F.col("n_found").cast("int").alias("n_found")))


def keep_clean(docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs that no benchmark item contaminates, with their columns as they are."""
    id_, key = free_names(docs, "id", "key")
    bad = contaminated(docs, bench, id_col, text_col, **how).select(
        F.col("doc_id").alias(id_), F.col("text_key").alias(key)).distinct()
    same = F.col(f"`{id_col}`").cast("long").eqNullSafe(F.col(id_)) & \
        (F.xxhash64(text_or_empty(F.col(f"`{text_col}`"))) == F.col(key))
    return docs.join(_small(cut(bad), BROADCAST_ROWS), same, "left_anti")
