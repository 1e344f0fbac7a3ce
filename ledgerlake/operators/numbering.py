"""Per-statement sequence numbers without one task per statement.

``row_number() OVER (PARTITION BY statement ORDER BY ...)`` puts a whole
statement into one task; a statement holding a third of all rows would then
sort on one core.  ``number_within`` splits every partition into nested
buckets that follow the sort order, numbers rows inside the innermost bucket
and adds the row counts of all earlier buckets, level by level.  The only
extra data is one count per bucket, and the result equals the plain
``row_number()`` exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written

# Rows that one task numbers, about, and the most parts that one bucket is divided into.
PART_ROWS = 1 << 16
MAX_PARTS = 1024
SALTS = 32


def same_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[f"_o{k}"]) for k in keys])


def _renamed(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.withColumnsRenamed({k: f"_o{k}" for k in keys})


def number_within(df: DataFrame, partition_cols: list[str], order_cols: list,
                  buckets: list[Column], out: str = "seq", weight: Column | None = None) -> DataFrame:
    """Add ``out`` = 1..n within ``partition_cols`` in ``order_cols`` order; with
    ``weight``, the running sum of the weights (``order_cols`` must be total then).

    ``buckets``, outermost first, must be non-decreasing along ``order_cols``
    within the bucket around them (e.g. ``file_pos div 65536``, the leading
    sort keys, or a prefix of a text sort key).  The innermost buckets bound
    what one task sorts, so give as many levels as a hot partition needs.

    The rows are shuffled once: they meet the offsets on the struct by which the window has dealt
    them (null-safe equality of the single keys would deal them again).
    """
    levels = [f"_b{i}" for i in range(len(buckets))]
    keys = [*partition_cols, *levels]
    b = df.withColumns(dict(zip(levels, buckets)))
    counts = b.groupBy(*keys).agg((F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_n"))
    offsets = None
    for depth in range(1, len(levels) + 1):
        at = [*partition_cols, *levels[:depth]]
        level = counts if depth == len(levels) else counts.groupBy(*at).agg(F.sum("_n").alias("_n"))
        before = (Window.partitionBy(*at[:-1]).orderBy(F.col(at[-1]).asc_nulls_first())
                  .rowsBetween(Window.unboundedPreceding, -1))
        level = level.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
        if offsets is not None:
            outer = _renamed(offsets, at[:-1]).withColumnRenamed("_off", "_outer")
            level = (level.join(outer, same_keys(level, outer, at[:-1]))
                     .withColumn("_off", F.col("_off") + F.col("_outer"))
                     .drop("_outer", *[f"_o{k}" for k in at[:-1]]))
        offsets = level
    local = Window.partitionBy("_bucket").orderBy(*order_cols)
    numbered = b.withColumn("_bucket", F.struct(*keys)).drop(*levels)
    numbered = numbered.withColumn("_local", F.row_number().over(local) if weight is None else
                                   F.sum(weight).over(local.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    offsets = offsets.select(F.struct(*keys).alias("_obucket"), "_off")
    return (numbered.join(offsets, F.col("_bucket") == F.col("_obucket"))
            .withColumn(out, (F.col("_off") + F.col("_local")).cast("int"))
            .drop("_local", "_off", "_bucket", "_obucket"))


def part_cuts(df: DataFrame, bucket_cols: list[str], sort: list[str], part_rows: int = PART_ROWS,
              max_parts: int = MAX_PARTS) -> DataFrame:
    """``bucket_cols`` and ``_cuts``: the sampled ``sort`` keys that divide a bucket; buckets without one are left out.

    Written, so that a join with them is planned by their real size: one row in ``part_rows`` is sampled.
    """
    hashed = F.xxhash64(*bucket_cols, *sort)
    cuts = (df.filter(F.pmod(hashed, F.lit(part_rows)) == 0).groupBy(*bucket_cols)
            .agg(F.sort_array(F.collect_set(F.struct(*sort))).alias("_cuts")))
    step = F.greatest(F.lit(1), F.ceil(F.size("_cuts") / F.lit(max_parts)))
    return written(cuts.withColumn("_cuts", F.filter("_cuts", lambda c, i: F.pmod(i, step) == 0)))


def with_parts(df: DataFrame, bucket_cols: list[str], sort: list[str], out: str = "_part",
               part_rows: int = PART_ROWS, max_parts: int = MAX_PARTS, cuts: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the part of its bucket (``bucket_cols``) that a row's ``sort`` key lies in.

    Parts follow the ascending order (nulls first) of ``sort``, hold about ``part_rows`` rows each, and
    are cut at sampled keys: one key in ``part_rows``, chosen by hash, so that every evaluation of
    the plan chooses the same.  A bucket with more than ``max_parts`` of them is cut at that many,
    evenly spread.  Equal keys share a part.  The join that brings the cuts (default: ``part_cuts``) to
    the rows is salted by key, so a hot bucket is spread over tasks there too.
    """
    cuts = part_cuts(df, bucket_cols, sort, part_rows, max_parts) if cuts is None else cuts
    cuts = _renamed(cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), [*bucket_cols, "_salt"])
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*sort), F.lit(SALTS)).cast("int"))
    key = F.struct(*sort)
    part = F.when(F.col("_cuts").isNull(), 0).otherwise(F.size(F.filter("_cuts", lambda c: c <= key)))
    return (salted.join(cuts, same_keys(salted, cuts, [*bucket_cols, "_salt"]), "left")
            .withColumn(out, part).drop("_cuts", "_salt", *[f"_o{k}" for k in [*bucket_cols, "_salt"]]))


def number_by_keys(df: DataFrame, partition_cols: list[str], sort: list[str], lead: int = 2, out: str = "seq",
                   part_rows: int = PART_ROWS) -> DataFrame:
    """``number_within`` by ``sort`` (ascending, nulls first): buckets are the first ``lead`` keys, divided
    by ranges of the others where many rows share them."""
    split = with_parts(df, [*partition_cols, *sort[:lead]], sort[lead:], "_part", part_rows)
    levels = [*[F.col(c) for c in sort[:lead]], F.col("_part")]
    return number_within(split, partition_cols, [F.col(c).asc_nulls_first() for c in sort], levels, out).drop("_part")
