"""Connected components over an edge table, for classes of near-duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (u long, v long); root is the smallest node reachable.

    Alternates the large-star and small-star steps until the edges stop changing.  Every step is
    a minimum per node (pre-aggregated) and a join, emits at most one row per edge, and is
    written to the shared folder, so a hub with very many links is no group in one task.  Loops
    and repeated edges are allowed; edges with a null end are ignored; no edges give no rows.
    """
    now = cut(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
              .filter("u IS NOT NULL AND v IS NOT NULL AND u > v").distinct())
    before = None
    while (state := _state(now)) != before:
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = (both.filter("v > u").join(least, "u").filter("v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large = cut(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        now = cut(large.join(least, "u").filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                  .union(least.select("u", F.col("m").alias("v"))).distinct())
    return (now.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .union(now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct())
