"""Deterministic row ids (P13): retry-stable, unlike uuid()."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(*parts) -> Column:
    """36-character 8-4-4-4-12 id from a SHA-256 of the parts."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("\u0000"))
            for p in parts]
    h = F.sha2(F.concat_ws("|", *cols), 256)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))
