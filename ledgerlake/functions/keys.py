"""Dedup keys.

Primary key (trimmed) when non-blank, otherwise the composite key: each part
trimmed, NULL/missing as '', and *every* part followed by '|'.  ``concat_ws``
is not usable: it drops NULL parts and omits the trailing separator.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import java_trim


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _composite(parts, trim: bool) -> Column:
    pieces = []
    for p in parts:
        v = java_trim(_c(p)) if trim else _c(p)
        pieces += [F.coalesce(v, F.lit("")), F.lit("|")]
    return F.concat(*pieces)


def incoming_dedup_key(primary, composite_parts) -> Column:
    """Key of an incoming (just parsed) row."""
    pk = java_trim(_c(primary))
    return F.when(pk.isNotNull() & (pk != ""), pk).otherwise(_composite(composite_parts, trim=True))


def stored_dedup_key(primary, composite_parts) -> Column:
    """Key of a stored raw row (primary trimmed, composite as stored)."""
    pk = _c(primary)
    return (F.when(pk.isNotNull() & (pk != ""), java_trim(pk))
            .otherwise(_composite(composite_parts, trim=False)))
