"""Staging of surviving rows (W1, K1 columns, P12-P15).

``transaction_id`` restarts at 001 per statement and follows file order over
the rows that survived dedup; ids are deterministic so a retried task or a
re-run writes the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..formats import SYSTEM_USER
from ..functions import stable_id, zero_pad
from .numbering import number_within

SYSTEM_COLUMNS = ["id", "statement_id", "transaction_id"]
AUDIT_COLUMNS = ["date_created", "created_by"]


def _by_fields(df: DataFrame, pos: str) -> list[Column]:
    """The order of ``pos``; that of a struct is given field by field, since rows are then mostly told apart
    by the first one, without a comparison of structs."""
    t = df.schema[pos].dataType
    if not isinstance(t, StructType) or len(set(t.names)) < len(t):
        return [F.col(pos).asc()]
    return [*[F.col(pos)[f].asc() for f in t.names], F.col(pos).isNotNull().asc()]


def number_rows(df: DataFrame, pos: str, bucket: Column | None = None) -> DataFrame:
    """Seq 1..n per statement in ``pos`` order -> ``transaction_id`` '001'.

    ``bucket`` follows ``pos`` and bounds what one task sorts (default: one bucket per statement)."""
    n = number_within(df, ["statement_id"], _by_fields(df, pos), [F.lit(0) if bucket is None else bucket], out="_seq")
    return n.withColumn("transaction_id", zero_pad(F.col("_seq"))).drop("_seq")


def stage(df: DataFrame, columns: list[str], bucket: Column | None = None, pos: str = "pos",
          load_id: Column | None = None) -> DataFrame:
    """Mapped rows -> raw table rows (system + mapped + audit columns)."""
    n = number_rows(df, pos, bucket)
    sel = [stable_id("statement_id", "transaction_id").alias("id"), F.col("statement_id"),
           F.col("transaction_id"), *[F.col(c) for c in columns],
           F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("date_created"),
           F.lit(SYSTEM_USER).alias("created_by")]
    if load_id is not None:
        sel.append(load_id.alias("load_id"))
    return n.select(*sel)
