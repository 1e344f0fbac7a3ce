"""Data-quality checks and monitoring reports.

``top_k_within`` is a two-phase top-k: the k best of every (group, salt)
slice first, then the k best of those candidates per group -- a statement
holding a third of all rows is still spread over ``salt_buckets`` tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

MANDATORY_BANK = ["account_number", "payment_date", "d_c", "payment_amount", "currency"]
MANDATORY_SECU = ["value_date", "transaction_date", "type", "quantity", "amount", "currency"]


def bank_checks(raw: DataFrame) -> DataFrame:
    """F16 on bank rows, per statement: missing mandatory fields, negative
    amounts not marked debit, amounts written with a decimal comma."""
    missing = None
    for c in MANDATORY_BANK:
        m = F.col(c).isNull()
        missing = m if missing is None else missing | m
    return raw.groupBy("statement_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(missing).alias("missing_mandatory"),
        F.count_if(F.col("payment_amount").like("-%") & (F.col("d_c") != "D")).alias("negative_not_debit"),
        F.count_if(F.col("payment_amount").like("%,%")).alias("decimal_comma"))


def secu_checks(raw: DataFrame) -> DataFrame:
    """F16 on securities rows, per statement."""
    missing = None
    for c in MANDATORY_SECU:
        m = F.col(c).isNull()
        missing = m if missing is None else missing | m
    return raw.groupBy("statement_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(missing).alias("missing_mandatory"),
        F.count_if(F.col("amount").like("%,%")).alias("decimal_comma"))


def counts_by(df: DataFrame, *cols: str) -> DataFrame:
    """Monitoring counts (by statement, status, currency ...)."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def top_k_within(df: DataFrame, group: list[str], order: list[Column], k: int,
                 salt: Column | None = None, salt_buckets: int = 64, out: str = "rank") -> DataFrame:
    """The k first rows per group in ``order`` (a total order), ranked 1..k."""
    s = salt if salt is not None else F.abs(F.xxhash64(*[F.col(c) for c in df.columns])) % salt_buckets
    pre = df.withColumn("_salt", s)
    w1 = Window.partitionBy(*group, "_salt").orderBy(*order)
    cand = pre.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= k).drop("_r", "_salt")
    w2 = Window.partitionBy(*group).orderBy(*order)
    return cand.withColumn(out, F.row_number().over(w2)).filter(F.col(out) <= k)
