"""De-duplication against overlapping statements.

A row of statement S is a duplicate when its key was stored by another
statement of the same account type whose period overlaps S and whose status
is not 'error'/'new'.  In-file duplicates are kept (Q1); primary and composite
keys share one namespace (Q4).

Scale notes
-----------
* Overlap (J1) is an interval join.  Instead of a theta join over every
  statement pair of an account type, each statement is exploded into the
  months it covers and joined on (account_type, month); a pair is emitted only
  at the month where the overlap starts, so no ``distinct`` is needed.
* Keys are reduced to (statement, key) grain before any join, so in-file
  repeats never multiply.  Dedup never builds the overlap pairs: both sides
  carry their statement's period and are joined on (key, month), so a key
  meets only its own holders of the same month.
* The bulk fold (J6) is one shuffle by key and one pass over each key's holders
  in import order; keys with one holder never leave the JVM.
"""

from __future__ import annotations

from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..formats import (BANK_COLUMNS, BANK_COMPOSITE_INDICES, BANK_PRIMARY_KEY_INDEX,
                       SECU_COLUMNS, SECU_COMPOSITE_INDICES, SECU_PRIMARY_KEY_INDEX)
from ..functions import incoming_dedup_key, stored_dedup_key
from ..session import written

NON_BLOCKING_STATUSES = ("error", "new")
# Statements of one account type from which a month is compared by days, and those of a bin that one task takes.
DENSE_MONTH = 1000
SLICE = 1000
SALTS = 32


def key_columns(account_type: str) -> tuple[str, list[str]]:
    """Primary and composite key columns; anything not 'bank' is securities."""
    if account_type == "bank":
        return (BANK_COLUMNS[BANK_PRIMARY_KEY_INDEX], [BANK_COLUMNS[i] for i in BANK_COMPOSITE_INDICES])
    return (SECU_COLUMNS[SECU_PRIMARY_KEY_INDEX], [SECU_COLUMNS[i] for i in SECU_COMPOSITE_INDICES])


def with_incoming_key(rows: DataFrame, account_type: str, out: str = "dedup_key") -> DataFrame:
    """P9 on mapped incoming rows (missing cells are NULL -> '')."""
    pk, comp = key_columns(account_type)
    return rows.withColumn(out, incoming_dedup_key(pk, comp))


def stored_keys(raw: DataFrame, account_type: str) -> DataFrame:
    """J2/J3 + U2 + G7: distinct (statement_id, dedup_key) of stored raw rows."""
    pk, comp = key_columns(account_type)
    return raw.select("statement_id", stored_dedup_key(pk, comp).alias("dedup_key")).distinct()


def blocks(status) -> F.Column:
    """status NOT IN ('error','new'); NULL status -> False (3-valued logic)."""
    s = F.col(status) if isinstance(status, str) else status
    return F.coalesce(~s.isin(*NON_BLOCKING_STATUSES), F.lit(False))


def _months(from_col: str, to_col: str) -> F.Column:
    f = F.try_to_date(F.col(from_col), "yyyy-MM-dd")
    t = F.try_to_date(F.col(to_col), "yyyy-MM-dd")
    return F.when(f.isNotNull() & t.isNotNull() & (f <= t),
                  F.sequence(F.trunc(f, "month"), F.trunc(t, "month"), F.expr("INTERVAL 1 MONTH")))


def _binned(st: DataFrame) -> DataFrame:
    """``st`` (id, account_type, from_date, to_date, bank) with a row per ``bin`` its period touches.

    A bin is the first day of a month or, in months that more than ``DENSE_MONTH`` statements of the
    account type touch, each day: the width follows the counts.  The counts are one row per (account
    type, month) of the calendar; the join with them is salted, so that a month of all statements
    is dealt over tasks.
    """
    months = st.withColumn("mon", F.explode(_months("from_date", "to_date")))
    dense = (months.groupBy("account_type", "mon").count().filter(F.col("count") > DENSE_MONTH)
             .select("account_type", "mon", F.lit(True).alias("dense"),
                     F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt")))
    salted = months.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    first = F.greatest(F.to_date("from_date"), F.col("mon"))
    last = F.least(F.to_date("to_date"), F.last_day("mon"))
    return (salted.join(dense, ["account_type", "mon", "salt"], "left")
            .withColumn("bin", F.explode(F.when(F.col("dense"), F.sequence(first, last)).otherwise(F.array("mon"))))
            .withColumn("dense", F.coalesce("dense", F.lit(False))).drop("salt", "mon"))


def overlap_pairs(statements: DataFrame, only_blocking: bool = True, same_bank: bool = False) -> DataFrame:
    """J1 (F5 F7 F8, and F6 when ``only_blocking``): (statement_id, other_id).

    ``other_id`` overlaps ``statement_id``: same account type, other.from <=
    this.to and other.to >= this.from (text compare of ISO dates, NULL = no
    overlap), different id.  The reference ignores the bank (Q3);
    ``same_bank=True`` also requires the same bank.

    Joined on (account type, bin) with months or days as bins, by the counts
    (``_binned``).  The statements of a bin are dealt into slices of about
    ``SLICE`` on the one side, and each slice meets the bin's statements of
    the other side in a task of its own; a pair is emitted in the bin where its
    overlap starts.
    """
    bank = F.col("bank") if "bank" in statements.columns else F.lit(None).cast("string")
    binned = _binned(statements.select("id", "account_type", "from_date", "to_date", "status", bank.alias("bank")))
    slices = (binned.groupBy("account_type", "bin").agg(F.ceil(F.count(F.lit(1)) / F.lit(SLICE)).cast("int").alias("slices"))
              .filter("slices > 1"))
    hot = slices.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = (binned.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
              .join(hot, ["account_type", "bin", "salt"], "left").drop("salt")
              .withColumn("slices", F.coalesce("slices", F.lit(1))))
    names = {"account_type": "type", "from_date": "from", "to_date": "to", "bank": "bank"}
    a = salted.select(F.col("id").alias("statement_id"), *[F.col(c).alias(f"a_{n}") for c, n in names.items()], "bin", "dense",
                      F.pmod(F.xxhash64("id", F.lit("slice")), F.col("slices")).cast("int").alias("slice"))
    b = salted.filter(blocks("status")) if only_blocking else salted
    b = b.select(F.col("id").alias("other_id"), *[F.col(c).alias(f"b_{n}") for c, n in names.items()], "bin",
                 F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))
    start = F.to_date(F.greatest(F.col("a_from"), F.col("b_from")))
    cond = (a.a_type == b.b_type) & (a.bin == b.bin) & (a.slice == b.slice)
    if same_bank:
        cond = cond & (a.a_bank == b.b_bank)
    return (a.join(b, cond)
            .filter((F.col("b_from") <= F.col("a_to")) & (F.col("b_to") >= F.col("a_from"))
                    & (F.col("statement_id") != F.col("other_id"))
                    & (a.bin == F.when(F.col("dense"), start).otherwise(F.trunc(start, "month"))))
            .select("statement_id", "other_id", F.col("a_type").alias("account_type")))


def near_statements(statements: DataFrame, batch: DataFrame) -> DataFrame:
    """(statement_id) of blocking statements that overlap one of ``batch`` (statement_id), other than
    the batch itself: what ``overlap_pairs`` would list, without building pairs of statements.

    Only distinct periods are compared, however many statements share one.
    """
    periods = ["account_type", "from_date", "to_date"]
    ours = statements.join(batch, statements["id"] == batch["statement_id"], "left_semi").select(*periods).distinct()
    others = (statements.filter(blocks("status")).join(batch, statements["id"] == batch["statement_id"], "left_anti")
              .select("id", *periods))
    theirs = others.select(*periods).distinct()
    both = (ours.withColumns({"id": F.concat_ws("/", F.lit("ours"), *periods), "status": F.lit("new")})
            .unionByName(theirs.withColumns({"id": F.concat_ws("/", F.lit("theirs"), *periods), "status": F.lit("imported")})))
    hit = overlap_pairs(both).filter(F.col("statement_id").startswith("ours/")).select(F.col("other_id").alias("period")).distinct()
    return (others.withColumn("period", F.concat_ws("/", F.lit("theirs"), *periods))
            .join(hit, "period", "left_semi").select(F.col("id").alias("statement_id")))


def _holders(keys: DataFrame, statements: DataFrame, prefix: str, extra: list[str]) -> DataFrame:
    """(statement, key) rows with their statement's period, one row per month covered."""
    st = statements.select(F.col("id").alias("statement_id"), "account_type", "from_date", "to_date", *extra)
    return keys.join(st, "statement_id").select(
        F.col("statement_id").alias(f"{prefix}id"), "dedup_key", F.col("account_type").alias(f"{prefix}type"),
        F.col("from_date").alias(f"{prefix}from"), F.col("to_date").alias(f"{prefix}to"),
        *[F.col(c).alias(f"{prefix}{c}") for c in keys.columns + extra if c not in ("statement_id", "dedup_key")],
        F.explode(_months("from_date", "to_date")).alias("mon"))


def key_overlaps(keys: DataFrame, others: DataFrame, statements: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """(x_id, y_id, dedup_key, x_* / y_* extras): holders x of a key in ``keys``
    and y in ``others`` whose statements overlap, y's status blocking (F5-F8).

    Joined on (key, month); each pair is emitted once, at the month where the
    overlap starts.
    """
    extra = extra or []
    x = _holders(keys, statements, "x_", extra)
    y = _holders(others, statements.filter(blocks("status")), "y_", extra)
    start = F.trunc(F.to_date(F.greatest(F.col("x_from"), F.col("y_from"))), "month")
    return (x.join(y, ["dedup_key", "mon"])
            .filter((F.col("y_type") == F.col("x_type")) & (F.col("y_from") <= F.col("x_to"))
                    & (F.col("y_to") >= F.col("x_from")) & (F.col("x_id") != F.col("y_id")) & (F.col("mon") == start)))


def blocked_keys(incoming: DataFrame, statements: DataFrame, stored: DataFrame) -> DataFrame:
    """(statement_id, dedup_key) of ``incoming`` that an overlapping statement has stored.

    ``incoming`` and ``stored``: distinct (statement_id, dedup_key).
    """
    found = key_overlaps(incoming, stored, statements)
    return found.select(F.col("x_id").alias("statement_id"), "dedup_key").distinct()


def drop_stored_duplicates(incoming: DataFrame, statements: DataFrame, stored_raw: DataFrame,
                           account_type: str) -> tuple[DataFrame, DataFrame]:
    """J4/J5 for a batch of independent imports against what is stored now.

    Returns (surviving rows in their original order columns, counts per
    statement: parsed, duplicates, new).
    """
    flagged = flag_stored_duplicates(incoming, statements, stored_raw, account_type)
    kept = flagged.filter(~F.col("_dup")).drop("_dup")
    return kept, dedup_counts(flagged)


def flag_stored_duplicates(incoming: DataFrame, statements: DataFrame, stored_raw: DataFrame,
                           account_type: str) -> DataFrame:
    """Incoming rows + ``dedup_key`` + ``_dup`` (J4/J5 verdict per row)."""
    return flag_held_keys(incoming, statements, stored_keys(stored_raw, account_type), account_type)


def flag_held_keys(incoming: DataFrame, statements: DataFrame, stored: DataFrame, account_type: str) -> DataFrame:
    """``flag_stored_duplicates`` against stored keys (statement_id, dedup_key)."""
    keyed = with_incoming_key(incoming, account_type)
    blocked = blocked_keys(keyed.select("statement_id", "dedup_key").distinct(),
                           statements.filter(F.col("account_type") == account_type), stored)
    flagged = keyed.join(blocked.withColumn("_dup", F.lit(True)), ["statement_id", "dedup_key"], "left")
    return flagged.withColumn("_dup", F.coalesce(F.col("_dup"), F.lit(False)))


def dedup_counts(flagged: DataFrame, dup_col: str = "_dup") -> DataFrame:
    """Per statement parsed / duplicate / new counts."""
    return flagged.groupBy("statement_id").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.col(dup_col)).alias("duplicate_count"),
        F.count_if(~F.col(dup_col)).alias("new_count"))


#: Keys held by more statements than this are cut at months that none of them covers.
MANY_HOLDERS = 1_000


def _islands(held: DataFrame) -> DataFrame:
    """(dedup_key, mon, island): the months that a key's holders cover, in runs without a gap.

    Holders in different islands share no day.  A key has one row a calendar month, however many
    statements hold it.
    """
    covered = held.select("dedup_key", F.explode(F.sequence(F.trunc("from_day", "month"), F.trunc("to_day", "month"),
                                                            F.expr("INTERVAL 1 MONTH"))).alias("mon")).distinct()
    order = Window.partitionBy("dedup_key").orderBy("mon")
    fresh = F.coalesce(F.col("mon") > F.add_months(F.lag("mon").over(order), 1), F.lit(True))
    return covered.withColumn("fresh", fresh.cast("int")).select(
        "dedup_key", "mon", F.sum("fresh").over(order).alias("island"))


class KeptPeriods:
    """The union of the periods whose statements keep a key, as sorted disjoint intervals."""

    def __init__(self):
        self.starts, self.ends = [], []

    def overlaps(self, start, end) -> bool:
        at = bisect_right(self.starts, end) - 1
        return at >= 0 and self.ends[at] >= start

    def add(self, start, end) -> None:
        at = bisect_right(self.starts, start)
        if at and self.ends[at - 1] >= start:
            at, start = at - 1, self.starts[at - 1]
        upto = bisect_right(self.starts, end)
        if upto > at:
            end = max(end, self.ends[upto - 1])
        self.starts[at:upto], self.ends[at:upto] = [start], [end]


def _fold(batches):
    """Verdicts for sorted rows of (key, island): stored holders first, then incoming ones in import order.

    Statements of equal order do not block each other, so their periods count from the next on;
    without an order a statement blocks nobody.
    """
    group, seq, kept, waiting = None, None, KeptPeriods(), []
    for b in batches:
        out = []
        for row in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
            statement, key, island, is_stored, order, blocking, start, end = row
            if (key, island) != group:
                group, seq, kept, waiting = (key, island), None, KeptPeriods(), []
            if is_stored:
                if blocking:
                    kept.add(start, end)
                continue
            if order != seq:
                for period in waiting:
                    kept.add(*period)
                seq, waiting = order, []
            keeps = not kept.overlaps(start, end)
            out.append((statement, key, keeps))
            if keeps and blocking and order is not None:
                waiting.append((start, end))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.string(), pa.bool_()))],
                                             ["statement_id", "dedup_key", "kept"])


def bulk_dedup(incoming: DataFrame, statements: DataFrame, account_type: str,
               stored: DataFrame | None = None) -> DataFrame:
    """Dedup many statements at once, in import order (``import_seq``).

    Per (account type, key), statements are visited in import order; a
    statement keeps the key unless an already-kept, blocking statement that
    overlaps it holds the key.  Rows already stored (``stored``: statement_id,
    dedup_key) count as kept first.  Result: (statement_id, dedup_key, kept).

    A key with one holder, or a statement without a valid period, is kept at
    once.  All other holders go through one fold: a shuffle by key, a sort by
    import order inside each task, and one pass over the sorted rows whose only
    state is the kept periods of the current key, as disjoint intervals; so a
    chain of any length takes one job, and neither a key's holders nor its
    verdicts are held together.  A key held by very many statements is cut at
    the months that no holder covers, and its islands are folded apart.
    """
    from_day, to_day = (F.try_to_date(F.col(c), "yyyy-MM-dd") for c in ("from_date", "to_date"))
    st = (statements.filter(F.col("account_type") == account_type)
          .select(F.col("id").alias("statement_id"), F.col("import_seq").alias("order"), blocks("status").alias("blocking"),
                  from_day.alias("from_day"), to_day.alias("to_day")))
    keys = with_incoming_key(incoming, account_type).select("statement_id", "dedup_key").distinct()
    if stored is not None:
        stored = stored.select("statement_id", "dedup_key").distinct()
        keys = keys.join(stored, ["statement_id", "dedup_key"], "left_anti")
    held = keys.withColumn("stored", F.lit(False))
    if stored is not None:
        held = held.unionByName(stored.withColumn("stored", F.lit(True)))
    held = held.join(st, "statement_id", "left").withColumn("valid", F.coalesce(F.col("from_day") <= F.col("to_day"), F.lit(False)))
    held = written(held)
    counts = held.filter("valid").groupBy("dedup_key").agg(F.count(F.lit(1)).alias("holders"), F.count_if("stored").alias("stored_holders"))
    several = counts.filter("holders > 1 AND holders > stored_holders").select("dedup_key", "holders")
    # holders outside the fold: no valid period, or no other holder
    alone = held.filter("NOT stored").join(several.select("dedup_key", F.lit(True).alias("folded")), "dedup_key", "left")
    at_once = alone.filter(~F.col("valid") | F.col("folded").isNull()).select("statement_id", "dedup_key", F.lit(True).alias("kept"))
    rows = held.filter("valid").join(several, "dedup_key")
    many = _islands(rows.filter(F.col("holders") > MANY_HOLDERS))
    rows = (rows.withColumn("mon", F.when(F.col("holders") > MANY_HOLDERS, F.trunc("from_day", "month")))
            .join(many, ["dedup_key", "mon"], "left")
            .select("statement_id", "dedup_key", F.coalesce("island", F.lit(0)).alias("island"), "stored",
                    F.col("order").cast("string").alias("tie"), "blocking", "from_day", "to_day", "order"))
    folded = (rows.repartition("dedup_key", "island")
              .sortWithinPartitions("dedup_key", "island", F.col("stored").desc(), F.col("order").asc_nulls_first())
              .drop("order").mapInArrow(_fold, "statement_id string, dedup_key string, kept boolean"))
    return at_once.unionByName(folded)


def flag_bulk_duplicates(incoming: DataFrame, verdict: DataFrame, account_type: str) -> DataFrame:
    """Incoming rows + ``dedup_key`` + ``_dup`` from J6 verdicts."""
    keyed = with_incoming_key(incoming, account_type)
    return keyed.join(verdict, ["statement_id", "dedup_key"], "left").withColumn(
        "_dup", ~F.coalesce(F.col("kept"), F.lit(True))).drop("kept")


def apply_bulk_dedup(incoming: DataFrame, verdict: DataFrame, account_type: str) -> tuple[DataFrame, DataFrame]:
    """Join J6 verdicts back to rows: (surviving rows, per-statement counts)."""
    flagged = flag_bulk_duplicates(incoming, verdict, account_type)
    return flagged.filter(~F.col("_dup")).drop("_dup"), dedup_counts(flagged)
