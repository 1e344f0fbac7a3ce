"""Statement control: status events, metadata, errors.

Plain parquet has no UPDATE, so a statement's mutable fields become an
append-only ``statement_event`` log; the current statement row is the latest
event per statement (``max_by`` over ``event_seq``), with import counts and
consolidation counts taken from their own latest events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..formats import ALLOWED_TRANSITIONS
from ..functions import truncate_error
from ..schemas import STATEMENT_EVENT

EVENT_COLUMNS = [f.name for f in STATEMENT_EVENT.fields]


def events(df: DataFrame, job: str, status: Column | str, event_seq: int | Column,
           message: Column | None = None, row_count: Column | None = None,
           duplicate_count: Column | None = None, total_count: Column | None = None,
           load_id: str | None = None) -> DataFrame:
    """Rows of ``statement_event`` for every statement_id in ``df``."""
    st = F.lit(status) if isinstance(status, str) else status
    none_l = F.lit(None).cast("long")
    return df.select(
        F.col("statement_id"),
        (event_seq if isinstance(event_seq, Column) else F.lit(event_seq)).cast("long").alias("event_seq"),
        F.lit(job).alias("job"),
        st.alias("status"),
        (message if message is not None else F.lit(None).cast("string")).alias("message"),
        (row_count.cast("long") if row_count is not None else none_l).alias("row_count"),
        (duplicate_count.cast("long") if duplicate_count is not None else none_l).alias("duplicate_count"),
        (total_count.cast("long") if total_count is not None else none_l).alias("total_count"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.lit(load_id).cast("string").alias("load_id"))


def error_events(problems: DataFrame, job: str, event_seq: int) -> DataFrame:
    """K9: status 'error' with the message cut to 1000 chars (NULL -> 'Unknown error')."""
    return events(problems, job, "error", event_seq, message=truncate_error(F.col("message")))


def refusals(refused: DataFrame, job: str, event_seq: int) -> DataFrame:
    """K8: a job asked for a statement whose status does not allow it.  The
    event has no status of its own, so the statement's stays as it is."""
    return events(refused, job, F.lit(None).cast("string"), event_seq, message=truncate_error(F.col("message")))


def _latest(ev: DataFrame, cols: list[str], alias: str) -> DataFrame:
    return ev.groupBy("statement_id").agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.col("event_seq")).alias(alias))


def deciding_events(ev: DataFrame) -> DataFrame:
    """The events of ``ev`` that ``current_statements`` depends on: per statement the latest with a status,
    the latest reset, and the latest 'imported' and 'consolidated' after it.

    Every choice is a maximum of ``event_seq``, so these rows and any other events give the same
    statements as ``ev`` and those events do, whatever their order or overlap.
    """
    row = F.struct(*EVENT_COLUMNS)
    latest = lambda cond: F.max_by(F.when(cond, row), F.when(cond, F.col("event_seq")))
    kept = ev.groupBy("statement_id").agg(
        latest(F.col("status").isNotNull()).alias("last"), latest(F.col("job") == "reset").alias("reset"),
        latest(F.col("status") == "imported").alias("imported"), latest(F.col("status") == "consolidated").alias("consolidated"))
    after = lambda c: F.when(F.coalesce(F.col(f"{c}.event_seq") > F.col("reset.event_seq"), F.lit(True)), F.col(c))
    rows = F.array_distinct(F.array_compact(F.array("last", "reset", after("imported"), after("consolidated"))))
    return kept.select(F.explode(rows).alias("e")).select("e.*")


def current_statements(statements: DataFrame, ev: DataFrame) -> DataFrame:
    """The statement table as the reference keeps it (K6/K7 metadata).

    status / error_message from the latest event (control status if none);
    row_count, duplicate_count, processing_timestamp from the latest
    'imported' event; total_count, consolidation_timestamp from the latest
    'consolidated' event; ``load_id`` of the rows currently valid.
    """
    last = _latest(ev.filter(F.col("status").isNotNull()), ["status", "message"], "_last")
    # a reset (K5) invalidates every earlier import / consolidation
    reset = ev.filter(F.col("job") == "reset").groupBy("statement_id").agg(F.max("event_seq").alias("_reset"))
    live = (ev.join(reset, "statement_id", "left")
            .filter(F.col("_reset").isNull() | (F.col("event_seq") > F.col("_reset"))).drop("_reset"))
    imp = _latest(live.filter(F.col("status") == "imported"),
                  ["row_count", "duplicate_count", "event_time", "load_id"], "_imp")
    con = _latest(live.filter(F.col("status") == "consolidated"),
                  ["total_count", "event_time", "load_id"], "_con")
    s = statements.withColumnRenamed("id", "statement_id")
    out = (s.join(last, "statement_id", "left").join(imp, "statement_id", "left")
           .join(con, "statement_id", "left"))
    return out.select(
        F.col("statement_id").alias("id"), *[c for c in s.columns if c not in ("statement_id", "status")],
        F.coalesce(F.col("_last.status"), F.col("status")).alias("status"),
        F.when(F.col("_last.status") == "error", F.col("_last.message")).alias("error_message"),
        F.col("_imp.row_count").alias("row_count"),
        F.col("_imp.duplicate_count").alias("duplicate_count"),
        F.col("_imp.event_time").alias("processing_timestamp"),
        F.col("_imp.load_id").alias("raw_load_id"),
        F.col("_con.total_count").alias("total_count"),
        F.col("_con.event_time").alias("consolidation_timestamp"),
        F.col("_con.load_id").alias("total_load_id"))


def status_timeline(ev: DataFrame, initial: DataFrame | None = None) -> DataFrame:
    """K8: each event with its predecessor status and whether the transition
    is allowed (new -> importing -> imported -> consolidating ->
    consolidated; anything -> error).  Window per statement (few events each)."""
    ev = ev.filter(F.col("status").isNotNull())
    w = Window.partitionBy("statement_id").orderBy("event_seq")
    prev = F.lag("status").over(w)
    if initial is not None:
        ev = ev.join(initial.select(F.col("id").alias("statement_id"), F.col("status").alias("_init")),
                     "statement_id", "left")
        prev = F.coalesce(prev, F.col("_init"))
    allowed = F.lit(False)
    for a, b in ALLOWED_TRANSITIONS:
        allowed = allowed | ((F.col("previous_status") == a) & (F.col("status") == b))
    allowed = allowed | (F.col("status") == "error") | F.col("previous_status").isNull()
    out = ev.withColumn("previous_status", prev).withColumn("allowed", allowed)
    return out.drop("_init") if initial is not None else out
