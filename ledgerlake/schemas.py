"""Table schemas (all business columns are text, as the reference stores them)."""

from __future__ import annotations

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .formats import BANK_COLUMNS, SECU_COLUMNS
from .operators.consolidate import BANK_TOTAL_COLUMNS, SECU_TOTAL_COLUMNS


# Partition columns of the raw and total tables (see plans.jobs).
PLACE = [StructField("period", StringType()), StructField("bucket", IntegerType())]


def _text(cols, nullable_id: bool = False) -> StructType:
    return StructType([StructField(c, StringType(), nullable_id or c != "id") for c in cols])


BANK_RAW_COLUMNS = ["id", "statement_id", "transaction_id", *BANK_COLUMNS, "date_created", "created_by"]
SECU_RAW_COLUMNS = ["id", "statement_id", "transaction_id", *SECU_COLUMNS, "date_created", "created_by"]

BANK_RAW = StructType(_text(BANK_RAW_COLUMNS + ["load_id"]).fields + PLACE)
SECU_RAW = StructType(_text(SECU_RAW_COLUMNS + ["load_id"]).fields + PLACE)
BANK_TOTAL = StructType(_text(BANK_TOTAL_COLUMNS + ["load_id"]).fields + PLACE)
SECU_TOTAL = StructType(_text(SECU_TOTAL_COLUMNS + ["load_id"]).fields + PLACE)

STATEMENT = StructType([
    StructField("id", StringType(), False),
    StructField("account_type", StringType()),
    StructField("bank", StringType()),
    StructField("from_date", StringType()),
    StructField("to_date", StringType()),
    StructField("statement_file", StringType()),
    StructField("status", StringType()),
    StructField("import_seq", LongType()),
])

STATEMENT_EVENT = StructType([
    StructField("statement_id", StringType(), False),
    StructField("event_seq", LongType(), False),
    StructField("job", StringType()),
    StructField("status", StringType()),
    StructField("message", StringType()),
    StructField("row_count", LongType()),
    StructField("duplicate_count", LongType()),
    StructField("total_count", LongType()),
    StructField("event_time", StringType()),
    StructField("load_id", StringType()),
])

# The event log as stored, by day of its sequence number, and snapshots of its deciding events.
EVENT_LOG = StructType([*STATEMENT_EVENT.fields, StructField("day", LongType())])
EVENT_SNAPSHOT = StructType([*STATEMENT_EVENT.fields, StructField("snapshot_id", StringType())])
SNAPSHOT_DONE = StructType([StructField("snapshot_id", StringType()), StructField("upto_day", LongType())])

# Contents of files that no waiting statement has claimed yet, and the files that runs have used.
HELD_FILE = StructType([
    StructField("file_path", StringType()),
    StructField("file_name", StringType()),
    StructField("content", StringType()),
    StructField("held_seq", LongType()),
    StructField("name_bucket", IntegerType()),
])

USED_FILE = StructType([
    StructField("file_path", StringType()),
    StructField("statement_id", StringType()),
    StructField("event_seq", LongType()),
])

# Dedup keys of a load's raw rows, and the loads that have them.
STORED_KEY = StructType([
    StructField("statement_id", StringType()),
    StructField("dedup_key", StringType()),
    StructField("load_id", StringType()),
    StructField("period", StringType()),
    StructField("key_bucket", IntegerType()),
])
KEY_LOAD = StructType([StructField("load_id", StringType())])

TABLE_SCHEMAS = {
    "bank_raw": BANK_RAW, "secu_raw": SECU_RAW,
    "bank_total": BANK_TOTAL, "secu_total": SECU_TOTAL,
    "statement_event": EVENT_LOG, "event_snapshot": EVENT_SNAPSHOT, "event_snapshot_done": SNAPSHOT_DONE,
    "bank_key": STORED_KEY, "secu_key": STORED_KEY, "key_load": KEY_LOAD,
    "held_file": HELD_FILE, "used_file": USED_FILE,
}
