"""From statement files to mapped rows.

``ingest_files`` returns (rows, problems): mapped rows keyed by statement and
file position, and one problem row per statement that cannot be imported,
with the reference's error text.  One bad statement never fails the batch.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..formats import FORMATS, format_registry
from ..session import cut_lineage
from ..sources.csv_statements import (detect_error, detect_format, map_layout, parse_records,
                                      unterminated_quote)


def classify_files(files: DataFrame) -> DataFrame:
    """A3 + F1: add ``format``, ``detect_error``, layout facts (broadcast 3-row join)."""
    reg = format_registry(files.sparkSession).withColumnRenamed("account_type", "format_account_type")
    return (files.withColumn("format", detect_format(F.col("content")))
            .withColumn("detect_error", detect_error(F.col("content")))
            .join(F.broadcast(reg), "format", "left"))


def map_all_layouts(rows: DataFrame) -> DataFrame:
    """P1-P4 for every layout present; output has the full column set of its
    account type (bank: 18, securities: 13)."""
    parts = {"bank": [], "secu": []}
    for name, lay in FORMATS.items():
        parts[lay.account_type].append(map_layout(rows.filter(F.col("format") == name), name))
    return {k: reduce(lambda a, b: a.unionByName(b), v) for k, v in parts.items()}


def short_lhv_rows(rows: DataFrame) -> DataFrame:
    """P4 guard: LHV rows with fewer than 7 cells cannot drop cell 6 (the
    reference fails the statement); returns offending statement ids."""
    lhv = FORMATS["LHV_BANK"]
    return (rows.filter((F.col("format") == lhv.name) & (F.size("fields") <= lhv.strip_index))
            .select("statement_id").distinct()
            .withColumn("message", F.lit("Row too short to remove the empty column")))


def resolve_files(statements: DataFrame, files: DataFrame) -> DataFrame:
    """A2: statements (statement_id, statement_file, ...) with file_path, content
    and ``n_loose``.

    A file belongs to a statement if it lies in a folder named after the
    statement's id and has the statement's file name.  A file outside such
    folders (a flat drop folder) is found by its name, if that is the only one
    of its name: ``n_loose`` counts them.
    """
    folder = F.element_at(F.split("file_path", "/"), -2)
    found = files.select("file_path", F.col("file_name").alias("statement_file"), "content",
                         F.url_decode(F.regexp_replace(folder, r"\+", "%2B")).alias("folder"))
    own = statements.join(found.withColumnRenamed("folder", "statement_id"), ["statement_id", "statement_file"])
    rest = statements.join(own.select("statement_id"), "statement_id", "left_anti")
    loose = found.join(statements.select(F.col("statement_id").alias("folder")), "folder", "left_anti")
    names = loose.groupBy("statement_file").agg(F.count(F.lit(1)).alias("n_loose"), F.min("file_path").alias("file_path"))
    named = rest.join(names, "statement_file", "left").withColumn("file_path", F.when(F.col("n_loose") == 1, F.col("file_path")))
    named = named.join(found.select("file_path", "content"), "file_path", "left")
    return own.drop("folder").withColumn("n_loose", F.lit(0)).unionByName(named.withColumn("n_loose", F.coalesce("n_loose", F.lit(0)).cast("int")))


def _iso(c: str):
    return F.col(c).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(F.col(c), "yyyy-MM-dd").isNotNull()


def ingest_files(statements: DataFrame, files: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """Statements (id, account_type, from_date, to_date, statement_file, ...) +
    files (file_path, file_name, content) -> ({'bank': rows, 'secu': rows},
    problems(statement_id, message)).

    Checks, in the reference's order: account type required, file attached,
    file present (A2, F4), header recognised (F1), format agrees with the
    declared account type (F3), file parseable; and statement dates, whose
    text order the overlap test needs, are ISO dates in order.
    """
    st = statements.select(F.col("id").alias("statement_id"), "account_type", "from_date", "to_date", "statement_file")
    joined = classify_files(resolve_files(st, files))
    dates = F.coalesce((F.col("from_date").isNull() | _iso("from_date")) & (F.col("to_date").isNull() | _iso("to_date"))
                       & ~F.coalesce(F.col("from_date") > F.col("to_date"), F.lit(False)), F.lit(False))
    msg = (F.when(F.col("account_type").isNull() | (F.col("account_type") == ""),
                  F.lit("account_type is required in the form"))
           .when(F.col("statement_file").isNull() | (F.col("statement_file") == ""),
                 F.concat(F.lit("No file attached to statement: "), F.col("statement_id")))
           .when(F.col("file_path").isNull() & (F.col("n_loose") > 1),
                 F.concat(F.lit("Several files are named "), F.col("statement_file"),
                          F.lit(" and none lies in the folder of "), F.col("statement_id")))
           .when(F.col("file_path").isNull(),
                 F.concat(F.lit("CSV file not found on disk: "), F.col("statement_file"),
                          F.lit(" (table=bank_statement, recordId="), F.col("statement_id"), F.lit(")")))
           .when(F.col("detect_error").isNotNull(), F.col("detect_error"))
           .when(F.col("format_account_type") != F.col("account_type"),
                 F.concat(F.lit("Format mismatch: detected "), F.col("format_account_type"),
                          F.lit(" but statement has account_type="), F.col("account_type")))
           .when(unterminated_quote(F.col("content")),
                 F.lit("CSV parse error: unterminated quoted field"))
           .when(~dates, F.concat(F.lit("Statement dates must be yyyy-MM-dd and in order: "),
                                  F.coalesce("from_date", F.lit("null")), F.lit(" to "), F.coalesce("to_date", F.lit("null")))))
    checked = joined.withColumn("message", msg)
    problems = checked.filter(F.col("message").isNotNull()).select("statement_id", "message")
    good = checked.filter(F.col("message").isNull()).drop("message", "detect_error")
    # every file is parsed once; the short-row check and the layouts read the result
    rows = cut_lineage(parse_records(good.select("statement_id", "format", "separator", "content")))
    short = short_lhv_rows(rows)
    problems = problems.unionByName(short)
    rows = rows.join(short.select("statement_id"), "statement_id", "left_anti")
    return map_all_layouts(rows), problems
