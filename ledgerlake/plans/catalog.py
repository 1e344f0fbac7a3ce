"""Named queries over the driver's tables, each with a DuckDB oracle.

Every query runs the library operators over the whole derived statement
world (``bindings.World``); nothing is sampled or capped.  Columns that are
not reproducible by design (timestamps) are left out of the comparison.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..formats import BANK_COLUMNS, SECU_COLUMNS
from ..operators import consolidate as C
from ..operators import recognise as R
from ..operators.numbering import PART_ROWS
from ..operators.stage import stage
from ..session import SlicedTable, at_once, new_table, shuffles_removed, tables_removed, written, written_in_slices
from . import oracle as O
from .bindings import World, pos_bucket

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared staged tables (Spark side)
# ---------------------------------------------------------------------------

def staged_bank(w: World, with_settlements: bool = False) -> DataFrame:
    """The bank raw table as the import job writes it."""
    src = w.bank_all_in if with_settlements else w.bank_in
    return stage(src, BANK_COLUMNS, pos_bucket())


def staged_secu(w: World) -> DataFrame:
    """The securities raw table as the import job writes it."""
    return stage(w.secu_in, SECU_COLUMNS, pos_bucket())


_TOTAL_DROP = ["date_created"]


def stored_raw(raw: DataFrame, columns: list[str], largest: int) -> DataFrame:
    """Raw rows with the ``columns`` that consolidation reads: written where it reads them several times."""
    return written(raw.select("statement_id", "transaction_id", *columns)) if largest > PART_ROWS else raw


def bank_totals(w: World, with_settlements: bool = False) -> DataFrame:
    largest = w.most_rows("bank", with_settlements)
    raw = stored_raw(staged_bank(w, with_settlements), [*C.BANK_KEYS, "payment_amount", "transaction_fee", "provider_reference"], largest)
    return C.consolidate_bank(raw, w.bank_stmt, largest=largest)


SECU_SUMMED = ["quantity", "price", "amount", "fee", "total_amount", "reference"]


def secu_totals(w: World) -> DataFrame:
    largest = w.most_rows("secu")
    return C.consolidate_secu(stored_raw(staged_secu(w), [*C.SECU_KEYS, *SECU_SUMMED], largest), w.secu_stmt, largest=largest)


def stored_totals(w: World, bank: bool = True, secu: bool = True) -> tuple[DataFrame | None, DataFrame | None]:
    """Bank and securities summary rows with their BIC, as a job would have written them: the
    recognition plans read them several times.  Statements are consolidated apart from each other, so
    slices of them are staged, consolidated and written one after the other."""
    _ = bank and w.bank_stmt, w.secu_stmt        # written before, since they stay
    with tables_removed(w.spark) as outside:
        to_bank, to_secu = (SlicedTable(w.spark, outside) if wanted else None for wanted in (bank, secu))
        for part in w.slices(bank):
            with tables_removed(w.spark):
                part.store(*["bank_at"] * bank, "secu_at")
                _ = part.secu_in, w.bank_dim        # made before, since both use them
                steps = [lambda: to_bank.add(lambda: R.with_bic(bank_totals(part, with_settlements=True), w.bank_stmt, w.bank_dim))] * bank
                steps += [lambda: to_secu.add(lambda: R.with_bic(secu_totals(part), w.secu_stmt, w.bank_dim))] * secu
                at_once(w.spark, *steps)
        return tuple(t and t.rows() for t in (to_bank, to_secu))


def in_slices(w: World, build: Callable[[World], DataFrame]) -> DataFrame:
    """``build`` of all securities statements: of many rows written a slice of the statements at a time, so that
    only the result and one slice's shuffle files and tables are on disk."""
    parts = w.slices(bank=False, size=4)
    return build(w) if len(parts) == 1 else written_in_slices(w.spark, len(parts), lambda i: build(parts[i]))


# ---------------------------------------------------------------------------
# consolidation
# ---------------------------------------------------------------------------

@query("consolidate_secu", O.with_views(["secu_total"], "SELECT * FROM secu_total"))
def q_consolidate_secu(spark, sf_dir):
    return secu_totals(World(spark, sf_dir)).drop(*_TOTAL_DROP)


@query("consolidate_bank", O.with_views(["bank_total"], "SELECT * FROM bank_total"))
def q_consolidate_bank(spark, sf_dir):
    return bank_totals(World(spark, sf_dir)).drop(*_TOTAL_DROP)


@query("stage_numbering", O.with_views(["secu_raw"], f"""
SELECT statement_id, transaction_id, {', '.join(SECU_COLUMNS)} FROM secu_raw"""))
def q_stage_numbering(spark, sf_dir):
    return in_slices(World(spark, sf_dir), lambda w: staged_secu(w).drop("id", "date_created", "created_by"))


# ---------------------------------------------------------------------------
# dedup (P9-P11, F5-F9, J1-J6, G6, G7)
# ---------------------------------------------------------------------------
from ..operators import dedup as D  # noqa: E402


def _duck_key(pk: str, parts: list[str], trim_parts: bool) -> str:
    comp = " || ".join(f"coalesce({'trim(' + p + ')' if trim_parts else p}, '') || '|'" for p in parts)
    if trim_parts:
        return f"CASE WHEN trim({pk}) <> '' THEN trim({pk}) ELSE {comp} END"
    return f"CASE WHEN {pk} IS NOT NULL AND {pk} <> '' THEN trim({pk}) ELSE {comp} END"


_BANK_PK, _BANK_PARTS = D.key_columns("bank")
_SECU_PK, _SECU_PARTS = D.key_columns("secu")
_DUCK_PAIRS = """
    SELECT a.id AS statement_id, b.id AS other_id, a.account_type
    FROM stmt a JOIN stmt b ON a.account_type = b.account_type
     AND b.status NOT IN ('error', 'new') AND b.from_date <= a.to_date
     AND b.to_date >= a.from_date AND a.id <> b.id"""


@query("overlap_pairs", O.with_views(["stmt"], _DUCK_PAIRS))
def q_overlap_pairs(spark, sf_dir):
    return D.overlap_pairs(World(spark, sf_dir).stmt)


@query("dedup_keys", O.with_views(["bank_in"], f"""
SELECT statement_id, archival_number, {_duck_key(_BANK_PK, _BANK_PARTS, True)} AS dedup_key FROM bank_in"""))
def q_dedup_keys(spark, sf_dir):
    w = World(spark, sf_dir)
    return D.with_incoming_key(w.bank_in, "bank").select("statement_id", "archival_number", "dedup_key")


def _stored_scenario(w: World, account_type: str):
    """Statements with status 'imported' are stored; 'new' ones import now."""
    src = w.bank_in if account_type == "bank" else w.secu_in
    cols = BANK_COLUMNS if account_type == "bank" else SECU_COLUMNS
    st = w.stmt.filter(F.col("account_type") == account_type)
    stored_ids = st.filter(F.col("status") == "imported").select(F.col("id").alias("statement_id"))
    new_ids = st.filter(F.col("status") == "new").select(F.col("id").alias("statement_id"))
    stored_raw = stage(src.join(stored_ids, "statement_id"), cols, pos_bucket())
    incoming = src.join(new_ids, "statement_id")
    return D.drop_stored_duplicates(incoming, w.stmt, stored_raw, account_type)


_DUCK_SCENARIO = f"""
, stored AS (
    SELECT DISTINCT r.statement_id, {_duck_key(_BANK_PK, _BANK_PARTS, False)} AS dedup_key
    FROM bank_raw r JOIN stmt s ON s.id = r.statement_id WHERE s.status = 'imported'),
pairs AS ({_DUCK_PAIRS}),
blocked AS (SELECT DISTINCT p.statement_id, k.dedup_key FROM pairs p JOIN stored k ON k.statement_id = p.other_id),
incoming AS (
    SELECT i.*, {_duck_key(_BANK_PK, _BANK_PARTS, True)} AS dedup_key
    FROM bank_in i JOIN stmt s ON s.id = i.statement_id WHERE s.status = 'new'),
flagged AS (
    SELECT i.*, b.dedup_key IS NOT NULL AS dup
    FROM incoming i LEFT JOIN blocked b ON b.statement_id = i.statement_id AND b.dedup_key = i.dedup_key)
"""


def _scenario_sql(body: str) -> str:
    base = O.with_views(["bank_raw", "stmt", "bank_in"], "SELECT 1")
    return base[: -len("SELECT 1")].rstrip() + _DUCK_SCENARIO + body


@query("dedup_antijoin", _scenario_sql(
    "SELECT statement_id, archival_number, dedup_key FROM flagged WHERE NOT dup"))
def q_dedup_antijoin(spark, sf_dir):
    kept, _ = _stored_scenario(World(spark, sf_dir), "bank")
    return kept.select("statement_id", "archival_number", "dedup_key")


@query("dedup_counts", _scenario_sql("""
SELECT statement_id, count(*) AS row_count, CAST(count_if(dup) AS BIGINT) AS duplicate_count,
       CAST(count_if(NOT dup) AS BIGINT) AS new_count FROM flagged GROUP BY statement_id"""))
def q_dedup_counts(spark, sf_dir):
    _, counts = _stored_scenario(World(spark, sf_dir), "bank")
    return counts


@query("dedup_antijoin_secu", O.with_views(["secu_raw", "stmt", "secu_in"], "SELECT 1")[: -len("SELECT 1")].rstrip() + f"""
, stored AS (
    SELECT DISTINCT r.statement_id, {_duck_key(_SECU_PK, _SECU_PARTS, False)} AS dedup_key
    FROM secu_raw r JOIN stmt s ON s.id = r.statement_id WHERE s.status = 'imported'),
pairs AS ({_DUCK_PAIRS}),
blocked AS (SELECT DISTINCT p.statement_id, k.dedup_key FROM pairs p JOIN stored k ON k.statement_id = p.other_id)
SELECT i.statement_id, i.reference, {_duck_key(_SECU_PK, _SECU_PARTS, True)} AS dedup_key
FROM secu_in i JOIN stmt s ON s.id = i.statement_id
WHERE s.status = 'new' AND NOT EXISTS (SELECT 1 FROM blocked b WHERE b.statement_id = i.statement_id
                                       AND b.dedup_key = {_duck_key(_SECU_PK, _SECU_PARTS, True)})""")
def q_dedup_antijoin_secu(spark, sf_dir):
    """J3 + P11: securities rows against stored securities keys."""
    kept, _ = _stored_scenario(World(spark, sf_dir), "secu")
    return kept.select("statement_id", "reference", "dedup_key")


@query("stored_keys_secu", O.with_views(["secu_raw"], f"""
SELECT DISTINCT statement_id, {_duck_key(_SECU_PK, _SECU_PARTS, False)} AS dedup_key FROM secu_raw"""))
def q_stored_keys_secu(spark, sf_dir):
    return D.stored_keys(staged_secu(World(spark, sf_dir)), "secu")


_DUCK_FOLD = f"""
, nodes AS (
    SELECT k.statement_id, k.dedup_key, s.import_seq AS seq, s.from_date AS f, s.to_date AS t,
           coalesce(s.status NOT IN ('error', 'new'), false) AS blocks
    FROM (SELECT DISTINCT statement_id, {_duck_key(_SECU_PK, _SECU_PARTS, True)} AS dedup_key FROM secu_in) k
    JOIN stmt s ON s.id = k.statement_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY dedup_key ORDER BY seq) AS rn FROM nodes),
fold AS (
    SELECT dedup_key, rn, [{{'sid': statement_id, 'f': f, 't': t, 'blocks': blocks}}] AS acc
    FROM ranked WHERE rn = 1
    UNION ALL
    SELECT r.dedup_key, r.rn,
           CASE WHEN len(list_filter(fo.acc, lambda y: y.blocks AND y.f <= r.t AND y.t >= r.f)) > 0
                THEN fo.acc
                ELSE list_append(fo.acc, {{'sid': r.statement_id, 'f': r.f, 't': r.t, 'blocks': r.blocks}}) END
    FROM fold fo JOIN ranked r ON r.dedup_key = fo.dedup_key AND r.rn = fo.rn + 1),
final AS (SELECT dedup_key, arg_max(acc, rn) AS acc FROM fold GROUP BY dedup_key),
kept AS (SELECT DISTINCT dedup_key, unnest(acc).sid AS statement_id FROM final)
"""


def _fold_sql(body: str) -> str:
    base = O.with_views(["secu_in", "stmt"], "SELECT 1")
    head = base[: -len("SELECT 1")].rstrip()
    return head.replace("WITH ", "WITH RECURSIVE ", 1) + _DUCK_FOLD + body


@query("dedup_bulk_fold", _fold_sql("""
SELECT n.statement_id, n.dedup_key, k.statement_id IS NOT NULL AS kept
FROM nodes n LEFT JOIN kept k ON k.statement_id = n.statement_id AND k.dedup_key = n.dedup_key"""))
def q_dedup_bulk_fold(spark, sf_dir):
    w = World(spark, sf_dir)
    return D.bulk_dedup(w.secu_in, w.stmt, "secu")


# ---------------------------------------------------------------------------
# CSV ingest (A3-A5, P1-P8, F1): render derived rows as CSV chunks, parse back
# ---------------------------------------------------------------------------
from ..formats import LHV_HEADER, SECURITIES_HEADER, SWEDBANK_HEADER  # noqa: E402
from ..operators import ingest as I  # noqa: E402
from ..sources import csv_statements as CSV  # noqa: E402


def rendered_files(w: World, *layouts: str) -> DataFrame:
    """Bank statements of region 2 as Swedbank files, other banks as LHV files,
    securities as securities files (the named layouts, default all); one file
    per (statement, position chunk)."""
    swed, grp, parts = F.col("statement_id").endswith("-2"), ["statement_id", "_chunk"], []
    b = w.bank_in.withColumn("_chunk", pos_bucket()).withColumn("_blank", F.lit(""))
    for name in layouts or ("LHV_BANK", "SWEDBANK", "SECURITIES"):
        if name == "LHV_BANK":
            lhv_cols = BANK_COLUMNS[:6] + ["_blank"] + BANK_COLUMNS[6:]
            parts.append(CSV.render_csv(b.filter(~swed), lhv_cols, LHV_HEADER, ",", grp, "pos"))
        elif name == "SWEDBANK":
            parts.append(CSV.render_csv(b.filter(swed), BANK_COLUMNS[:14], SWEDBANK_HEADER, ";", grp, "pos", bom=False))
        else:
            s = w.secu_in.withColumn("_chunk", pos_bucket())
            parts.append(CSV.render_csv(s, SECU_COLUMNS, SECURITIES_HEADER, ",", grp, "pos"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def parsed_rendered(w: World, layout: str, escape: bool = False) -> DataFrame:
    """The files of one layout detected, parsed and mapped again."""
    files = I.classify_files(rendered_files(w, layout)).filter(F.col("format") == layout)
    rows = CSV.parse_records(files.select("statement_id", "_chunk", "format", "separator", "content"), escape=escape)
    return CSV.map_layout(rows, layout)


_DUCK_CHUNKS = """
SELECT DISTINCT statement_id, p_k // 65536 AS _chunk,
       CASE WHEN statement_id LIKE 'S%' THEN 'SECURITIES'
            WHEN statement_id LIKE '%-2' THEN 'SWEDBANK' ELSE 'LHV_BANK' END AS format
FROM (SELECT statement_id, p_k FROM bank_in UNION ALL SELECT statement_id, p_k FROM secu_in)"""


@query("detect_format", O.with_views(["bank_in", "secu_in"], _DUCK_CHUNKS))
def q_detect_format(spark, sf_dir):
    files = I.classify_files(rendered_files(World(spark, sf_dir)))
    return files.select("statement_id", "_chunk", "format")


@query("parse_csv_roundtrip", O.with_views(["bank_in"], f"""
SELECT statement_id, {', '.join(BANK_COLUMNS)} FROM bank_in WHERE statement_id NOT LIKE '%-2'"""))
def q_parse_csv_roundtrip(spark, sf_dir):
    return parsed_rendered(World(spark, sf_dir), "LHV_BANK").select("statement_id", *BANK_COLUMNS)


@query("map_bank_swed", O.with_views(["bank_in"], f"""
SELECT statement_id, {', '.join(BANK_COLUMNS[:14])}, {', '.join('NULL::VARCHAR AS ' + c for c in BANK_COLUMNS[14:])}
FROM bank_in WHERE statement_id LIKE '%-2'"""))
def q_map_bank_swed(spark, sf_dir):
    return parsed_rendered(World(spark, sf_dir), "SWEDBANK").select("statement_id", *BANK_COLUMNS)


@query("map_secu", O.with_views(["secu_in"], f"""
SELECT statement_id, {', '.join(SECU_COLUMNS)} FROM secu_in"""))
def q_map_secu(spark, sf_dir):
    return parsed_rendered(World(spark, sf_dir), "SECURITIES").select("statement_id", *SECU_COLUMNS)


@query("scan_csv_blocks", O.with_views(["secu_in"], f"""
SELECT statement_id, {', '.join(SECU_COLUMNS)} FROM secu_in"""))
def q_scan_csv_blocks(spark, sf_dir):
    """A4 from files: the securities files written to the shared folder and scanned in blocks."""
    return in_slices(World(spark, sf_dir), scanned_files)


def scanned_files(w: World) -> DataFrame:
    files = rendered_files(w, "SECURITIES")
    folder = new_table(w.spark, name="files")
    dealt = files.select("statement_id", F.col("_chunk").cast("string").alias("part"), "content").repartition("statement_id", "part")
    with shuffles_removed(w.spark):
        dealt.write.partitionBy("statement_id", "part").text(folder)
    records, _ = CSV.scan_records(CSV.read_lines(w.spark, folder))
    rows = records.filter("file_pos > 0").withColumn("fields", CSV.split_fields(F.col("record"), F.lit(",")))
    return CSV.map_layout(rows.select("statement_id", "fields"), "SECURITIES").select("statement_id", *SECU_COLUMNS)


@query("parse_legacy_secu", O.with_views(["secu_in"], f"""
SELECT statement_id, {', '.join(SECU_COLUMNS)} FROM secu_in"""))
def q_parse_legacy_secu(spark, sf_dir):
    """A5: the legacy reader (backslash escapes) over the securities files."""
    return parsed_rendered(World(spark, sf_dir), "SECURITIES", escape=True).select("statement_id", *SECU_COLUMNS)


@query("detect_format_legacy", O.with_views(["bank_in", "secu_in"], _DUCK_CHUNKS))
def q_detect_format_legacy(spark, sf_dir):
    """legacy header rules."""
    files = rendered_files(World(spark, sf_dir)).withColumn("format", CSV.legacy_detect_format(F.col("content")))
    return files.select("statement_id", "_chunk", "format")


# ---------------------------------------------------------------------------
# recognition
# ---------------------------------------------------------------------------
from ..operators import recognise as R  # noqa: E402


def recognition(w: World, *names: str) -> dict[str, DataFrame]:
    """The named processors (secu, split, bank; default all) over all unposted
    summary rows; bank totals include the settlement lines."""
    chosen = {p.name for p in R.PROCESSORS if not names or p.name in names}
    return recognised(w, *stored_totals(w, bool({"secu", "bank"} & chosen), bool({"secu", "split"} & chosen)), *names)


def recognised(w: World, bank: DataFrame | None, secu: DataFrame | None, *names: str) -> dict[str, DataFrame]:
    return R.run_processors(bank, secu, w.trx_type, w.ledger_op, w.currency, w.customer_dim, checkpoint=written,
                            processors=[p for p in R.PROCESSORS if not names or p.name in names])


def linked_totals(w: World, *names: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Bank and securities summary rows and the links to their postings, written; what recognition writes
    on the way is removed."""
    bank, secu = stored_totals(w)
    with tables_removed(w.spark) as outside:
        return bank, secu, written(recognised(w, bank, secu, *names)["links"], removed_with=outside)


def _duck_first(table: str, keys: list[str], cols: list[str], order: str = "id") -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    sel = ", ".join(f"arg_min({c}, {order}) AS {c}" if c != order else f"min({c}) AS {c}" for c in cols)
    return f"SELECT {', '.join(keys)}, {sel} FROM {table} WHERE {present} GROUP BY {', '.join(keys)}"


def _duck_words(words: str, text: str, if_empty: str) -> str:
    lst = (f"list_filter(list_transform(string_split(regexp_replace({words}, ',+$', ''), ','), "
           f"lambda x: lower(trim(x))), lambda x: x <> '')")
    hit = f"(len(list_filter({lst}, lambda x: contains(lower({text}), x))) > 0)"
    return f"(CASE WHEN {words} IS NULL OR {words} = '' THEN {if_empty} ELSE coalesce({hit}, false) END)"


_REC = f"""
, bt AS (SELECT t.*, bd.swift_code_bic AS bic, s.account_type FROM bank_all_total t
         JOIN stmt s ON s.id = t.statement_id JOIN bank_dim bd ON bd.id = s.bank),
se AS (SELECT t.*, bd.swift_code_bic AS bic, s.account_type FROM secu_total t
       JOIN stmt s ON s.id = t.statement_id JOIN bank_dim bd ON bd.id = s.bank),
dem AS (SELECT *, TRY_CAST(amount AS DECIMAL(15,2)) AS a, TRY_CAST(fee AS DECIMAL(15,2)) AS f,
               TRY_CAST(total_amount AS DECIMAL(15,2)) AS tot FROM se WHERE type NOT LIKE 'split%'),
sup AS (SELECT id AS bank_id, statement_id AS b_sid, statement_reference AS b_ref, bic, currency,
               TRY_CAST(payment_amount AS DECIMAL(15,2)) AS a FROM bt),
s AS (SELECT *, row_number() OVER (PARTITION BY bic, currency, a ORDER BY b_sid, b_ref) AS rn
      FROM sup WHERE a IS NOT NULL),
ok_all AS (SELECT * FROM dem WHERE a IS NOT NULL AND (round(tot, 2) = round(a + f, 2) OR round(tot, 2) = round(a, 2))),
ask_all AS (SELECT *, row_number() OVER (PARTITION BY bic, currency, amt ORDER BY statement_id, statement_reference, slot) AS rn
            FROM (SELECT id, statement_id, statement_reference, bic, currency, 0 AS slot, a AS amt FROM ok_all
                  UNION ALL SELECT id, statement_id, statement_reference, bic, currency, 1, f FROM ok_all WHERE f IS NOT NULL)),
ok AS (SELECT * FROM ok_all WHERE id IN (  -- rows without a payment line take no fee line either
    SELECT k.id FROM ask_all k JOIN s ON k.bic = s.bic AND k.currency = s.currency AND k.amt = s.a AND k.rn = s.rn WHERE k.slot = 0)),
asks AS (SELECT *, row_number() OVER (PARTITION BY bic, currency, amt ORDER BY statement_id, statement_reference, slot) AS rn
         FROM (SELECT id, statement_id, statement_reference, bic, currency, 0 AS slot, a AS amt FROM ok
               UNION ALL SELECT id, statement_id, statement_reference, bic, currency, 1, f FROM ok WHERE f IS NOT NULL)),
got AS (SELECT k.id, k.slot, s.bank_id, s.b_sid, s.b_ref FROM asks k
        JOIN s ON k.bic = s.bic AND k.currency = s.currency AND k.amt = s.a AND k.rn = s.rn),
matches AS (
    SELECT ok.*, m.bank_id AS main_bank_id, m.b_sid AS main_bank_statement_id, m.b_ref AS main_bank_reference,
           g.bank_id AS fee_bank_id, g.b_sid AS fee_bank_statement_id, g.b_ref AS fee_bank_reference
    FROM ok JOIN got m ON m.id = ok.id AND m.slot = 0 LEFT JOIN got g ON g.id = ok.id AND g.slot = 1
    WHERE g.id IS NOT NULL OR round(tot, 2) = round(a, 2)),
secu_tt AS ({_duck_first("(SELECT * FROM trx_type WHERE statement_type = 'secu' AND asset_type = 'SCR01')",
                         ["flow_type"], ["id", "code"])}),
secu_posts AS (
    SELECT m.*, tt.id AS trx_type_id, tt.code AS transaction_type
    FROM (SELECT *, CASE WHEN a > 0 THEN 'in' ELSE 'out' END AS flow,
                 CAST(round(a + CASE WHEN fee_bank_id IS NOT NULL THEN f ELSE 0 END, 2) AS DECIMAL(18,2)) AS bank_total
          FROM matches
          WHERE round(tot, 2) = round(a + CASE WHEN fee_bank_id IS NOT NULL THEN f ELSE 0 END, 2)) m
    LEFT JOIN secu_tt tt ON tt.flow_type = m.flow),
neg AS (SELECT *, row_number() OVER (PARTITION BY transaction_date, ticker, description, currency
                                     ORDER BY statement_id, statement_reference) AS rn
        FROM se WHERE type = 'split-' AND TRY_CAST(quantity AS DECIMAL(15,6)) < 0),
pos AS (SELECT *, row_number() OVER (PARTITION BY transaction_date, ticker, description, currency
                                     ORDER BY statement_id, statement_reference) AS rn
        FROM se WHERE type = 'split+' AND TRY_CAST(quantity AS DECIMAL(15,6)) > 0),
pairs AS (SELECT neg.*, pos.id AS id_new, pos.statement_reference AS trx_reference_new,
                 pos.quantity AS quantity_new, pos.price AS price_new
          FROM neg JOIN pos ON neg.transaction_date = pos.transaction_date AND neg.ticker = pos.ticker
           AND neg.description = pos.description AND neg.currency = pos.currency AND neg.rn = pos.rn),
split_tt AS ({_duck_first("(SELECT * FROM trx_type WHERE code = 'SL')", ["code"], ["id"])}),
used AS (SELECT main_bank_id AS id FROM secu_posts UNION ALL
         SELECT fee_bank_id FROM secu_posts WHERE fee_bank_id IS NOT NULL),
ops AS (SELECT id AS source_id, statement_id, statement_reference AS trx_reference, bic,
               payment_amount AS amount, currency,
               CASE WHEN TRY_CAST(payment_amount AS DECIMAL(15,2)) > 0 THEN 'xin' ELSE 'xout' END AS type,
               currency AS asset_code, transaction_fee AS fee, payment_description AS asset,
               payment_date AS transaction_date, other_side_account, d_c, customer_id, other_side_bic,
               other_side_name AS name
        FROM bt WHERE id NOT IN (SELECT id FROM used)
          AND currency IN (SELECT code FROM currency)
          AND TRY_CAST(payment_amount AS DECIMAL(15,2)) <> 0),
reg AS ({_duck_first("customer_dim", ["registration_number"], ["id", "customer_ref"])}),
nat AS ({_duck_first("customer_dim", ["national_id"], ["id", "customer_ref"])}),
org AS ({_duck_first("customer_dim", ["org_name", "account_number"], ["id", "customer_ref"])}),
ind AS ({_duck_first("customer_dim", ["ind_business_name", "account_number"], ["id", "customer_ref"])}),
keyed AS (SELECT *, CASE WHEN length(customer_id) = 8 THEN customer_id END AS k_reg,
                 CASE WHEN length(customer_id) = 11 THEN customer_id END AS k_nat,
                 CASE WHEN NOT coalesce(length(customer_id) IN (8, 11), false) AND length(other_side_account) > 5
                      THEN other_side_account END AS k_acc
          FROM ops),
resolved AS (
    SELECT k.*, coalesce(reg.id, nat.id, org.id, ind.id) AS customer_uid,
           coalesce(reg.customer_ref, nat.customer_ref, org.customer_ref, ind.customer_ref) AS customer_ref
    FROM keyed k
    LEFT JOIN reg ON reg.registration_number = k.k_reg
    LEFT JOIN nat ON nat.national_id = k.k_nat
    LEFT JOIN org ON org.org_name = k.name AND org.account_number = k.k_acc
    LEFT JOIN ind ON ind.ind_business_name = k.name AND ind.account_number = k.k_acc),
bank_tt AS ({_duck_first("(SELECT * FROM trx_type WHERE statement_type = 'bank' AND asset_type = 'CSH01' AND is_customer = 'yes')",
                         ["flow_type"], ["id", "code"])}),
bank_posts AS (
    SELECT r.*, tt.id AS trx_type_id, tt.code AS transaction_type
    FROM resolved r
    LEFT JOIN bank_tt tt ON tt.flow_type = CASE WHEN TRY_CAST(r.amount AS DECIMAL(15,2)) > 0 THEN 'in' ELSE 'out' END
    WHERE r.customer_uid IS NOT NULL),
allp AS (
    SELECT 'secu' AS processor, id AS source_id, NULL::VARCHAR AS id_new, statement_id,
           statement_reference AS trx_reference, amount, currency, type, ticker AS asset_code, fee,
           description AS asset, transaction_date, coalesce(transaction_type, 'unclassified') AS transaction_type,
           main_bank_id, fee_bank_id
    FROM secu_posts
    UNION ALL
    SELECT 'split', p.id, p.id_new, p.statement_id, p.statement_reference, p.amount, p.currency, p.type,
           p.ticker, p.fee, p.description, p.transaction_date, coalesce(t.code, 'unclassified'), NULL, NULL
    FROM pairs p LEFT JOIN split_tt t ON true
    UNION ALL
    SELECT 'bank', source_id, NULL, statement_id, trx_reference, amount, currency, type, asset_code, fee,
           asset, transaction_date, coalesce(transaction_type, 'unclassified'), NULL, NULL
    FROM bank_posts),
allp_id AS (SELECT {O.duck_id('processor', 'source_id', "coalesce(id_new, '')")} AS posting_id, * FROM allp),
lop AS (
    SELECT posting_id, arg_min(code, ordinal) AS ledger_op
    FROM allp_id p JOIN ledger_op o ON o.basis_trx_type = p.transaction_type
    WHERE length(p.asset) > 2
      AND {_duck_words('o.included_words', 'p.asset', 'true')}
      AND NOT {_duck_words('o.excluded_words', 'p.asset', 'false')}
    GROUP BY posting_id),
postings AS (SELECT p.*, coalesce(l.ledger_op, p.type) AS posting_type, l.ledger_op
             FROM allp_id p LEFT JOIN lop l ON l.posting_id = p.posting_id),
links AS (
    SELECT source_id AS total_id, 'secu_total' AS total_table, 'secu' AS role, posting_id, transaction_type, NULL::VARCHAR AS main_id
    FROM postings WHERE processor = 'secu'
    UNION ALL SELECT main_bank_id, 'bank_total', 'secupmt', posting_id, transaction_type, NULL
    FROM postings WHERE processor = 'secu'
    UNION ALL SELECT fee_bank_id, 'bank_total', 'secufee', posting_id, transaction_type, main_bank_id
    FROM postings WHERE processor = 'secu' AND fee_bank_id IS NOT NULL
    UNION ALL SELECT source_id, 'secu_total', 'split-', posting_id, transaction_type, NULL
    FROM postings WHERE processor = 'split'
    UNION ALL SELECT id_new, 'secu_total', 'split+', posting_id, transaction_type, NULL
    FROM postings WHERE processor = 'split'
    UNION ALL SELECT source_id, 'bank_total', 'bankop', posting_id, transaction_type, NULL
    FROM postings WHERE processor = 'bank')
"""


def _rec_sql(body: str) -> str:
    names = ["bank_all_total", "secu_total", "stmt", "bank_dim", "customer_dim", "trx_type", "ledger_op", "currency"]
    base = O.with_views(names, "SELECT 1")
    return base[: -len("SELECT 1")].rstrip() + _REC + body


@query("match_payment_main", _rec_sql("""
SELECT id, statement_id, statement_reference, main_bank_id, main_bank_statement_id, main_bank_reference FROM matches"""))
def q_match_payment_main(spark, sf_dir):
    m = recognition(World(spark, sf_dir), "secu")["matches"]
    return m.select("id", "statement_id", "statement_reference", "main_bank_id", "main_bank_statement_id",
                    "main_bank_reference")


@query("match_payment_fee", _rec_sql("""
SELECT id, fee_bank_id, fee_bank_statement_id, fee_bank_reference FROM matches WHERE fee_bank_id IS NOT NULL"""))
def q_match_payment_fee(spark, sf_dir):
    m = recognition(World(spark, sf_dir), "secu")["matches"]
    return m.filter(F.col("fee_bank_id").isNotNull()).select("id", "fee_bank_id", "fee_bank_statement_id",
                                                             "fee_bank_reference")


@query("recognise_secu", _rec_sql("""
SELECT id AS source_id, statement_id, statement_reference AS trx_reference, transaction_type,
       CAST(bank_total AS VARCHAR) AS bank_total, main_bank_reference AS bank_reference,
       fee_bank_reference AS fee_reference, amount, fee, total_amount FROM secu_posts"""))
def q_recognise_secu(spark, sf_dir):
    p = recognition(World(spark, sf_dir), "secu")["secu_posts"]
    return p.select("source_id", "statement_id", "trx_reference", "transaction_type", "bank_total",
                    "bank_reference", "fee_reference", "amount", "fee", "total_amount")


@query("pair_splits", _rec_sql("""
SELECT id, id_new, statement_id, statement_reference, trx_reference_new, quantity, quantity_new, price_new
FROM pairs"""))
def q_pair_splits(spark, sf_dir):
    p = recognition(World(spark, sf_dir), "split")["pairs"]
    return p.select("id", "id_new", "statement_id", "statement_reference", "trx_reference_new", "quantity",
                    "quantity_new", "price_new")


@query("bank_ops_union", _rec_sql("SELECT source_id, statement_id, trx_reference, type, amount, currency FROM ops"))
def q_bank_ops_union(spark, sf_dir):
    o = recognition(World(spark, sf_dir), "secu", "bank")["ops"]
    return o.select("source_id", "statement_id", "trx_reference", "type", "amount", "currency")


@query("resolve_customer", _rec_sql("SELECT source_id, customer_uid, customer_ref FROM resolved"))
def q_resolve_customer(spark, sf_dir):
    return recognition(World(spark, sf_dir), "secu", "bank")["resolved"].select("source_id", "customer_uid", "customer_ref")


@query("classify_trx_type", _rec_sql("""
SELECT source_id, trx_type_id, transaction_type FROM bank_posts"""))
def q_classify_trx_type(spark, sf_dir):
    return recognition(World(spark, sf_dir), "secu", "bank")["bank_posts"].select("source_id", "trx_type_id", "transaction_type")


@query("classify_ledger_op", _rec_sql("SELECT posting_id, processor, transaction_type, ledger_op FROM postings"))
def q_classify_ledger_op(spark, sf_dir):
    return recognition(World(spark, sf_dir))["postings"].select("posting_id", "processor", "transaction_type",
                                                                "ledger_op")


@query("postings", _rec_sql("""
SELECT posting_id, processor, source_id, id_new, statement_id, trx_reference, transaction_type,
       posting_type AS type, amount, currency, asset_code, fee, asset, transaction_date FROM postings"""))
def q_postings(spark, sf_dir):
    p = recognition(World(spark, sf_dir))["postings"]
    return p.select("posting_id", "processor", "source_id", "id_new", "statement_id", "trx_reference",
                    "transaction_type", "type", "amount", "currency", "asset_code", "fee", "asset",
                    "transaction_date")


@query("posting_links", _rec_sql("SELECT total_id, total_table, role, posting_id, transaction_type, main_id FROM links"))
def q_posting_links(spark, sf_dir):
    return recognition(World(spark, sf_dir))["links"]


_POSTED = """
, one AS (SELECT total_table, total_id, min(posting_id) AS posting_id FROM links GROUP BY total_table, total_id),
l AS (SELECT k.total_table, k.total_id, k.posting_id, arg_min(role, role) AS role, arg_min(transaction_type, role) AS transaction_type,
             arg_min(main_id, role) AS main_id
      FROM links k JOIN one USING (total_table, total_id, posting_id) GROUP BY ALL)
"""


@query("posted_view_bank", _rec_sql(_POSTED + """
SELECT t.id, l.posting_id AS acc_post_id, l.transaction_type, CASE WHEN l.posting_id IS NOT NULL THEN 'posted' ELSE t.status END AS status,
       CASE WHEN l.role IN ('secupmt', 'secufee') THEN l.role END AS type, l.main_id AS main_bank_total_trx
FROM bt t LEFT JOIN l ON l.total_table = 'bank_total' AND l.total_id = t.id"""))
def q_posted_view_bank(spark, sf_dir):
    """Bank rows as the reference keeps them after recognition."""
    bank, _, links = linked_totals(World(spark, sf_dir))
    return R.posted_in_slices(bank.select("id", "status"), links, "bank_total").select(
        "id", "acc_post_id", "transaction_type", "status", "type", "main_bank_total_trx")


@query("posted_view_secu", _rec_sql(_POSTED + """
SELECT t.id, l.posting_id AS acc_post_id, l.transaction_type, CASE WHEN l.posting_id IS NOT NULL THEN 'posted' ELSE t.status END AS status,
       p.total_id AS bank_payment_trx_id, f.total_id AS bank_fee_trx_id
FROM se t LEFT JOIN l ON l.total_table = 'secu_total' AND l.total_id = t.id
LEFT JOIN links p ON p.posting_id = l.posting_id AND p.role = 'secupmt'
LEFT JOIN links f ON f.posting_id = l.posting_id AND f.role = 'secufee'"""))
def q_posted_view_secu(spark, sf_dir):
    """Securities rows with their bank payment and fee lines."""
    _, secu, links = linked_totals(World(spark, sf_dir), "secu", "split")
    return R.posted_in_slices(secu.select("id", "status"), links, "secu_total").select(
        "id", "acc_post_id", "transaction_type", "status", "bank_payment_trx_id", "bank_fee_trx_id")


@query("unposted_bank", _rec_sql("""
SELECT id, statement_id, statement_reference FROM bt WHERE id NOT IN (SELECT total_id FROM links WHERE total_table = 'bank_total')"""))
def q_unposted_bank(spark, sf_dir):
    """what a second run would still find unposted."""
    bank, _, links = linked_totals(World(spark, sf_dir))
    return R.unposted(bank, links).select("id", "statement_id", "statement_reference")


# ---------------------------------------------------------------------------
# consolidation variants (G8-G13), formats (P21), references
# ---------------------------------------------------------------------------
from pyspark.sql.types import DecimalType  # noqa: E402

from ..functions import money_text, price_text, statement_ref_prefix, strip_zeros  # noqa: E402

_SKEYS = ", ".join(C.SECU_KEYS)
_BKEYS = ", ".join(C.BANK_KEYS)


def _txt(col, t="38,2"):
    p, s = t.split(",")
    return col.cast(DecimalType(int(p), int(s))).cast("string")


@query("consolidate_legacy_secu", O.with_views(["secu_raw"], f"""
SELECT statement_id, {_SKEYS},
       CAST(SUM({O.dec('quantity', 38, 10)}) AS VARCHAR) AS quantity,
       {O.avg_text(O.dec('price', 38, 10), 10, 2)} AS price,
       CAST(CAST(round(SUM({O.dec('amount', 38, 10)}), 2) AS DECIMAL(38,2)) AS VARCHAR) AS amount,
       CAST(CAST(round(SUM({O.dec('fee', 38, 10)}), 2) AS DECIMAL(38,2)) AS VARCHAR) AS fee,
       CAST(CAST(round(SUM({O.dec('total_amount', 38, 10)}), 2) AS DECIMAL(38,2)) AS VARCHAR) AS total_amount
FROM secu_raw GROUP BY statement_id, {_SKEYS}"""))
def q_consolidate_legacy_secu(spark, sf_dir):
    g = C.legacy_secu(staged_secu(World(spark, sf_dir)))
    return g.select("statement_id", *C.SECU_KEYS, _txt(F.col("quantity"), "38,10").alias("quantity"),
                    *[_txt(F.col(c)).alias(c) for c in ("price", "amount", "fee", "total_amount")])


@query("consolidate_legacy_bank", O.with_views(["bank_raw"], f"""
SELECT statement_id, {_BKEYS},
       CAST(CAST(round(SUM({O.dec('payment_amount', 38, 10)}), 2) AS DECIMAL(38,2)) AS VARCHAR) AS payment_amount,
       CAST(CAST(round(SUM({O.dec('transaction_fee', 38, 10)}), 2) AS DECIMAL(38,2)) AS VARCHAR) AS transaction_fee
FROM bank_raw GROUP BY statement_id, {_BKEYS}"""))
def q_consolidate_legacy_bank(spark, sf_dir):
    g = C.legacy_bank(staged_bank(World(spark, sf_dir)))
    return g.select("statement_id", *C.BANK_KEYS, _txt(F.col("payment_amount")).alias("payment_amount"),
                    _txt(F.col("transaction_fee")).alias("transaction_fee"))


_DESIGN_BANK_KEYS = "statement_id, account_number, payment_date, other_side_account, other_side_name, d_c, currency, reference_number"


@query("consolidate_bank_design", O.with_views(["bank_raw"], f"""
SELECT {_DESIGN_BANK_KEYS},
       CAST(SUM({O.dec('payment_amount')}) AS VARCHAR) AS payment_amount,
       CAST(SUM({O.dec('transaction_fee')}) AS VARCHAR) AS transaction_fee,
       min(document_nr) AS document_nr, min(payment_description) AS payment_description,
       min(customer_id) AS customer_id, min(other_side_bic) AS other_side_bic,
       min(other_side_bank) AS other_side_bank, count(*) AS transaction_count
FROM bank_raw GROUP BY {_DESIGN_BANK_KEYS}"""))
def q_consolidate_bank_design(spark, sf_dir):
    g = C.design_bank(staged_bank(World(spark, sf_dir)))
    return (g.withColumn("payment_amount", F.col("payment_amount").cast("string"))
            .withColumn("transaction_fee", F.col("transaction_fee").cast("string")))


@query("consolidate_secu_design", O.with_views(["secu_raw"], f"""
SELECT statement_id, {_SKEYS},
       CAST(SUM({O.dec('quantity', 15, 4)}) AS VARCHAR) AS quantity,
       {O.avg_text(O.dec('price', 15, 6), 6, 10)} AS price,
       CAST(SUM({O.dec('amount')}) AS VARCHAR) AS amount,
       CAST(SUM({O.dec('fee')}) AS VARCHAR) AS fee,
       CAST(SUM({O.dec('total_amount')}) AS VARCHAR) AS total_amount,
       string_agg(reference, '; ' ORDER BY reference) AS reference,
       min(comment) AS comment, count(*) AS transaction_count
FROM secu_raw GROUP BY statement_id, {_SKEYS}"""))
def q_consolidate_secu_design(spark, sf_dir):
    w = World(spark, sf_dir)
    largest = w.most_rows("secu")
    g = C.design_secu(stored_raw(staged_secu(w), [*C.SECU_KEYS, *SECU_SUMMED, "comment"], largest), largest=largest)
    for c in ("quantity", "price", "amount", "fee", "total_amount"):
        g = g.withColumn(c, F.col(c).cast("string"))
    return g


@query("consolidate_vwap", O.with_views(["secu_raw"], f"""
SELECT statement_id, {_SKEYS}, CAST(amount AS VARCHAR) AS amount, CAST(quantity AS VARCHAR) AS quantity,
       CASE WHEN quantity = 0 THEN NULL ELSE
         (CASE WHEN quantity < 0 AND u > 0 THEN '-' ELSE '' END) || CAST(u // 100000000 AS VARCHAR)
         || '.' || lpad(CAST(u % 100000000 AS VARCHAR), 8, '0') END AS vwap
FROM (SELECT *, CASE WHEN quantity = 0 THEN NULL ELSE
        (CAST(abs(amount) * 100 AS HUGEINT) * 100000000000000 * 2 + CAST(abs(quantity) * 1000000 AS HUGEINT) * 100)
        // (2 * CAST(abs(quantity) * 1000000 AS HUGEINT) * 100) END AS u
      FROM (SELECT statement_id, {_SKEYS}, SUM({O.dec('amount')}) AS amount, SUM({O.dec('quantity', 15, 6)}) AS quantity
            FROM secu_raw GROUP BY statement_id, {_SKEYS}))"""))
def q_consolidate_vwap(spark, sf_dir):
    g = C.vwap(staged_secu(World(spark, sf_dir)))
    return g.select("statement_id", *C.SECU_KEYS, F.col("amount").cast("string").alias("amount"),
                    F.col("quantity").cast("string").alias("quantity"), F.col("vwap"))


@query("statement_refs", O.with_views(["stmt"], """
SELECT id AS statement_id, 'STMT' || substr(from_date, 1, 4) AS prefix,
       printf('%s.%03d', 'STMT' || substr(from_date, 1, 4), 1) AS first_reference FROM stmt"""))
def q_statement_refs(spark, sf_dir):
    from ..functions import statement_ref
    st = World(spark, sf_dir).stmt
    pre = statement_ref_prefix(F.col("from_date"))
    return st.select(F.col("id").alias("statement_id"), pre.alias("prefix"),
                     statement_ref(pre, F.lit(1)).alias("first_reference"))


@query("format_amounts", O.with_views(["secu_total"], """
SELECT id, regexp_replace(regexp_replace(quantity, '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '') AS quantity,
       CAST(CAST(amount AS DECIMAL(38,2)) AS VARCHAR) AS amount,
       CAST(CAST(round(CAST(price AS DECIMAL(38,12)), 6) AS DECIMAL(38,6)) AS VARCHAR) AS price
FROM secu_total"""))
def q_format_amounts(spark, sf_dir):
    t = secu_totals(World(spark, sf_dir))
    return t.select("id", strip_zeros(F.col("quantity")).alias("quantity"), money_text(F.col("amount")).alias("amount"),
                    price_text(F.col("price")).alias("price"))


# ---------------------------------------------------------------------------
# control log (K6-K9), quality (F16, G14), top-k
# ---------------------------------------------------------------------------
from ..operators import control as K  # noqa: E402
from ..operators import quality as Q  # noqa: E402


def world_events(w: World) -> DataFrame:
    """The import log the statuses imply: 'imported' statements went
    new -> importing -> imported, 'error' ones importing -> error ('new' ones
    have not run).  Error messages carry the statement's full detail text."""
    st = w.stmt.filter(F.col("status") != "new").select(F.col("id").alias("statement_id"), "status", "import_seq")
    seq = F.col("import_seq").cast("long") * 10
    detail = F.concat(F.lit("Import failed for "), F.col("statement_id"), F.lit(": "),
                      F.repeat(F.lit("amount column is not numeric; "), 40))
    first = K.events(st, "import", "importing", seq + 1)
    second = K.events(st, "import", F.col("status"), seq + 2, message=F.when(F.col("status") == "error", detail))
    return first.unionByName(second)


_DUCK_EVENTS = """
, ev AS (
    SELECT id AS statement_id, CAST(import_seq AS BIGINT) * 10 + 1 AS event_seq, 'importing' AS status, NULL AS message
    FROM stmt WHERE status <> 'new'
    UNION ALL
    SELECT id, CAST(import_seq AS BIGINT) * 10 + 2, status,
           CASE WHEN status = 'error' THEN 'Import failed for ' || id || ': ' || repeat('amount column is not numeric; ', 40) END
    FROM stmt WHERE status <> 'new')
"""


def _ev_sql(body: str) -> str:
    base = O.with_views(["stmt"], "SELECT 1")
    return base[: -len("SELECT 1")].rstrip() + _DUCK_EVENTS + body


@query("status_timeline", _ev_sql("""
SELECT statement_id, event_seq, status,
       coalesce(lag(status) OVER (PARTITION BY statement_id ORDER BY event_seq), 'new') AS previous_status,
       (status = 'error' OR (coalesce(lag(status) OVER (PARTITION BY statement_id ORDER BY event_seq), 'new'), status)
        IN (('new','importing'), ('importing','imported'), ('imported','consolidating'),
            ('consolidating','consolidated'), ('imported','importing'), ('consolidated','consolidating'),
            ('consolidated','importing'), ('error','importing'), ('error','consolidating'))) AS allowed
FROM ev"""))
def q_status_timeline(spark, sf_dir):
    w = World(spark, sf_dir)
    initial = w.stmt.select("id", F.lit("new").alias("status"))
    tl = K.status_timeline(world_events(w), initial)
    return tl.select("statement_id", "event_seq", "status", "previous_status", "allowed")


@query("error_events", _ev_sql("""
SELECT statement_id, 'error' AS status, substr(message, 1, 1000) AS message, length(substr(message, 1, 1000)) AS message_length
FROM ev WHERE status = 'error'"""))
def q_error_events(spark, sf_dir):
    ev = world_events(World(spark, sf_dir)).filter(F.col("status") == "error")
    e = K.error_events(ev, "import", 0)
    return e.select("statement_id", "status", "message", F.length("message").cast("long").alias("message_length"))


@query("import_metadata", _fold_sql("""
, rows AS (SELECT statement_id, {key} AS dedup_key FROM secu_in)
SELECT r.statement_id, count(*) AS row_count, CAST(count_if(k.statement_id IS NULL) AS BIGINT) AS duplicate_count
FROM rows r LEFT JOIN kept k ON k.statement_id = r.statement_id AND k.dedup_key = r.dedup_key
GROUP BY r.statement_id""".replace("{key}", _duck_key(_SECU_PK, _SECU_PARTS, True))))
def q_import_metadata(spark, sf_dir):
    """K6 + G6: row_count counts every parsed row (Q5), duplicates after J6."""
    w = World(spark, sf_dir)
    verdict = D.bulk_dedup(w.secu_in, w.stmt, "secu")
    _, counts = D.apply_bulk_dedup(w.secu_in, verdict, "secu")
    return counts.select("statement_id", "row_count", "duplicate_count")


@query("quality_nulls", O.with_views(["bank_raw"], """
SELECT statement_id, count(*) AS rows,
       CAST(count_if(account_number IS NULL OR payment_date IS NULL OR d_c IS NULL OR payment_amount IS NULL
                OR currency IS NULL) AS BIGINT) AS missing_mandatory,
       CAST(count_if(payment_amount LIKE '-%' AND d_c <> 'D') AS BIGINT) AS negative_not_debit,
       CAST(count_if(payment_amount LIKE '%,%') AS BIGINT) AS decimal_comma
FROM bank_raw GROUP BY statement_id"""))
def q_quality_nulls(spark, sf_dir):
    return Q.bank_checks(staged_bank(World(spark, sf_dir)))


@query("quality_sign", O.with_views(["secu_raw"], """
SELECT statement_id, count(*) AS rows,
       CAST(count_if(value_date IS NULL OR transaction_date IS NULL OR type IS NULL OR quantity IS NULL
                OR amount IS NULL OR currency IS NULL) AS BIGINT) AS missing_mandatory,
       CAST(count_if(amount LIKE '%,%') AS BIGINT) AS decimal_comma
FROM secu_raw GROUP BY statement_id"""))
def q_quality_sign(spark, sf_dir):
    return Q.secu_checks(staged_secu(World(spark, sf_dir)))


@query("count_by_currency", O.with_views(["secu_total"], """
SELECT statement_id, status, currency, count(*) AS n FROM secu_total GROUP BY statement_id, status, currency"""))
def q_count_by_currency(spark, sf_dir):
    return Q.counts_by(secu_totals(World(spark, sf_dir)), "statement_id", "status", "currency")


@query("topk_amounts", O.with_views(["bank_total"], """
SELECT statement_id, statement_reference, payment_amount, rank FROM (
    SELECT statement_id, statement_reference, payment_amount,
           row_number() OVER (PARTITION BY statement_id ORDER BY payment_amount DESC, statement_reference) AS rank
    FROM bank_total) WHERE rank <= 5"""))
def q_topk_amounts(spark, sf_dir):
    """Five largest amounts per statement in text order (as the design's
    verification query sorts the stored text)."""
    t = bank_totals(World(spark, sf_dir)).select("statement_id", "statement_reference", "payment_amount")
    top = Q.top_k_within(t, ["statement_id"], [F.col("payment_amount").desc(), F.col("statement_reference")], 5)
    return top.withColumn("rank", F.col("rank").cast("long"))


@query("latest_first_references", O.with_views(["bank_total"], """
SELECT statement_id, statement_reference, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY account_number ORDER BY statement_reference) AS rank FROM (
        SELECT DISTINCT t.statement_id, t.account_number, t.statement_reference, t.payment_date,
               max(t.statement_id) OVER (PARTITION BY t.account_number) AS latest FROM bank_total t)
    WHERE statement_id = latest) WHERE rank <= 5"""))
def q_latest_first_references(spark, sf_dir):
    """The first five references of each account's latest statement."""
    t = bank_totals(World(spark, sf_dir)).select("account_number", "statement_id", "statement_reference")
    last = t.groupBy("account_number").agg(F.max("statement_id").alias("statement_id"))
    top = Q.top_k_within(t.join(last, ["account_number", "statement_id"]), ["account_number"], [F.col("statement_reference")], 5)
    return top.select("statement_id", "statement_reference", F.col("rank").cast("long").alias("rank"))


@query("legacy_totals_numbered", O.with_views(["secu_raw", "stmt"], f"""
, g AS (SELECT statement_id, {_SKEYS} FROM secu_raw GROUP BY ALL)
SELECT g.*, 'STMT' || substr(s.from_date, 1, 4) || '.' || printf('%03d', row_number() OVER (
           PARTITION BY statement_id ORDER BY {', '.join(k + ' NULLS FIRST' for k in C._sort_order(C.SECU_SORT, C.SECU_KEYS))})) AS statement_reference
FROM g JOIN stmt s ON s.id = g.statement_id"""))
def q_legacy_totals_numbered(spark, sf_dir):
    """K12 + W5: legacy totals with one sequence per statement and their reference."""
    w = World(spark, sf_dir)
    numbered = C.number_totals(C.legacy_secu(staged_secu(w)), w.secu_stmt, C.SECU_SORT, C.SECU_KEYS)
    return numbered.select("statement_id", *C.SECU_KEYS, "statement_reference")
