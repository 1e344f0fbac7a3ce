"""Steps that read or shuffle their rows once."""

import contextlib
import io
import os
import threading
import time

from pyspark.sql import functions as F

from ledgerlake import session
from ledgerlake.functions import java_trim, ordered_text, statement_ref, zero_pad
from ledgerlake.operators import consolidate as C
from ledgerlake.operators.numbering import number_within
from ledgerlake.operators.stage import _by_fields, number_rows
from ledgerlake.session import SHUFFLE_CLEANUP, ensure_checkpoint_dir, tables_removed, written, written_in_slices
from ledgerlake.sources import csv_statements as CSV

SF_SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_numbering_of_nullable_keys_deals_the_rows_once(spark):
    df = spark.createDataFrame([(None, 3), ("a", 2), ("a", 1), (None, 1)], "g string, at int")
    numbered = number_within(df, ["g"], [F.col("at")], [F.col("at") % 1], out="n")
    assert "hashpartitioning(coalesce(" not in _plan(numbered)
    assert sorted(numbered.collect(), key=str) == sorted([(None, 1, 1), (None, 3, 2), ("a", 1, 1), ("a", 2, 2)], key=str)


def test_totals_are_numbered_from_written_groups(spark):
    keys = {k: F.lit("x") for k in C.SECU_KEYS}
    raw = spark.range(6).select(F.lit("s").alias("statement_id"), F.col("id").cast("string").alias("ref"), *[c.alias(k) for k, c in keys.items()])
    groups = raw.groupBy("statement_id", *C.SECU_KEYS).agg(F.count(F.lit(1)).alias("n"))
    statements = spark.createDataFrame([("s", "2024-01-01")], "id string, from_date string")
    numbered = C.number_totals(groups, statements, C.SECU_SORT, C.SECU_KEYS)
    assert "count(1) AS n" not in _plan(numbered) and "Range (" not in _plan(numbered)
    assert [(r["n"], r["statement_reference"]) for r in numbered.collect()] == [(6, "STMT2024.001")]


def test_groups_without_a_cut_take_one_aggregate(spark):
    raw = spark.range(400).select(F.when(F.col("id") < 300, "big").alias("g"), F.format_string("%04d", 399 - F.col("id")).alias("at"),
                                  F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("v"), F.lit(1.5).cast("decimal(15,2)").alias("d"))
    args = (["g"], "v", "at", {"d": F.col("d")}, {"avg": (F.col("d"), 2)})
    ranges = C.group_with_list(raw, *args, count="n", part_rows=100)
    at_once = C.group_with_list(raw, *args, count="n", largest=400, part_rows=400)
    assert ranges.schema.simpleString() == at_once.schema.simpleString()
    assert sorted(ranges.collect(), key=str) == sorted(at_once.collect(), key=str)
    assert "existence" not in _plan(ranges) and "LeftAnti" in _plan(ranges)


def test_ordered_text_is_listagg_without_it(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, ""), ("a", None, "n"), ("a", 3, None), ("b", 1, None)], "g string, o int, v string")
    got = df.groupBy("g").agg(ordered_text("v", "o", ",").alias("t"))
    assert dict(got.collect()) == {"a": "n,,x", "b": None}
    rows = spark.createDataFrame([("s", 2, 'q"q'), ("s", 1, None)], "g string, pos int, c string")
    files = CSV.render_csv(rows, ["c"], ["h"], ",", ["g"], "pos")
    assert "listagg" not in _plan(files)
    assert files.first()["content"] == '﻿"h"\r\n""\r\n"q""q"\r\n'


def test_trim_and_header_without_scans(spark):
    texts = ["", " a ", "\x00\x1f\n", " b\t", "c \u0085", " ", "d\r\n", None, "e  "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    old = F.regexp_replace("t", r"^[\x00-\x20]+|[\x00-\x20]+$", "")
    assert df.filter(~java_trim("t").eqNullSafe(old)).isEmpty()
    heads = spark.createDataFrame([("﻿﻿a\nb",), ("\r\na",), ("a;b",), ("﻿",), ("",), (None,)], "t string")
    assert [tuple(r) for r in heads.select(CSV.header_line(F.col("t")), CSV.strip_bom(F.col("t"))).collect()] == [
        ("﻿a", "﻿a\nb"), ("", "\r\na"), ("a;b", "a;b"), ("", ""), (None, ""), (None, None)]


def _shuffle_files(spark) -> set[str]:
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for f in disk.getAllFiles().mkString("\n").split("\n") if "shuffle_" in f}


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    table = written(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.count(F.lit(1)).alias("n")))
    until = time.time() + 20
    while (left := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == "false"
    assert sorted(table.collect()) == sorted(written(table.repartition(3)).join(table, ["k", "n"]).collect())
    assert table.agg(F.sum("n")).first()[0] == 1000


def _tables(spark) -> set[str]:
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {f for f in os.listdir(folder) if f.startswith("table-")}


def test_slices_leave_their_result_alone(spark):
    before = _tables(spark)
    with tables_removed(spark) as outside:
        rows = written(spark.range(10))
        most = []

        def build(i):
            part = written(rows.filter(F.col("id") % 3 == i))
            most.append(len(_tables(spark) - before))
            return part.join(written(part), "id")
        inner = written_in_slices(spark, 3, build)
        with tables_removed(spark) as around:
            kept = written_in_slices(spark, 1, lambda _: inner, around)
            stays = written_in_slices(spark, 1, lambda _: kept, outside)
        assert sorted(r["id"] for r in kept.collect()) == list(range(10))
    assert most == [2, 3, 3] and len(_tables(spark) - before) == 1
    assert sorted(r["id"] for r in stays.collect()) == list(range(10))


def test_matches_in_slices_are_those_of_one(spark, monkeypatch):
    from ledgerlake.operators import recognise as R
    bank = spark.createDataFrame([(f"b{i:02}", f"B{i % 3}", f"R{i:02}", "A" if i % 5 else None, "EUR", f"{-(i % 7)}.00") for i in range(40)],
                                 "id string, statement_id string, statement_reference string, bic string, currency string, payment_amount string")
    rows = [(f"s{i:02}", f"S{i % 2}", f"Q{i:02}", "A", "EUR", "ost", f"{-(i % 7)}.00", f"{-(i % 2)}.00", f"{-(i % 7) - i % 2}.00") for i in range(30)]
    secu = spark.createDataFrame(rows, "id string, statement_id string, statement_reference string, bic string, currency string, type string, amount string, "
                                       "fee string, total_amount string").withColumns({c: F.lit("x") for c in (
                                           "ticker", "description", "transaction_date", "quantity", "price", "value_date")})
    types = spark.createDataFrame([("1", "SECBUY", "secu", "out", "SCR01", None)], "id string, code string, statement_type string, flow_type string, "
                                  "asset_type string, is_customer string")
    pool = {"secu": secu, "bank": bank, "trx_types": types, "legacy_fee_rule": False, "cut": written}
    whole = sorted(map(str, R._secu_processor(pool)[1]["matches"].collect()))
    before = _tables(spark)
    monkeypatch.setattr(session, "SLICE_ROWS", 60)
    sliced = R._secu_processor(pool)[1]["matches"]
    assert whole and sorted(map(str, sliced.collect())) == whole
    assert len(_tables(spark) - before) == 2        # matches and postings


def test_files_are_collected_once_and_read_for_their_header_once(spark):
    rows = spark.createDataFrame([("s", 2, "x"), ("s", 1, "y"), (None, 1, None)], "g string, pos int, c string")
    files = CSV.render_csv(rows, ["c"], ["Kliendi konto", "Dok nr", "Makse kuupäev"], ";", ["g"], "pos", bom=False)
    plan = _plan(files)     # printed from the last step to the first
    assert plan.index("partial_collect_list") < plan.index("Exchange hashpartitioning(g")
    head = '"Kliendi konto";"Dok nr";"Makse kuupäev"\r\n'
    assert sorted(files.collect(), key=str) == sorted([("s", head + '"y"\r\n"x"\r\n'), (None, head + '""\r\n')], key=str)
    for detect in (CSV.legacy_detect_format, CSV.detect_format):
        found = files.select(detect(F.col("content")).alias("format"))
        assert _plan(found).count("regexp_extract(") <= 1
        assert [r["format"] for r in found.collect()] == ["SWEDBANK"] * 2


def test_slices_read_their_months_alone(spark, tmp_path, monkeypatch):
    import datetime as dt

    from ledgerlake.plans.bindings import World
    months = [dt.datetime(2024, 1, 3), dt.datetime(2024, 1, 20), dt.datetime(2024, 2, 7), dt.datetime(2024, 3, 8), None]
    for name, rows, schema in (
            ("region", [(0, "R"), (1, "S")], "r_regionkey int, r_name string"), ("nation", [(0, "N", 0), (1, "M", 1)], "n_nationkey int, n_name string, n_regionkey int"),
            ("customer", [(0, "c0", 0, "BUILDING"), (1, "c1", 1, "AUTOMOBILE")], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
            ("supplier", [(0, 0), (1, 1)], "s_suppkey long, s_nationkey int"),
            ("part", [(0, "p", "B", "T", 1.0)], "p_partkey long, p_name string, p_brand string, p_type string, p_retailprice double"),
            ("orders", [(i, i % 2, "F", 5.0, at, "1-URGENT") for i, at in enumerate(months * 2)],
             "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
            ("lineitem", [(i, 0, i % 2, 1, 1.0, 5.0, 0.0, 0.1, "A", "F", at) for i, at in enumerate(months * 2)],
             "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
             "l_returnflag string, l_linestatus string, l_shipdate timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = World(spark, str(tmp_path))
    monkeypatch.setattr(session, "SLICE_ROWS", 14)
    before = _tables(spark)
    slices = whole.slices()
    assert len(slices) == 3 and len(_tables(spark) - before) == 2     # the statements alone, no copy of all rows
    for name in ("bank_all_in", "secu_in"):
        want, parts = getattr(whole, name).collect(), [getattr(s, name).collect() for s in slices]
        assert want and sorted(map(str, want)) == sorted(str(r) for p in parts for r in p)
        assert all(not {r["statement_id"] for r in p} & {r["statement_id"] for q in parts if q is not p for r in q} for p in parts)
    assert sorted(s.t("orders").count() for s in slices) == [2, 4, 6]     # days of Feb; Dec, Mar; Jan


def test_places_share_no_line_and_are_all_met(spark, monkeypatch):
    from ledgerlake.operators import recognise as R
    bank = spark.createDataFrame([(f"b{i}", f"A{i % 4}") for i in range(40)] + [("n", None)], "id string, bic string").withColumn("currency", F.lit("EUR"))
    assert R._places(bank) == [(None, 41)] and R._places(bank.filter("id = ''")) == [(None, 0)]
    monkeypatch.setattr(session, "SLICE_ROWS", 20)
    places = R._places(bank)
    assert len(places) > 2 and sum(n for _, n in places) == 41
    assert [bank.filter(p).count() for p, _ in places] == [n for _, n in places]


def test_postings_in_slices_are_those_of_one(spark, monkeypatch):
    from ledgerlake.operators import recognise as R
    bank = spark.createDataFrame([(f"b{i:02}", "B", f"R{i:02}", "A", "EUR", f"{i % 5 - 2}.00", "0", f"{i % 3:08}", "d", "12345678", "n", "C", "x", "y") for i in range(40)],
                                 "id string, statement_id string, statement_reference string, bic string, currency string, payment_amount string, transaction_fee string, "
                                 "customer_id string, payment_description string, other_side_account string, other_side_name string, d_c string, other_side_bic string, "
                                 "payment_date string")
    rows = [(f"s{i:02}", "S", f"Q{i:02}", "A", "EUR", "split-" if i % 2 else "split+", f"{'-' * (i % 2)}1", f"t{i % 6 // 2}") for i in range(30)]
    secu = spark.createDataFrame(rows, "id string, statement_id string, statement_reference string, bic string, currency string, type string, quantity string, "
                                       "ticker string").withColumns({c: F.lit("x") for c in (
                                           "description", "transaction_date", "price", "value_date", "amount", "fee", "total_amount")})
    customers = spark.createDataFrame([("C1", "R1", "00000001", None, None, None, "a"), ("C2", "R2", None, None, "n", None, "12345678")],
                                      "id string, customer_ref string, registration_number string, national_id string, org_name string, ind_business_name string, "
                                      "account_number string")
    pool = {"secu": secu, "bank": bank, "offered": bank, "currencies": spark.createDataFrame([("EUR",)], "code string"), "customers": customers, "cut": written,
            "trx_types": spark.createDataFrame([("1", "IN", "bank", "in", "CSH01", "yes"), ("2", "SL", "secu", None, "SCR01", None)],
                                               "id string, code string, statement_type string, flow_type string, asset_type string, is_customer string")}
    links = spark.createDataFrame([(f"s{i:02}", "secu_total", "secu", f"p{i}", "T", None) for i in range(0, 30, 3)]
                                  + [(f"b{i:02}", "bank_total", "secupmt" if i % 2 else "secufee", f"p{i - i % 2}", "T", None) for i in range(40)],
                                  "total_id string, total_table string, role string, posting_id string, transaction_type string, main_id string")
    totals = {"bank_total": bank.select("id", F.lit("new").alias("status")), "secu_total": secu.select("id", F.lit("new").alias("status"))}

    def results():
        found = R._split_processor(pool)[1] | R._bank_processor(pool)[1] | {t: R.posted_in_slices(rows, links, t) for t, rows in totals.items()}
        return {k: (found[k].columns, sorted(map(str, found[k].collect()))) for k in ("pairs", "ops", "resolved", "bank_posts", *totals)}
    before = _tables(spark)
    whole = results()
    assert _tables(spark) == before and all(rows for _, rows in whole.values())
    monkeypatch.setattr(session, "SLICE_ROWS", 25)
    assert results() == whole
    assert len(_tables(spark) - before) == 4        # pairs, resolved and two views


def test_configuration_is_sent_to_the_rows(spark):
    from ledgerlake.operators import recognise as R
    bank = spark.range(3).select(*[F.col("id").cast("string").alias(c) for c in (
        "id", "statement_id", "statement_reference", "bic", "payment_amount", "currency", "transaction_fee", "payment_description", "payment_date",
        "other_side_account", "d_c", "customer_id", "other_side_bic", "other_side_name")])
    ops = R.bank_operations(bank, spark.createDataFrame([("1",), ("2",)], "code string"))
    assert "hashpartitioning(currency" not in _plan(ops).split("BroadcastExchange")[0] and ops.count() == 2
    ledger = spark.createDataFrame([("1", "a", "n", "T", "", "", 1)], "id string, code string, name string, basis_trx_type string, included_words string, "
                                                                        "excluded_words string, ordinal int")
    posts = R.classify_ledger_op(ops.withColumn("transaction_type", F.lit("T")).withColumn("asset", F.lit("abc")), ledger)
    assert "SortMergeJoin" not in _plan(posts) and [r["ledger_op"] for r in posts.collect()] == ["a", "a"]


def test_slices_are_few_and_compare_dates_with_their_days(spark, monkeypatch):
    from ledgerlake.plans.bindings import World
    monkeypatch.setattr(session, "SLICE_ROWS", 100)
    assert session.slices_of(10 ** 9) == session.MAX_SLICES
    w = World(spark, SF_SMALL)
    slices = w.slices(bank=False)
    assert len(slices) == session.MAX_SLICES and "bank_stmt" not in vars(w)
    assert all("trunc" not in _plan(s.t("lineitem")) and "PushedFilters: [Or(" in _plan(s.t("lineitem")) for s in slices)
    named, taken_apart = slices[3].t("lineitem"), World(spark, SF_SMALL, slices[3].slice).t("lineitem")
    assert named.count() == taken_apart.count() > 0 and named.exceptAll(taken_apart).isEmpty()


def test_staged_and_scanned_rows_in_slices_are_those_of_one(spark, monkeypatch):
    from ledgerlake.plans import catalog
    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    for name in ("stage_numbering", "scan_csv_blocks"):
        whole = sorted(map(str, catalog.QUERIES[name](spark, SF_SMALL).collect()))
        before = set(os.listdir(folder))
        with monkeypatch.context() as m:
            m.setattr(session, "SLICE_ROWS", 1000)
            sliced = catalog.QUERIES[name](spark, SF_SMALL)
        left = set(os.listdir(folder)) - before
        assert len(left) == 2 and all(f.startswith("table-") for f in left)       # the statements and the result
        assert whole and sorted(map(str, sliced.collect())) == whole


def test_steps_at_once_run_together_and_leave_the_setting(spark):
    both = threading.Barrier(2, timeout=60)
    tables = [session.SlicedTable(spark), session.SlicedTable(spark)]

    def step(i):
        both.wait()
        tables[i].add(lambda: spark.range(10 * i + 1).groupBy("id").count())
        assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    session.at_once(spark, lambda: step(0), lambda: step(1))
    assert [t.rows().count() for t in tables] == [1, 11] and spark.conf.get(SHUFFLE_CLEANUP) == "false"


def test_groups_of_one_cut_are_not_split(spark):
    raw = spark.range(300).select((F.col("id") % 150).cast("string").alias("g"), F.format_string("%04d", "id").alias("at"), F.lit("v").alias("v"))
    few = C.group_with_list(raw, ["g"], "v", "at", {}, count="n", part_rows=100)
    assert "LeftAnti" not in _plan(few) and {tuple(r) for r in few.select("v", "n").collect()} == {("v,v", 2)}


def test_numbers_are_padded_without_a_formatter_and_sorted_by_field(spark):
    df = spark.createDataFrame([(n, p) for n, p in zip([0, 7, 99, 100, 1234, -5, None], ["a", None] * 4)], "n int, p string")
    assert df.filter(~zero_pad("n").eqNullSafe(F.format_string("%03d", "n"))).isEmpty()
    assert df.filter(~statement_ref("p", "n").eqNullSafe(F.format_string("%s.%03d", "p", "n"))).isEmpty()
    rows = df.select(F.lit("s").alias("statement_id"), F.when(F.col("n").isNotNull(), F.struct("n", "p")).alias("pos"))
    assert len(_by_fields(rows, "pos")) == 3 and len(_by_fields(df, "n")) == 1
    numbered = number_rows(rows, "pos")
    assert [r["pos"] and r["pos"]["n"] for r in numbered.orderBy("transaction_id").collect()] == [None, -5, 0, 7, 99, 100, 1234]
