"""End to end: files -> import -> consolidate over a lake folder."""

import tempfile

from pyspark.sql import functions as F

from fixtures import lhv_csv, lhv_row, secu_csv, secu_row, write
from ledgerlake.operators.control import status_timeline
from ledgerlake.operators.dedup import stored_keys
from ledgerlake.plans.jobs import Lake, consolidate_statements, import_statements, reset_statements
from ledgerlake.schemas import STATEMENT


def _setup(spark, statements, files):
    root = tempfile.mkdtemp(prefix="ll-lake-")
    fdir = tempfile.mkdtemp(prefix="ll-files-")
    for name, text in files.items():
        write(fdir, name, text)
    control = spark.createDataFrame(statements, STATEMENT)
    return Lake(spark, root), control, fdir


def _state(lake, control):
    return {r.id: r for r in lake.statements(control).collect()}


def test_import_and_consolidate_then_rerun(spark):
    bank = lhv_csv([lhv_row(doc=str(i), amount=f"-{i}.00", provider=f"P{i}") for i in range(1, 6)])
    secu = secu_csv([secu_row(qty=str(q), amount=f"{-q * 3.5:.2f}", ref=f"R{q}") for q in (257, 500)])
    lake, control, fdir = _setup(spark, [
        ("b1", "bank", "LHVBEE22", "2024-01-01", "2024-01-31", "b1.csv", "new", 1),
        ("s1", "secu", "LHVBEE22", "2024-01-01", "2024-01-31", "s1.csv", "new", 2)],
        {"b1.csv": bank, "s1.csv": secu})
    import_statements(lake, control, fdir)
    st = _state(lake, control)
    assert st["b1"].status == "imported" and st["b1"].row_count == 5 and st["b1"].duplicate_count == 0
    raw = lake.current("bank", control).orderBy("transaction_id").collect()
    assert [r.transaction_id for r in raw] == ["001", "002", "003", "004", "005"]
    assert raw[0].created_by == "system" and len(raw[0].id) == 36

    consolidate_statements(lake, control)
    st = _state(lake, control)
    assert st["s1"].status == "consolidated" and st["s1"].total_count == 1
    tot = lake.current("secu", control, "total").collect()
    assert len(tot) == 1 and tot[0].quantity == "757.000000" and tot[0].reference == "R257,R500"
    assert st["b1"].total_count == 5

    # re-running the same records replaces, never duplicates
    import_statements(lake, control, fdir, ids=["b1", "s1"])
    assert lake.current("bank", control).count() == 5
    consolidate_statements(lake, control)
    assert lake.current("secu", control, "total").count() == 1
    refs = sorted(r.statement_reference for r in lake.current("bank", control, "total").collect())
    assert refs == [f"STMT2024.{i:03d}" for i in range(1, 6)]
    tl = status_timeline(lake.events(), control.withColumnRenamed("id", "id")).filter("statement_id = 's1'")
    assert tl.filter(~F.col("allowed")).count() == 0


def test_same_file_as_new_record_is_all_duplicates_and_zero_row_overwrite(spark):
    text = lhv_csv([lhv_row(doc=str(i), provider=f"P{i}") for i in range(1, 4)])
    lake, control, fdir = _setup(spark, [
        ("a", "bank", "X", "2024-01-01", "2024-01-31", "a.csv", "new", 1),
        ("b", "bank", "X", "2024-01-10", "2024-02-10", "b.csv", "new", 2)],
        {"a.csv": text, "b.csv": text})
    import_statements(lake, control, fdir, ids=["a"])
    import_statements(lake, control, fdir, ids=["b"])
    st = _state(lake, control)
    assert (st["b"].row_count, st["b"].duplicate_count) == (3, 3)
    assert lake.current("bank", control).filter("statement_id = 'b'").count() == 0
    # b first held its own rows; when its file is replaced by one whose rows
    # are all duplicates, the re-import writes nothing and the old partition
    # must not show through
    other = lhv_csv([lhv_row(doc=str(i), provider=f"Q{i}") for i in range(1, 4)])
    lake2, control2, fdir2 = _setup(spark, [
        ("a", "bank", "X", "2024-01-01", "2024-01-31", "a.csv", "new", 1),
        ("b", "bank", "X", "2024-01-10", "2024-02-10", "b.csv", "new", 2)],
        {"a.csv": text, "b.csv": other})
    import_statements(lake2, control2, fdir2)
    assert lake2.current("bank", control2).filter("statement_id = 'b'").count() == 3
    write(fdir2, "b.csv", text)
    import_statements(lake2, control2, fdir2, ids=["b"])
    assert lake2.current("bank", control2).filter("statement_id = 'b'").count() == 0
    assert lake2.current("bank", control2).filter("statement_id = 'a'").count() == 3


def test_error_paths_do_not_fail_the_batch(spark):
    lake, control, fdir = _setup(spark, [
        ("ok", "secu", "X", "2024-01-01", "2024-01-31", "ok.csv", "new", 1),
        ("missing", "secu", "X", "2024-01-01", "2024-01-31", "nope.csv", "new", 2),
        ("mismatch", "bank", "X", "2024-01-01", "2024-01-31", "m.csv", "new", 3),
        ("unknown", "bank", "X", "2024-01-01", "2024-01-31", "u.csv", "new", 4),
        ("nofile", "bank", "X", "2024-01-01", "2024-01-31", None, "new", 5),
        ("notype", None, "X", "2024-01-01", "2024-01-31", "ok.csv", "new", 6),
        ("short", "bank", "X", "2024-01-01", "2024-01-31", "s.csv", "new", 7)],
        {"ok.csv": secu_csv([secu_row()]), "m.csv": secu_csv([secu_row(ref="Z")]),
         "u.csv": "hello,world\r\n1,2\r\n", "s.csv": lhv_csv([]) + "a,b,c\r\n"})
    import_statements(lake, control, fdir)
    st = _state(lake, control)
    assert st["ok"].status == "imported"
    assert st["missing"].error_message == "CSV file not found on disk: nope.csv (table=bank_statement, recordId=missing)"
    assert st["mismatch"].error_message == "Format mismatch: detected secu but statement has account_type=bank"
    assert st["unknown"].error_message == "Unrecognised CSV format. Header: hello,world"
    assert st["nofile"].error_message == "No file attached to statement: nofile"
    assert st["notype"].error_message == "account_type is required in the form"
    assert st["short"].status == "error"
    assert lake.current("secu", control).count() == 1


def test_strict_amounts_fail_only_that_statement(spark):
    lake, control, fdir = _setup(spark, [
        ("good", "secu", "X", "2024-01-01", "2024-01-31", "g.csv", "new", 1),
        ("bad", "secu", "X", "2023-01-01", "2023-01-31", "b.csv", "new", 2)],
        {"g.csv": secu_csv([secu_row(fee="")]), "b.csv": secu_csv([secu_row(amount="12,50", ref="Q")])})
    import_statements(lake, control, fdir)
    consolidate_statements(lake, control)
    st = _state(lake, control)
    assert st["good"].status == "consolidated"
    assert st["bad"].status == "error" and "non-numeric" in st["bad"].error_message
    tot = lake.current("secu", control, "total").collect()
    assert len(tot) == 1 and tot[0].fee == "0.00"


def test_reset_then_recognise(spark):
    from ledgerlake.plans.jobs import recognise_statements, reset_statements
    secu = secu_csv([secu_row(qty="10", amount="-35.00", fee="-1.00", total="-36.00", ref="R1")])
    bank = lhv_csv([lhv_row(doc="1", amount="-35.00", provider="P1"), lhv_row(doc="2", amount="-1.00", provider="P2"),
                    lhv_row(doc="3", amount="50.00", dc="C", cust="12345678", provider="P3", desc="rent income")])
    lake, control, fdir = _setup(spark, [
        ("b1", "bank", "BK", "2024-01-01", "2024-01-31", "b1.csv", "new", 1),
        ("s1", "secu", "BK", "2024-01-01", "2024-01-31", "s1.csv", "new", 2)],
        {"b1.csv": bank, "s1.csv": secu})
    import_statements(lake, control, fdir)
    consolidate_statements(lake, control)
    banks = spark.createDataFrame([("BK", "LHVBEE22")], "id string, swift_code_bic string")
    customers = spark.createDataFrame([("C1", "CR1", "12345678", None, None, None, "EE0")],
                                      "id string, customer_ref string, registration_number string, national_id string, "
                                      "org_name string, ind_business_name string, account_number string")
    trx = spark.createDataFrame([("T1", "SECBUY", "secu", "out", "SCR01", None),
                                 ("T4", "CUSTIN", "bank", "in", "CSH01", "yes")],
                                "id string, code string, statement_type string, flow_type string, asset_type string, "
                                "is_customer string")
    ops = spark.createDataFrame([("L1", "RENT", "rent", "CUSTIN", "rent", "", 1)],
                                "id string, code string, name string, basis_trx_type string, included_words string, "
                                "excluded_words string, ordinal int")
    cur = spark.createDataFrame([("EUR",)], "code string")
    recognise_statements(lake, control, banks, customers, trx, ops, cur)
    posts = {r.processor: r for r in lake.read("posting").collect()}
    assert set(posts) == {"secu", "bank"}
    assert posts["secu"].transaction_type == "SECBUY" and posts["bank"].type == "RENT"
    assert lake.read("posting_link").count() == 4
    recognise_statements(lake, control, banks, customers, trx, ops, cur)   # idempotent
    assert lake.postings(control).count() == 2
    reset_statements(lake, control, ["b1"])
    st = _state(lake, control)
    assert st["b1"].status == "new" and lake.current("bank", control).count() == 0


def test_empty_statement_still_consolidated(spark):
    lake, control, fdir = _setup(spark, [("e", "secu", "X", "2024-01-01", "2024-01-31", "e.csv", "new", 1)],
                                 {"e.csv": secu_csv([])})
    import_statements(lake, control, fdir)
    consolidate_statements(lake, control)
    st = _state(lake, control)
    assert (st["e"].status, st["e"].row_count, st["e"].total_count) == ("consolidated", 0, 0)   # Q16


def _bank_rows(n, start=1, provider="P"):
    return lhv_csv([lhv_row(doc=str(i), amount=f"-{i}.00", provider=f"{provider}{i}") for i in range(start, start + n)])


def test_a_run_that_died_after_its_first_event_is_taken_up_again(spark):
    from ledgerlake.operators import control as K
    lake, control, fdir = _setup(spark, [("a", "bank", "X", "2024-01-01", "2024-01-31", "a.csv", "new", 1)], {"a.csv": _bank_rows(3)})
    dead = control.select(F.col("id").alias("statement_id"))
    lake.append_events(K.events(dead, "import", "importing", 5))
    import_statements(lake, control, fdir)
    assert _state(lake, control)["a"].status == "imported" and lake.current("bank", control).count() == 3
    lake.append_events(K.events(dead, "consolidate", "consolidating", 10**16))
    import ledgerlake.plans.jobs as J
    keep, J._run_seq = J._run_seq, lambda: 10**16 + 10
    try:
        consolidate_statements(lake, control)
    finally:
        J._run_seq = keep
    assert _state(lake, control)["a"].total_count == 3


def test_files_of_one_name_belong_to_their_records(spark):
    lake, control, fdir = _setup(spark, [
        ("r1", "bank", "X", "2024-01-01", "2024-01-31", "st.csv", "new", 1),
        ("r2", "bank", "X", "2025-01-01", "2025-01-31", "st.csv", "new", 2),
        ("r3", "bank", "X", "2026-01-01", "2026-01-31", "two.csv", "new", 3)], {})
    import os
    for d, name, text in (("r1", "st.csv", _bank_rows(1)), ("r2", "st.csv", _bank_rows(2, 10)),
                          ("x", "two.csv", _bank_rows(1)), ("y", "two.csv", _bank_rows(1))):
        os.makedirs(f"{fdir}/{d}", exist_ok=True)
        write(f"{fdir}/{d}", name, text)
    import_statements(lake, control, [f"{fdir}/{d}" for d in ("r1", "r2", "x", "y")])
    st = _state(lake, control)
    assert (st["r1"].row_count, st["r2"].row_count) == (1, 2)
    assert st["r3"].error_message == "Several files are named two.csv and none lies in the folder of r3"


def test_a_crashed_reimport_leaves_the_old_rows_visible(spark):
    lake, control, fdir = _setup(spark, [("a", "bank", "X", "2024-01-01", "2024-01-31", "a.csv", "new", 1)], {"a.csv": _bank_rows(3)})
    import_statements(lake, control, fdir)
    rows = lake.current("bank", control)
    lake.append_load("bank_raw", rows.withColumn("load_id", F.lit("import-crashed")), control)   # no event follows
    assert lake.current("bank", control).count() == 3
    plan = lake.current("bank", control)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "period" in plan.split("PartitionFilters", 1)[1][:400]
    import glob
    assert len(glob.glob(f"{lake.root}/bank_raw/*/*/*/*.parquet")) <= 2


def test_statuses_and_dates_are_checked(spark):
    lake, control, fdir = _setup(spark, [
        ("c", "bank", "X", "2024-01-01", "2024-01-31", "a.csv", "consolidating", 1),
        ("d", "bank", "X", "31.01.2024", "2024-02-31", "a.csv", "new", 2),
        ("e", "bank", "X", "2024-02-01", "2024-01-01", "a.csv", "new", 3)], {"a.csv": _bank_rows(1)})
    import_statements(lake, control, fdir, ids=["c", "d", "e"])
    st = _state(lake, control)
    assert st["c"].status == "consolidating"
    assert [r.message for r in lake.events().filter("statement_id = 'c'").collect()] == ["Cannot import a statement in status consolidating"]
    assert st["d"].error_message.startswith("Statement dates must be") and st["e"].error_message.startswith("Statement dates must be")


def _reference_data(spark):
    banks = spark.createDataFrame([("BK", "LHVBEE22")], "id string, swift_code_bic string")
    customers = spark.createDataFrame([("C1", "CR1", "12345678", None, None, None, "EE0")],
                                      "id string, customer_ref string, registration_number string, national_id string, "
                                      "org_name string, ind_business_name string, account_number string")
    trx = spark.createDataFrame([("T4", "CUSTIN", "bank", "in", "CSH01", "yes")],
                                "id string, code string, statement_type string, flow_type string, asset_type string, is_customer string")
    ops = spark.createDataFrame([("L1", "RENT", "rent", "CUSTIN", "rent", "", 1)],
                                "id string, code string, name string, basis_trx_type string, included_words string, "
                                "excluded_words string, ordinal int")
    return banks, customers, trx, ops, spark.createDataFrame([("EUR",)], "code string")


def test_reset_and_new_content_free_the_postings(spark):
    from ledgerlake.plans.jobs import recognise_statements, reset_statements
    text = lambda amount: lhv_csv([lhv_row(doc="1", amount=amount, dc="C", cust="12345678", provider=f"P{amount}", desc="rent")])
    lake, control, fdir = _setup(spark, [("b", "bank", "BK", "2024-01-01", "2024-01-31", "b.csv", "new", 1)], {"b.csv": text("50.00")})
    data = _reference_data(spark)
    amounts = lambda: sorted(r.amount for r in lake.postings(control).collect())
    import_statements(lake, control, fdir)
    consolidate_statements(lake, control)
    recognise_statements(lake, control, *data)
    assert amounts() == ["50.00"]
    # postings written by a run that died before it was complete do not count
    lake.read("posting").drop("run_id").withColumn("run_id", F.lit("dead")).write.mode("append").partitionBy("run_id").parquet(lake.path("posting"))
    recognise_statements(lake, control, *data)
    assert amounts() == ["50.00"]
    reset_statements(lake, control, ["b"])
    assert amounts() == []
    write(fdir, "b.csv", text("75.00"))
    import_statements(lake, control, fdir)
    consolidate_statements(lake, control)
    recognise_statements(lake, control, *data)
    assert amounts() == ["75.00"]
    write(fdir, "b.csv", text("80.00"))
    import_statements(lake, control, fdir, ids=["b"])
    consolidate_statements(lake, control)
    assert amounts() == []
    recognise_statements(lake, control, *data)
    assert amounts() == ["80.00"]


def test_an_import_compares_with_stored_keys_only(spark):
    """Keys are kept by load; re-imports, resets and loads without keys give the verdicts of the raw rows."""
    rows = [lhv_row(doc=str(i), provider=f"P{i}" if i % 2 else "", arch=f"A{i}") for i in range(1, 7)]
    lake, control, fdir = _setup(spark, [
        (n, "bank", "X", "2024-01-01", "2024-01-31", f"{n}.csv", "new", i) for i, n in enumerate("abcd")],
        {"a.csv": lhv_csv(rows), "b.csv": lhv_csv(rows[:4]), "c.csv": lhv_csv(rows[2:]), "d.csv": lhv_csv(rows[1:5])})
    import_statements(lake, control, fdir, ids=["a"])
    keys = lake.keys("bank", control)
    plan = keys._jdf.queryExecution().toString()
    assert "bank_key" in plan and "bank_raw" not in plan
    scan = plan[plan.index("== Physical Plan =="):]
    filters = scan[scan.index("PartitionFilters"):].split("]")[0]
    assert "= import-" in filters and "(period" in filters  # the plan cuts long filters
    pairs = lambda d: sorted(map(tuple, d.select("statement_id", "dedup_key").collect()))
    derived = lambda: pairs(stored_keys(lake.current("bank", control), "bank"))
    assert pairs(keys) == derived() and keys.count() == 6
    import_statements(lake, control, fdir, ids=["b"], bulk=False)
    assert _state(lake, control)["b"].duplicate_count == 4
    # a re-import with other rows: the keys of the old load no longer block
    write(fdir, "a.csv", lhv_csv(rows[:1]))
    import_statements(lake, control, fdir, ids=["a"])
    assert pairs(lake.keys("bank", control)) == derived() and len(derived()) == 1
    import_statements(lake, control, fdir, ids=["c"])
    assert (_state(lake, control)["c"].row_count, _state(lake, control)["c"].duplicate_count) == (4, 0)
    # a reset statement holds no keys
    reset_statements(lake, control, ["c"])
    assert {s for s, _ in pairs(lake.keys("bank", control))} == {"a"}
    import_statements(lake, control, fdir, ids=["c"])
    # loads written before there was a key table are compared by their raw rows
    old = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-"))
    for table, by in (("statement_event", ["day"]), ("bank_raw", ["load_id", "period", "bucket"])):
        lake.read(table).write.partitionBy(*by).parquet(old.path(table))
    assert pairs(old.keys("bank", control)) == derived()
    for one in (lake, old):
        import_statements(one, control, fdir, ids=["d"])
        st = _state(one, control)["d"]
        assert (st.row_count, st.duplicate_count) == (4, 3)
