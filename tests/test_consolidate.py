"""Consolidation."""

from ledgerlake.formats import BANK_COLUMNS, SECU_COLUMNS
from ledgerlake.operators import consolidate as C
from ledgerlake.operators.stage import stage
from pyspark.sql import functions as F

STMT = "id string, account_type string, from_date string, to_date string"


def _secu(spark, rows):
    cols = ", ".join(f"{c} string" for c in SECU_COLUMNS)
    return spark.createDataFrame(rows, f"statement_id string, pos int, {cols}")


def _buy(pos, qty, amount, ref, price="3.50"):
    return ("s1", pos, "2024-01-10", "2024-01-08", "ost", "LHV1T", "LHV Group", qty, price, "EUR",
            amount, "-1.00", str(float(amount) - 1), ref, "")


def test_partial_fills_merge_into_one_row(spark):
    qty = [257, 500, 1000, 10, 20, 513]
    rows = [_buy(i + 1, str(q), f"{-q * 3.5:.2f}", f"R{i + 1}") for i, q in enumerate(qty)]
    raw = stage(_secu(spark, rows), SECU_COLUMNS)
    st = spark.createDataFrame([("s1", "secu", "2024-01-01", "2024-01-31")], STMT)
    out = C.consolidate_secu(raw, st).collect()
    assert len(out) == 1
    r = out[0]
    assert r.quantity == "2300.000000"
    assert r.amount == "-8050.00"
    assert r.price == "3.500000000000"
    assert r.reference == "R1,R2,R3,R4,R5,R6"
    assert r.statement_reference == "STMT2024.001"
    assert r.status == "new" and r.created_by == "system" and len(r.id) == 36


def test_reference_list_orders_by_text_transaction_id(spark):
    # 1000 rows in one group: '1000' sorts before '999' (text order, as stored)
    rows = [_buy(i, "1", "-3.50", f"R{i}") for i in range(1, 1001)]
    raw = stage(_secu(spark, rows), SECU_COLUMNS)
    st = spark.createDataFrame([("s1", "secu", "2024-01-01", "2024-01-31")], STMT)
    refs = C.consolidate_secu(raw, st).collect()[0].reference.split(",")
    assert refs.index("R1000") < refs.index("R999")


def test_bank_groups_numbering_and_refs(spark):
    def row(sid, pos, date, dc, name, amount, prov):
        v = {c: "" for c in BANK_COLUMNS}
        v.update(payment_date=date, d_c=dc, other_side_name=name, payment_amount=amount,
                 transaction_fee="0.10", currency="EUR", provider_reference=prov)
        return (sid, pos, *[v[c] for c in BANK_COLUMNS])
    rows = [row("a", 1, "2024-01-02", "D", "X", "-1.00", "P1"),
            row("a", 2, "2024-01-02", "D", "X", "-2.00", None),
            row("a", 3, "2024-01-01", "C", "Y", "5.00", ""),
            row("b", 1, "2024-02-01", "C", "Z", "1.005", "Q")]
    df = spark.createDataFrame(rows, "statement_id string, pos int, " + ", ".join(f"{c} string" for c in BANK_COLUMNS))
    raw = stage(df, BANK_COLUMNS)
    st = spark.createDataFrame([("a", "bank", "2024-01-01", "2024-01-31"), ("b", "bank", None, None)], STMT)
    out = {r.statement_reference[-3:] + r.statement_id: r for r in C.consolidate_bank(raw, st).collect()}
    assert out["001a"].payment_date == "2024-01-01" and out["001a"].provider_reference == ""
    assert out["002a"].payment_amount == "-3.00" and out["002a"].transaction_fee == "0.20"
    assert out["002a"].provider_reference == "P1"       # NULL skipped
    assert out["001b"].statement_reference.startswith("STMT20")  # NULL from_date -> current year


def test_rerun_gives_identical_ids(spark):
    rows = [_buy(i, "1", "-3.50", f"R{i}") for i in range(1, 4)]
    st = spark.createDataFrame([("s1", "secu", "2024-01-01", "2024-01-31")], STMT)
    a = C.consolidate_secu(stage(_secu(spark, rows), SECU_COLUMNS), st).select("id", "statement_reference").collect()
    b = C.consolidate_secu(stage(_secu(spark, rows), SECU_COLUMNS), st).select("id", "statement_reference").collect()
    assert a == b


def test_sums_conserved(spark):
    rows = [_buy(i, str(i), f"-{i}.25", f"R{i}") for i in range(1, 30)]
    raw = stage(_secu(spark, rows), SECU_COLUMNS)
    st = spark.createDataFrame([("s1", "secu", "2024-01-01", "2024-01-31")], STMT)
    tot = C.consolidate_secu(raw, st).agg(F.sum(F.col("amount").cast("decimal(20,2)"))).collect()[0][0]
    assert str(tot) == str(sum(-(i + 0.25) for i in range(1, 30)).__round__(2)) or float(tot) == sum(-(i + 0.25) for i in range(1, 30))


def test_optional_case_insensitive_grouping(spark):
    rows = [_buy(1, "1", "-3.50", "R1"), _buy(2, "1", "-3.50", "R2")]
    rows[1] = rows[1][:5] + ("lhv1t",) + rows[1][6:]
    raw = stage(_secu(spark, rows), SECU_COLUMNS)
    assert C.aggregate_secu(raw).count() == 2                      # binary (default)
    assert C.aggregate_secu(raw, collation="UNICODE_CI_AI").count() == 1


def test_a_large_group_is_listed_in_ranges(spark):
    """One group with most rows, small ones, NULL and '' references, NULL and odd numbers: both plans agree."""
    rows = [_buy(i, str(i % 7), f"-{i % 90}.{i % 100:02d}", f"R{i}", price=f"{i % 11}.3333333{i % 10}") for i in range(1, 4001)]
    rows += [_buy(i, "1", "-3.50", None if i % 3 else "", price="")[:5] + (f"T{i % 5}",) + _buy(i, "1", "-3.50", None if i % 3 else "", price="x" if i % 4 else "-1.5")[6:]
             for i in range(4001, 4040)]
    rows += [("s2", 1, None, None, None, None, None, None, None, None, None, None, None, None, None)]
    raw = stage(_secu(spark, rows), SECU_COLUMNS)
    key = lambda r: str((r.statement_id, r.ticker))
    whole = C.aggregate_secu(raw, largest=5000)
    ranged = C.aggregate_secu(raw, part_rows=64)
    assert ranged.schema == whole.schema
    assert sorted(ranged.collect(), key=key) == sorted(whole.collect(), key=key)
    pieces = C.list_pieces(raw, ["statement_id", *C.SECU_KEYS], "reference", "transaction_id",
                           [F.count(F.lit(1)).alias("n")], part_rows=64).filter("ticker = 'LHV1T'").collect()
    assert len(pieces) > 20 and max(r.n for r in pieces) < 1000
    few, one = C.design_secu(raw), C.design_secu(raw, largest=5000)
    assert few.schema == one.schema and sorted(few.collect(), key=key) == sorted(one.collect(), key=key)


def test_ranged_lists_of_bank_groups_and_collations(spark):
    def row(pos, name, prov):
        v = {c: "" for c in BANK_COLUMNS}
        v.update(payment_date="2024-01-02", d_c="D", other_side_name=name, payment_amount=f"{pos}.015",
                 transaction_fee="0.10", currency="EUR", provider_reference=prov)
        return ("a", pos, *[v[c] for c in BANK_COLUMNS])
    rows = [row(i, "x" if i % 2 else "X", f"P{i}") for i in range(1, 1200)]
    df = spark.createDataFrame(rows, "statement_id string, pos int, " + ", ".join(f"{c} string" for c in BANK_COLUMNS))
    raw = stage(df, BANK_COLUMNS)
    for collation, groups in ((None, 2), ("UNICODE_CI_AI", 1)):
        whole = C.aggregate_bank(raw, collation=collation, largest=2000)
        ranged = C.aggregate_bank(raw, collation=collation, part_rows=32)
        pick = lambda d: sorted(map(str, d.select("payment_amount", "transaction_fee", "provider_reference").collect()))
        assert ranged.schema == whole.schema and pick(ranged) == pick(whole) and whole.count() == groups
    empty = C.aggregate_bank(raw.limit(0))
    assert empty.count() == 0
