"""Detection (F1/F2) and parsing (A3-A5, P1-P8) on synthetic statement files."""

from pyspark.sql import functions as F

from fixtures import lhv_csv, lhv_row, secu_csv, secu_row, swed_csv, swed_row
from ledgerlake.formats import FORMATS
from ledgerlake.operators.ingest import classify_files, map_all_layouts
from ledgerlake.sources import csv_statements as CSV


def _files(spark, texts):
    return spark.createDataFrame([(f"f{i}", t) for i, t in enumerate(texts)], "file_name string, content string")


def _detect(spark, texts):
    df = _files(spark, texts).select("file_name", CSV.detect_format(F.col("content")).alias("fmt"),
                                     CSV.detect_error(F.col("content")).alias("err"))
    return {r.file_name: (r.fmt, r.err) for r in df.collect()}


def test_detect_three_layouts_with_and_without_bom(spark):
    got = _detect(spark, [lhv_csv([]), secu_csv([], bom=False), swed_csv([]), lhv_csv([], bom=False)])
    assert got["f0"][0] == "LHV_BANK"
    assert got["f1"][0] == "SECURITIES"
    assert got["f2"][0] == "SWEDBANK"
    assert got["f3"][0] == "LHV_BANK"


def test_detect_case_insensitive_unquoted_and_rejects(spark):
    got = _detect(spark, ["kliendi konto,DOKUMENDI NUMBER,x\r\n", "foo,bar\r\n1,2\r\n", ""])
    assert got["f0"] == ("LHV_BANK", None)
    assert got["f1"] == (None, "Unrecognised CSV format. Header: foo,bar")
    assert got["f2"] == (None, "Unrecognised CSV format. Header: (empty file)")


def test_securities_rule_wins_over_bank_keywords(spark):
    got = _detect(spark, ['"väärtuspäev","tehingupäev","dok nr"\n'])
    assert got["f0"][0] == "SECURITIES"


def test_legacy_detection(spark):
    df = _files(spark, [swed_csv([]), secu_csv([]), lhv_csv([]), "a;b\n"]).select(
        "file_name", CSV.legacy_detect_format(F.col("content")).alias("fmt"))
    got = {r.file_name: r.fmt for r in df.collect()}
    assert got == {"f0": "SWEDBANK", "f1": "SECURITIES", "f2": "LHV_BANK", "f3": "DEFAULT"}


def _parse(spark, text):
    files = classify_files(_files(spark, [text]).withColumnRenamed("file_name", "statement_id"))
    rows = CSV.parse_records(files.select("statement_id", "format", "separator", "content"))
    return rows


def test_lhv_strips_cell_six_and_maps_18(spark):
    rows = _parse(spark, lhv_csv([lhv_row(dc="D", amount="-1.00", provider="P1"),
                                  lhv_row(dc="C", amount="2.50", provider="P2")]))
    raw = sorted(rows.collect(), key=lambda r: r.file_pos)
    assert [len(r.fields) for r in raw] == [19, 19]
    mapped = map_all_layouts(rows)["bank"].orderBy("file_pos").collect()
    assert len(mapped) == 2
    assert mapped[0].d_c == "D" and mapped[0].payment_amount == "-1.00" and mapped[0].provider_reference == "P1"
    assert mapped[1].d_c == "C" and mapped[1].payment_amount == "2.50"
    assert [r.file_pos for r in mapped] == [1, 2]


def test_securities_13_and_swedbank_14_cells(spark):
    s = map_all_layouts(_parse(spark, secu_csv([secu_row(), secu_row(ref="R2")])))["secu"].collect()
    assert len(s) == 2 and {r.reference for r in s} == {"REF1", "R2"}
    w = map_all_layouts(_parse(spark, swed_csv([swed_row(provider="X")])))["bank"].collect()
    assert len(w) == 1
    assert w[0].customer_id == "" and w[0].currency == "EUR"
    assert w[0].other_side_bic is None and w[0].provider_reference is None


def test_header_only_gives_no_rows(spark):
    assert _parse(spark, secu_csv([])).count() == 0


def test_empty_cells_stay_empty_strings_and_values_trimmed(spark):
    text = '﻿' + ",".join(f'"{h}"' for h in FORMATS and
                               ["VÄÄRTUSPÄEV", "TEHINGUPÄEV", "TEHING", "SÜMBOL", "VÄÄRTPABER", "KOGUS",
                                "HIND", "VALUUTA", "NETOSUMMA", "TEENUSTASU", "KOKKU", "VIIDE", "KOMMENTAAR"])
    text += '\r\n2024-01-01,, ost ,"  ABC ",,1,2,EUR,3,4,5," R1 ",\r\n\r\n'
    rows = map_all_layouts(_parse(spark, text))["secu"].collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.transaction_date == "" and r.description == "" and r.comment == ""
    assert r.type == "ost" and r.ticker == "ABC" and r.reference == "R1"


def test_quoted_separator_newline_and_doubled_quotes(spark):
    row = secu_row(desc='Big, "quoted"\nname', comment="c")
    rows = map_all_layouts(_parse(spark, secu_csv([row, secu_row(ref="R2")])))["secu"].orderBy("file_pos").collect()
    assert rows[0].description == 'Big, "quoted"\nname'
    assert rows[1].reference == "R2" and rows[1].file_pos == 2


def test_short_row_maps_missing_cells_to_null(spark):
    text = secu_csv([]) + "a,b,c,d,e\r\n"
    r = map_all_layouts(_parse(spark, text))["secu"].collect()[0]
    assert r.value_date == "a" and r.description == "e"
    assert r.quantity is None and r.comment is None


def test_legacy_backslash_escape(spark):
    files = _files(spark, ['h1,h2\r\n"a\\"b",c\r\n']).withColumn("separator", F.lit(","))
    rows = CSV.parse_records(files, escape=True).collect()
    assert rows[0].fields == ['a"b', "c"]


def _random_file(rng, rows):
    """A file with quoted line ends, doubled quotes, quotes in mid-cell, blank lines and three kinds of line ends."""
    def cell():
        kind = rng.random()
        text = "".join(rng.choice(["a", "é", " ", ";", "1"]) for _ in range(rng.randrange(6)))
        if kind < 0.4:
            return '"' + text + "".join(rng.choice(['""', ",", "\n", "\r\n", "\r", "x"]) for _ in range(rng.randrange(4))) + '"'
        return text + ('"q\n"' if kind > 0.95 else "")
    out = "﻿" + "h1,h2,h3\r\n"
    for _ in range(rows):
        out += ",".join(cell() for _ in range(3)) + rng.choice(["\r\n"] * 5 + ["\n", "\n\n", "\r", "\r\n\r\n"])
    return out


def test_scan_in_blocks_equals_the_whole_file_parse(spark, tmp_path):
    import random
    rng = random.Random(3)
    texts = {f"f{i}.csv": _random_file(rng, n) for i, n in enumerate([0, 1, 40, 400, 4000])}
    texts |= {"empty.csv": "", "open.csv": 'h1,h2\r\n"a,b\r\nc,d\r\n', "blank.csv": "\r\n\r\n", "long.csv": 'h\r\n"' + "x\n" * 5000 + '"\r\nlast'}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "512")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        lines = CSV.read_lines(spark, str(tmp_path))
        assert lines.filter("file_name = 'f4.csv'").select("block").distinct().count() > 100
        assert lines.rdd.getNumPartitions() > 100
        records, bad = CSV.scan_records(lines)
        got = {}
        for r in records.collect():
            got.setdefault(r.file_name, []).append((r.file_pos, r.record))
        assert [r.file_path.rsplit("/", 1)[1] for r in bad.collect()] == ["open.csv"]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    whole = spark.createDataFrame([(n, t) for n, t in texts.items() if n != "open.csv"], "file_name string, content string")
    want = {}
    for r in whole.select("file_name", F.posexplode(F.regexp_extract_all(CSV.strip_bom(F.col("content")), F.lit(CSV.RECORD_RE), 0))).collect():
        want.setdefault(r.file_name, []).append((r.pos, r.col))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
