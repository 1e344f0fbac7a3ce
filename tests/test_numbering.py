"""number_within: the bucketed plan equals row_number() exactly."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlake.operators.numbering import number_by_keys, number_within, with_parts


def test_bucketed_equals_plain_window(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice(["a", "b", None]), rnd.randint(0, 5000), rnd.random()) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, pos int, v double")
    order = [F.col("pos"), F.col("v")]
    plain = df.withColumn("seq", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    one = number_within(df, ["g"], order, [F.expr("pos div 97")])
    two = number_within(df, ["g"], order, [F.expr("pos div 970"), F.expr("pos div 97")])
    three = number_within(df, ["g"], order, [F.expr("pos div 970"), F.expr("pos div 97"), F.expr("pos div 5")])
    key = lambda r: (r.g or "", r.pos, r.v)
    want = sorted(plain.collect(), key=key)
    for got in (one, two, three):
        assert got.columns == plain.columns
        assert sorted(got.collect(), key=key) == want


def test_a_hot_bucket_is_divided_by_ranges_of_its_keys(spark):
    """One statement, one date, one direction: numbered in many parts, like row_number()."""
    rnd = random.Random(5)
    word = lambda: rnd.choice(["", "a", "ab", "é", None]) if rnd.random() < 0.1 else f"{rnd.randint(0, 10**6):x}"
    rows = {("s", "2024-01-05", "D", word(), word(), i % 7) for i in range(6000)}
    rows |= {("t", None, rnd.choice("CD"), word(), None, i) for i in range(50)} | {(None, None, None, None, None, 1)}
    df = spark.createDataFrame(sorted(rows, key=str), "g string, day string, d_c string, name string, note string, nr int")
    sort = ["day", "d_c", "name", "note", "nr"]
    plain = df.withColumn("seq", F.row_number().over(
        Window.partitionBy("g").orderBy(*[F.col(c).asc_nulls_first() for c in sort])))
    got = number_by_keys(df, ["g"], sort, part_rows=64)
    assert got.columns == plain.columns
    assert sorted(got.collect(), key=str) == sorted(plain.collect(), key=str)
    parts = with_parts(df, ["g", "day", "d_c"], sort[2:], part_rows=64).filter("g = 's'").groupBy("_part").count().collect()
    assert len(parts) > 30 and max(r["count"] for r in parts) < 1500
    few = with_parts(df, ["g", "day", "d_c"], sort[2:], part_rows=64, max_parts=8).filter("g = 's'")
    assert 4 < few.select("_part").distinct().count() <= 9
    empty = number_by_keys(df.limit(0), ["g"], sort)
    assert empty.count() == 0 and empty.columns == plain.columns


def test_copies_of_one_key_share_a_part(spark):
    df = spark.createDataFrame([("s", "d", "D", "x")] * 300 + [("s", "d", "D", "y")] * 300, "g string, day string, d_c string, name string")
    seqs = number_by_keys(df, ["g"], ["day", "d_c", "name"], part_rows=2).collect()
    assert sorted(r.seq for r in seqs) == list(range(1, 601))
    assert max(r.seq for r in seqs if r.name == "x") == 300
