"""Driver contract smoke test (entry on sf0.001; every query has an oracle)."""

import duckdb

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"statement_id", "statement_reference", "quantity", "price", "reference"} <= set(df.columns)


def test_every_query_has_an_oracle_with_same_columns(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 30
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    for name in ("consolidate_bank", "dedup_bulk_fold", "postings", "topk_amounts"):
        cols = [d[0] for d in con.execute(sqls[name]).description]
        assert sorted(cols) == sorted(qs[name](spark, SF).columns), name
