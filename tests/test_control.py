"""Event log: the state from a snapshot and later days equals the full fold (K6-K8)."""

import random
import tempfile

from pyspark.sql import functions as F

from ledgerlake.operators import control as K
from ledgerlake.plans.jobs import DAY, Lake, snapshot_events
from ledgerlake.schemas import STATEMENT, STATEMENT_EVENT


def _log(spark, days):
    """Ten statements with random histories, null statuses and resets among them."""
    rnd = random.Random(17)
    rows, seq = [], 0
    for day in days:
        for i in range(40):
            seq = day * DAY + i
            job, status = rnd.choice([("import", "importing"), ("import", "imported"), ("consolidate", "consolidated"),
                                      ("reset", "new"), ("import", "error"), ("import", None)])
            rows.append((f"s{rnd.randint(0, 9)}", seq, job, status, f"m{seq}", i, i % 3, i % 5, str(seq), f"load-{seq}"))
    return spark.createDataFrame(rows, STATEMENT_EVENT)


def test_snapshot_and_delta_equal_the_full_fold(spark):
    lake = Lake(spark, tempfile.mkdtemp(prefix="ll-lake-"))
    control = spark.createDataFrame([(f"s{i}", "bank", "X", "2024-01-01", "2024-01-31", "f.csv", "new", i) for i in range(11)], STATEMENT)
    log = _log(spark, [0, 3, 4, 7]).cache()
    state = lambda df: sorted(map(tuple, df.collect()), key=str)
    full = lambda upto: state(K.current_statements(control, log.filter(F.col("event_seq") < upto * DAY)))
    assert state(lake.statements(control)) == full(0)
    lake.append_events(log.filter(F.col("event_seq") < 4 * DAY))
    snapshot_events(lake, today=3)
    assert state(lake.statements(control)) == full(4)
    lake.append_events(log.filter(F.col("event_seq") >= 4 * DAY))
    assert state(lake.statements(control)) == full(8)
    # a snapshot that died before its last row is not read
    (lake.events().limit(3).withColumn("snapshot_id", F.lit("snapshot-9-dead"))
     .write.mode("append").partitionBy("snapshot_id").parquet(lake.path("event_snapshot")))
    assert state(lake.statements(control)) == full(8)
    last = snapshot_events(lake, today=7)       # from the first snapshot and the days since
    assert state(lake.statements(control)) == full(8)
    kept = lake.read("event_snapshot").filter(F.col("snapshot_id") == last)
    assert kept.groupBy("statement_id").count().agg(F.max("count")).first()[0] <= 4
    # days before the snapshot are neither listed for rows nor read
    read = lake.live_events().inputFiles()
    assert any(last in f for f in read) and {f.split("/day=")[1].split("/")[0] for f in read if "/day=" in f} >= {"7"}
    rows = lake.live_events().select(F.input_file_name().alias("f")).distinct().collect()
    assert {r.f.split("/day=")[1].split("/")[0] for r in rows if "/day=" in r.f} == {"7"}
    plan = lake.live_events()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "PartitionFilters: [isnotnull(snapshot_id" in plan
