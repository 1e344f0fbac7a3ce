"""Spark session helpers (local testing) and shared-storage settings."""

from __future__ import annotations

import contextlib
import os
import tempfile
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every job relies on; safe on a cluster as well as in local mode.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlake") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    builder = (builder
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", os.environ.get("LEDGERLAKE_DRIVER_MEM", "8g")))
    if "LEDGERLAKE_CHECKPOINT_DIR" in os.environ:
        builder = builder.config("spark.checkpoint.dir", os.environ["LEDGERLAKE_CHECKPOINT_DIR"])
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster session must name one: a machine-local folder would lose data.
    Only a purely local session without the setting gets a scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="ledgerlake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def cut_lineage(df):
    """Reliable checkpoint (survives executor loss); never a local checkpoint."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Spark removes the shuffle files of an execution when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


_blocks = threading.local()


@contextlib.contextmanager
def tables_removed(spark: SparkSession):
    """Tables written inside are removed at the end, when what was read from them has been written.

    Yields the tables that the block around removes, to which one that outlives this block is added
    (``removed_with``)."""
    outer, _blocks.paths = getattr(_blocks, "paths", None), []
    try:
        yield [] if outer is None else outer
    finally:
        paths, _blocks.paths = _blocks.paths, outer
        for p in paths:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def new_table(spark: SparkSession, removed_with: list | None = None, name: str = "table") -> str:
    """A fresh folder below the shared one, removed by the block around (``tables_removed``)."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    paths = getattr(_blocks, "paths", None) if removed_with is None else removed_with
    if paths is not None:
        paths.append(path)
    return path


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """What is executed inside removes its shuffle files when it ends."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def _write(df, path: str, by: tuple = ()) -> None:
    """Append df to the table; the shuffle files behind it are removed."""
    with shuffles_removed(df.sparkSession):
        df.write.mode("append").option("compression", "zstd").partitionBy(*by).parquet(path)


def at_once(spark: SparkSession, *steps: Callable) -> None:
    """Steps that each write a table of their own (``SlicedTable.add``), at the same time: the jobs of one use the
    cores that the last tasks and the planning of another leave idle."""
    with shuffles_removed(spark), ThreadPoolExecutor(max(1, len(steps))) as pool:
        for done in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]:
            done.result()


def written(df, by: tuple = (), removed_with: list | None = None):
    """The same rows, written as a Parquet table in the shared folder and read back.

    Like ``cut_lineage``, but the result has the sizes of its files for statistics (a checkpoint
    keeps the estimate of its plan, which grows with every join) and its columns can be pruned.
    The shuffle files behind it are removed once it is written: nothing reads them again, and
    they would stay on disk until a garbage collection of the driver finds them.
    ``by``: partition columns of the table.
    """
    spark = df.sparkSession
    path = new_table(spark, removed_with)
    _write(df, path, by)
    return spark.read.schema(df.schema).parquet(path)


#: Rows, about, that a step on large tables shuffles at a time.
SLICE_ROWS = 1 << 23

#: Every slice looks at all rows for its own, so there are at most so many: beyond, slices grow instead.
MAX_SLICES = 12


def slices_of(rows: int) -> int:
    return min(MAX_SLICES, max(1, -(-rows // SLICE_ROWS)))


class SlicedTable:
    """A table written slice by slice: shuffle files and the tables written for a slice are removed
    before the next one, so they do not grow with the number of slices."""

    def __init__(self, spark: SparkSession, removed_with: list | None = None):
        self.spark, self.path = spark, new_table(spark, removed_with)

    def add(self, build: Callable) -> None:
        with tables_removed(self.spark):
            df = build()
            _write(df, self.path)
            self.schema = df.schema

    def rows(self):
        return self.spark.read.schema(self.schema).parquet(self.path)


def written_in_slices(spark: SparkSession, slices: int, build: Callable, removed_with: list | None = None):
    """``build(i)`` for every slice, appended to one table and read back."""
    table = SlicedTable(spark, removed_with)
    for i in range(slices):
        table.add(lambda i=i: build(i))
    return table.rows()
