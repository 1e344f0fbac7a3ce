"""Continuous statement import from a drop folder.

Files land in a folder; a file-source stream reads each new file once (the
stream's checkpoint records which files were processed, so a restarted or
retried query never imports a file twice) and every micro-batch runs the
batch import job on the files it received, and on those held from earlier
micro-batches because no statement had claimed them yet.  A statement that is
registered after its file is thus imported with the next file that arrives,
when the stream starts again, or by ``plans.jobs.import_held``.  Late or overlapping statements
need no watermark: dedup compares with all stored rows of overlapping
statements, as the batch job does.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.jobs import Lake, import_held, import_statements
from ..session import ensure_checkpoint_dir


def statement_files_stream(lake: Lake, drop_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming (file_path, file_name, content) rows, one per new file."""
    raw = (lake.spark.readStream.format("text").option("wholetext", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).load(drop_dir))
    return raw.select(F.col("_metadata.file_path").alias("file_path"),
                      F.col("_metadata.file_name").alias("file_name"),
                      F.col("value").alias("content"))


def start_import_stream(lake: Lake, control: DataFrame | str, drop_dir: str,
                        checkpoint: str | None = None, available_now: bool = False,
                        processing_time: str = "1 minute", bulk: bool = True) -> StreamingQuery:
    """Import every statement whose file arrives in ``drop_dir``.

    ``control`` is the statement table (a DataFrame, or a parquet path that is
    re-read each micro-batch so newly registered statements are seen).
    ``checkpoint`` defaults to a folder under the cluster's shared
    ``spark.checkpoint.dir``.
    """
    spark = lake.spark
    if checkpoint is None:
        checkpoint = os.path.join(ensure_checkpoint_dir(spark), "statement-import-stream")

    def statements() -> DataFrame:
        return spark.read.parquet(control) if isinstance(control, str) else control

    def run(batch: DataFrame, epoch_id: int) -> None:
        import_statements(lake, statements(), batch, bulk=bulk)

    import_held(lake, statements(), bulk=bulk)

    writer = (statement_files_stream(lake, drop_dir).writeStream.foreachBatch(run)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
