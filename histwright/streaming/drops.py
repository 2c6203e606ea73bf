"""Incoming drops as a file stream: one daily run per drop file.

A Structured Streaming file source watches the drop folder for
``transactions_DDMMYYYY.txt`` files. Each micro-batch takes one file
(``maxFilesPerTrigger=1``), so a batch is one business day; ``foreachBatch``
runs the daily job for it and publishes. The stream's checkpoint records which
files were taken; the warehouse manifest records which files were published
(the job skips a file already published, so a batch replayed after a failure
between publish and checkpoint does not load twice). With ``archive_dir`` the
source moves processed files there (Spark archives a file once a later batch
has started, so the newest file stays in place until the next run).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import file_date
from ..schemas import TRANSACTIONS_FILE_ORDER
from ..session import ensure_checkpoint_dir
from ..sources.files import text_schema

DROP_GLOB = "transactions_*.txt"


def drop_stream(spark: SparkSession, drop_dir: str, archive_dir: str | None = None,
                sep: str = ";", pattern: str = DROP_GLOB) -> DataFrame:
    """Streaming frame of transaction drops: text columns by position, plus
    ``file_name`` and ``file_date`` (from the ``_DDMMYYYY`` name)."""
    r = (spark.readStream.schema(text_schema(TRANSACTIONS_FILE_ORDER)).option("sep", sep)
         .option("header", True).option("enforceSchema", True)
         .option("maxFilesPerTrigger", 1).option("pathGlobFilter", pattern))
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = r.csv(drop_dir)
    return df.select("*", F.col("_metadata.file_name").alias("file_name"),
                     file_date().alias("file_date"))


def run_drops(spark: SparkSession, drop_dir: str, handle: Callable[[DataFrame, int], None],
              checkpoint: str | None = None, archive_dir: str | None = None,
              name: str = "drops", wait: bool = True):
    """Process every drop present now (``availableNow``), one batch per file.

    ``handle(batch_df, batch_id)`` runs the day (see ``day_handler``). The
    checkpoint defaults to ``<spark.checkpoint.dir>/streams/<name>``.
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/{name}"
    q = (drop_stream(spark, drop_dir, archive_dir).writeStream.foreachBatch(handle)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def day_handler(spark: SparkSession, root: str, inputs_for: Callable, run_ts_for: Callable,
                kind: str = "type2", compat: str = "default"):
    """A ``foreachBatch`` function running the daily job of each batch's drop.

    ``inputs_for(batch_df, file_date, file_name)`` returns the day's
    ``DayInputs`` (the batch supplies the transactions); ``run_ts_for(file_date)``
    the run clock. Only the batch's file name and date reach the driver.
    """
    from ..plans import jobs

    def handle(batch: DataFrame, batch_id: int) -> None:
        meta = batch.select("file_name", "file_date").distinct().collect()
        for m in meta:  # one file per batch (maxFilesPerTrigger=1)
            rows = batch.where(F.col("file_name") == m.file_name).drop("file_name", "file_date")
            day = inputs_for(rows, m.file_date, m.file_name)
            if kind == "type2":
                jobs.run_type2_day(spark, root, day, run_ts_for(m.file_date), compat)
            else:
                jobs.run_type1_day(spark, root, day, run_ts_for(m.file_date))

    return handle
