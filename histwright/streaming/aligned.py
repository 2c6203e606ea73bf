"""Three drop streams aligned by business day: a day runs once all its files are there.

A day's transactions, terminals and blacklist arrive as separate files, in any order and over any number of
micro-batches. A file stream lists arrivals (names only; contents are read by the run), state keyed by business
day gathers the three paths, and a processing-time timer marks a day ``overdue`` that stays incomplete.
Each change of a day's status goes to a small table, from which ``day_starter`` starts the complete days in the
order of days: a complete day waits while an earlier one is still ``waiting``, but not for an overdue one.

Statuses: ``waiting``, ``overdue``, ``complete``, ``conflict`` (two files of one kind; never run, someone has to
decide), ``loaded``, and ``late`` (complete only after a later day was published; ``apply_late_snapshot`` is for
those). Files are archived after their run is published. A batch replayed after a failure writes the same status
folder again, and a day whose files are all in the warehouse's ledger isn't loaded twice.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.timefn import file_date
from ..session import ensure_checkpoint_dir

#: Kinds of drops by the start of their file names.
KINDS = {"transactions": "transactions", "terminals": "terminals", "passport_blacklist": "blacklist"}
DROP_GLOB = "*_[0-9][0-9][0-9][0-9][0-9][0-9][0-9][0-9].*"
_FILES = "path string, modificationTime timestamp, length long, content binary"
_PATHS = "transactions string, terminals string, blacklist string"
STATUS = f"day string, status string, {_PATHS}"
_IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
_PLACE = {kind: i for i, kind in enumerate(KINDS.values())}


def arrivals(spark: SparkSession, drop_dir: str, max_files: int = 100) -> DataFrame:
    """Streaming ``day, kind, path`` of drops named ``<kind>_DDMMYYYY.<ext>``; other files are left alone."""
    name = F.element_at(F.split("path", "/"), -1)
    prefix = F.regexp_extract(name, r"^(.*)_\d{8}\.[^.]+$", 1)
    kind = F.coalesce(*[F.when(prefix == p, F.lit(k)) for p, k in KINDS.items()])
    return (spark.readStream.format("binaryFile").schema(_FILES).option("pathGlobFilter", DROP_GLOB)
            .option("maxFilesPerTrigger", max_files).load(drop_dir)
            .select(file_date(name).cast("date").cast("string").alias("day"), kind.alias("kind"), "path")
            .where("day IS NOT NULL AND kind IS NOT NULL"))


def day_status(files: DataFrame, patience: dt.timedelta) -> DataFrame:
    """A row for each change of a day: its status and the paths there are."""
    wait_ms = max(1, int(patience.total_seconds() * 1000))

    def track(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *have, status = state.get if state.exists else (None, None, None, "waiting")
        if state.hasTimedOut:
            status = "overdue"
        for part in parts:
            for kind, path in sorted(zip(part["kind"], part["path"])):
                at = _PLACE[kind]
                if have[at] not in (None, path):
                    status = "conflict"
                have[at] = have[at] or path
        if status != "conflict" and all(have):
            status = "complete"
            state.remove()
        else:
            state.update((*have, status))
            if status == "waiting":
                state.setTimeoutDuration(wait_ms)
        yield pd.DataFrame([(key[0], status, *have)], columns=["day", "status", *_PLACE])

    return files.groupBy("day").applyInPandasWithState(
        track, STATUS, f"{_PATHS}, status string", "update", GroupStateTimeout.ProcessingTimeTimeout)


def open_days(spark: SparkSession, status_dir: str) -> list:
    """The latest status of each day that isn't loaded, by day."""
    known = spark.read.schema(f"{STATUS}, batch long, step int").parquet(status_dir)
    last = known.groupBy("day").agg(F.max_by(F.struct("status", *_PLACE), F.struct("batch", "step")).alias("x"))
    return last.select("day", "x.*").where("status NOT IN ('loaded', 'late')").orderBy("day").collect()


def archive(spark: SparkSession, paths, archive_dir: str) -> None:
    """Move files to ``archive_dir``; those that are gone already were moved by an earlier try."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(archive_dir)
    fs = target.getFileSystem(conf)
    fs.mkdirs(target)
    for path in paths:
        src = jvm.org.apache.hadoop.fs.Path(path)
        if fs.exists(src) and not fs.rename(src, jvm.org.apache.hadoop.fs.Path(target, src.getName())):
            raise OSError(f"{path} was not moved to {archive_dir}")


def day_starter(spark: SparkSession, status_dir: str, run: Callable[[dt.date, dict], bool], archive_dir: str | None = None):
    """A ``foreachBatch`` function that starts complete days in order.

    ``run(day, paths)`` loads one day and tells whether it could: ``False`` means that a later
    day is published already. Only open days' file names reach the driver.
    """
    def handle(batch: DataFrame, batch_id: int) -> None:
        folder = f"{status_dir}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(f"{folder}/step=0")
        done = []
        for row in open_days(spark, status_dir):
            if row.status == "waiting":
                break
            if row.status != "complete":
                continue
            paths = {k: row[k] for k in _PLACE}
            loaded = run(dt.date.fromisoformat(row.day), paths)
            if loaded and archive_dir:
                archive(spark, paths.values(), archive_dir)
            done.append((row.day, "loaded" if loaded else "late", *paths.values()))
        if done:
            spark.createDataFrame(done, STATUS).write.mode("overwrite").parquet(f"{folder}/step=1")

    return handle


def job_runner(spark: SparkSession, root: str, inputs_for: Callable, run_ts_for: Callable, kind: str = "type2",
               compat: str = "default") -> Callable[[dt.date, dict], bool]:
    """``run`` of ``day_starter`` as the published daily job; ``inputs_for(day, paths)`` gives its ``DayInputs``."""
    from ..plans import jobs, publish

    def run(day: dt.date, paths: dict) -> bool:
        inputs = inputs_for(day, paths)
        inputs.files = [os.path.basename(p) for p in paths.values()]
        try:
            if kind == "type2":
                jobs.run_type2_day(spark, root, inputs, run_ts_for(day), compat)
            else:
                jobs.run_type1_day(spark, root, inputs, run_ts_for(day))
        except publish.LateRunError:
            return False
        return True

    return run


def run_aligned(spark: SparkSession, drop_dir: str, run: Callable[[dt.date, dict], bool], name: str = "aligned",
                checkpoint: str | None = None, archive_dir: str | None = None,
                patience: dt.timedelta = dt.timedelta(hours=12), max_files: int = 100):
    """Take every drop present now; state, timers and statuses live on in the checkpoint for the next call.

    Timers fire with the next arrivals: batches without new files are off, as a query with a processing-time
    timer would otherwise go on with such batches and never be done.
    """
    ckpt = checkpoint or f"{ensure_checkpoint_dir(spark)}/streams/{name}"
    status = day_status(arrivals(spark, drop_dir, max_files), patience)
    before = spark.conf.get(_IDLE_BATCHES)
    spark.conf.set(_IDLE_BATCHES, "false")  # a query keeps the setting it starts with
    try:
        q = (status.writeStream.outputMode("update").option("checkpointLocation", f"{ckpt}/query")
             .foreachBatch(day_starter(spark, f"{ckpt}/status", run, archive_dir)).trigger(availableNow=True).start())
    finally:
        spark.conf.set(_IDLE_BATCHES, before)
    q.awaitTermination()
    return q
