"""Versioned, all-or-nothing publishing of one run over every target table.

Layout under a warehouse ``root`` (any Hadoop-compatible shared path)::

    root/tables/<table>/run=<run_id>/attempt=<uuid>/...   data written by one attempt of a run
    root/_manifests/m-<seq>/part-*.json                   one row: the table map after a run

A table's current state is the union of the segment folders listed in the
manifest of greatest sequence number. Append-only tables (facts, reports, type-1 dimensions)
add one segment per run; a history dimension adds a ``closed`` segment (versions
closed by the run, never rewritten again) and replaces its ``open`` segment,
so a run rewrites only current versions, not the whole history. Small tables
(meta) are rewritten whole.

Every attempt writes to folders of its own, so nothing that a manifest lists is
ever overwritten: a failed run or re-run leaves only unreferenced folders. The
manifest is written last, to a folder of another name, and becomes visible by one rename that fails when
its name is taken: readers never see a half-published run, and of two runs that start from the
same state exactly one publishes (``AlreadyPublishedError`` for the other). The rename is atomic on
local disks and HDFS; an object store without atomic renames needs one writer at a time. A manifest folder without its ``_SUCCESS`` mark
is an unfinished publish and counts as not there; any other read error is raised.

Runs must come in the order of their run times: a run earlier than the published
one is refused (``LateRunError``), as its snapshots would rewrite later history.
The drop files of all runs are a table of their own (``loaded_files``).
"""

from __future__ import annotations

import errno
import os
import threading
import uuid
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import LEDGER, PARTITIONED, TABLES, empty

MANIFEST_SCHEMA = T.StructType([
    T.StructField("seq", T.LongType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("run_ts", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), T.ArrayType(T.StringType()))),
])
LOADED = "loaded_files"


class LateRunError(ValueError):
    """A run earlier than the published state, or one that is published already."""


class AlreadyPublishedError(RuntimeError):
    """Another run has published from the same state meanwhile."""


class PartlyLoadedError(ValueError):
    """Some, but not all, of a run's drop files are loaded."""


@dataclass
class State:
    """The published state a run starts from."""

    spark: SparkSession
    root: str
    run_id: str | None = None
    tables: dict[str, list[str]] = field(default_factory=dict)
    seq: int = 0
    # Segments written by a run in progress; committed manifests list only
    # segments that hold data, so only these need an existence check.
    pending: set[str] = field(default_factory=set)

    def segments(self, table: str) -> list[str]:
        return list(self.tables.get(table, []))

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """Current rows of ``table`` (empty with its schema when never written)."""
        schema = schema or (LEDGER if table == LOADED else TABLES[table])
        return self.scan(table, schema).select(*schema.fieldNames())

    def scan(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """As :meth:`read`, with the column that a partitioned table is stored by: a filter on
        it leaves folders unread."""
        schema = schema or (LEDGER if table == LOADED else TABLES[table])
        paths = [p for p in self.segments(table)
                 if p not in self.pending or has_data(self.spark, p)]
        if table not in PARTITIONED:
            return self.spark.read.schema(schema).parquet(*paths) if paths else empty(self.spark, schema)
        by = T.StructType([*schema.fields, T.StructField(PARTITIONED[table][0], T.IntegerType())])
        if not paths:
            return empty(self.spark, by)
        return (self.spark.read.schema(by).option("basePath", f"{self.root}/tables/{table}").parquet(*paths)
                .select(*by.fieldNames()))

    def loaded(self, files) -> set[str]:
        """Which of ``files`` are loaded (at most ``files`` rows reach the driver)."""
        names = sorted(set(files))
        if not names or not self.segments(LOADED):
            return set()
        got = self.read(LOADED).where(F.col("file").isin(names)).select("file").distinct()
        return {r.file for r in got.collect()}


def _files(spark: SparkSession, path: str):
    """(file system, path) of a folder; its errors are raised, not read as "not there"."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when the folder does not exist."""
    fs, p = _files(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def has_data(spark: SparkSession, path: str) -> bool:
    """Whether a segment folder holds data (a partition with no rows is not written)."""
    return any(n.endswith(".parquet") or "=" in n for n in _names(spark, path))


def write_segment(table: str, df: DataFrame, path: str) -> None:
    """Write one segment; a partitioned table by its column, with few files for each value and none that
    one task has to write alone when a value is frequent."""
    if table not in PARTITIONED:
        df.write.parquet(path)
        return
    name, by = PARTITIONED[table]
    days = [c for c in ("event_dt",) if c in df.columns]  # sorted, so their statistics skip what a run doesn't need
    (df.withColumn(name, by()).hint("rebalance", name).sortWithinPartitions(name, *days)
     .write.partitionBy(name).parquet(path))


def _sequence(spark: SparkSession, root: str) -> list[int]:
    """Sequence numbers of all manifest folders, finished or not, latest first."""
    return sorted((int(n[2:]) for n in _names(spark, f"{root}/_manifests") if n.startswith("m-")),
                  reverse=True)


def _manifest_path(root: str, seq: int) -> str:
    return f"{root}/_manifests/m-{seq:09d}"


def _make_visible(spark: SparkSession, made: str, path: str) -> None:
    """Give a written folder its name in one step, which fails when the name is taken."""
    fs, src = _files(spark, made)
    dst = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs.getUri().getScheme() == "file":
        try:
            os.rename(src.toUri().getPath(), dst.toUri().getPath())  # refused onto a folder that holds files
        except OSError as e:
            if e.errno in (errno.ENOTEMPTY, errno.EEXIST):
                raise AlreadyPublishedError(path) from e
            raise
        return
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.valueOf("NONE")
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(dst.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(src, dst, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            raise AlreadyPublishedError(path) from e
        raise


def current(spark: SparkSession, root: str, before: str | None = None) -> State:
    """Latest published state (optionally the latest of a run strictly before ``before``)."""
    fs, top = _files(spark, root)
    if fs.exists(top) and not fs.getFileStatus(top).isDirectory():
        raise ValueError(f"warehouse root {root} is not a folder")
    for seq in _sequence(spark, root):
        path = _manifest_path(root, seq)
        if "_SUCCESS" not in _names(spark, path):
            continue
        rows = spark.read.schema(MANIFEST_SCHEMA).option("mode", "FAILFAST").json(path).collect()
        if len(rows) != 1 or rows[0].run_id is None or rows[0].tables is None:
            raise ValueError(f"manifest {path} is damaged: {len(rows)} usable rows")
        r = rows[0]
        if before is None or r.run_id < before:
            return State(spark, root, r.run_id, {k: list(v) for k, v in r.tables.items()}, seq)
    return State(spark, root)


def start(spark: SparkSession, root: str, run_id: str, redo: bool = False) -> State:
    """The state that run ``run_id`` builds on; ``LateRunError`` when it must not run any more.

    ``redo`` repeats the latest published run on the state before it.
    """
    state = current(spark, root)
    if state.run_id is None or run_id > state.run_id:
        return state
    if run_id == state.run_id and redo:
        return current(spark, root, before=run_id)
    raise LateRunError(f"run {run_id} is not after the published run {state.run_id}")


class Run:
    """One run's writes: segments are written as they come, the manifest at ``commit``."""

    def __init__(self, state: State, run_id: str, run_ts: str, files=()):
        self.state = state
        self.spark = state.spark
        self.root = state.root
        self.run_id = run_id
        self.run_ts = run_ts
        self.attempt = uuid.uuid4().hex
        self.files = sorted(set(files))
        self.tables = {k: list(v) for k, v in state.tables.items()}
        self.written: set[str] = set()
        self._after = max(_sequence(self.spark, self.root), default=0)
        self._lock = threading.Lock()  # segments may be written from several threads

    def path(self, table: str) -> str:
        """This attempt's own folder of ``table``."""
        return f"{self.root}/tables/{table}/run={self.run_id}/attempt={self.attempt}"

    def append(self, table: str, df: DataFrame, part: str | None = None) -> str:
        """Add ``df`` as this run's segment (or a named part of it) of an append-only table."""
        path = self.path(table) + (f"/part={part}" if part else "")
        write_segment(table, df, path)
        with self._lock:
            self.tables[table] = [p for p in self.tables.get(table, []) if p != path] + [path]
            self.written.add(path)
        return path

    def replace(self, table: str, df: DataFrame) -> str:
        """Rewrite a small table whole."""
        path = self.path(table)
        df.write.parquet(path)
        with self._lock:
            self.tables[table] = [path]
            self.written.add(path)
        return path

    def history(self, table: str, delta: DataFrame) -> list[str]:
        """Write a history dimension's run output: closed versions join the history for
        good; the open versions replace the previous open segment.

        One job: the output is partitioned by ``segment`` on write.
        """
        path = self.path(table)
        seg = F.when(F.col("effective_to") == F.lit("9999-12-31 00:00:00").cast("timestamp_ntz"),
                     F.lit("open")).otherwise(F.lit("closed"))
        delta.withColumn("segment", seg).write.partitionBy("segment").parquet(path)
        closed, opened = f"{path}/segment=closed", f"{path}/segment=open"
        with self._lock:
            old = [p for p in self.tables.get(table, [])
                   if not p.endswith("/segment=open") and not p.startswith(path)]
            self.tables[table] = old + [closed, opened]
            self.written |= {closed, opened}
        return [closed, opened]

    def compact(self, table: str, keep_open: bool = True, transform=None) -> str | None:
        """Rewrite a table's segments into one segment of this run (small-files
        maintenance). For a history table the current ``open`` segment is kept
        as it is and only the closed segments are merged. Readers of older runs
        keep their files."""
        segs = self.tables.get(table, [])
        opened = [p for p in segs if keep_open and p.endswith("/segment=open")]
        merge = [p for p in segs if p not in opened]
        if len(merge) < 2:
            return None
        path = f"{self.path(table)}/part=compacted"
        df = State(self.spark, self.root, self.run_id, {table: merge},
                   pending=self.written).read(table)
        if transform is not None:  # e.g. re-merge kept statistics
            df = transform(df)
        write_segment(table, df, path)
        with self._lock:
            self.tables[table] = [path] + opened
            self.written.add(path)
        return path

    def create(self, table: str) -> None:
        """Declare an empty table (its schema is in ``schemas.TABLES``)."""
        self.tables.setdefault(table, [])

    def drop(self, table: str) -> None:
        """Drop a table from the published state. Files stay for readers of older runs."""
        self.tables.pop(table, None)

    def read(self, table: str) -> DataFrame:
        """The table as this run has left it so far (written segments included)."""
        return self.now().read(table)

    def now(self) -> State:
        """The state as this run has left it so far."""
        return State(self.spark, self.root, self.run_id, self.tables, pending=self.written)

    def read_new(self, table: str) -> DataFrame:
        """Only what this run has written to the table."""
        own = [p for p in self.tables.get(table, []) if p in self.written]
        return State(self.spark, self.root, self.run_id, {table: own}, pending=self.written).read(table)

    def store(self, name: str, df: DataFrame) -> DataFrame:
        """Write an intermediate result to this attempt's own folder and read it from there; no table lists it."""
        path = f"{self.path('work')}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def commit(self) -> State:
        """Publish the run: the ledger of its files, then one manifest row."""
        if self.files:
            self.append(LOADED, self.spark.createDataFrame(
                [(self.run_id, f) for f in self.files], LEDGER).coalesce(1))
        # Segments of this run that hold no data (no rows in a partition) are left out.
        tables = {k: [p for p in v if p not in self.written or has_data(self.spark, p)]
                  for k, v in self.tables.items()}
        seq = self._after + 1
        row = [(seq, self.run_id, self.run_ts, tables)]
        made = f"{self.root}/_manifests/.{self.run_id}-{self.attempt}"
        self.spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.json(made)
        _make_visible(self.spark, made, _manifest_path(self.root, seq))
        return State(self.spark, self.root, self.run_id, tables, seq)


def create_tables(spark: SparkSession, root: str, run_id: str, run_ts: str,
                  tables=tuple(TABLES)) -> State:
    """Publish a run that declares ``tables`` empty (the warehouse bootstrap)."""
    run = Run(start(spark, root, run_id), run_id, run_ts)
    for t in tables:
        run.create(t)
    return run.commit()


def drop_tables(spark: SparkSession, root: str, run_id: str, run_ts: str,
                tables=tuple(TABLES)) -> State:
    """Publish a run without ``tables`` (the warehouse reset)."""
    run = Run(start(spark, root, run_id), run_id, run_ts)
    for t in tables:
        run.drop(t)
    return run.commit()


def compact_tables(spark: SparkSession, root: str, run_id: str, run_ts: str,
                   tables=None) -> State:
    """Publish a maintenance run that merges the segments of ``tables`` (default: all)."""
    from ..operators.reports import latest_profiles, merge_statistics

    merges = {"fact_card_day_stats": merge_statistics, "card_profile": latest_profiles}
    run = Run(start(spark, root, run_id), run_id, run_ts)
    for t in tables or list(run.tables):
        if t in TABLES:
            run.compact(t, transform=merges.get(t))
    return run.commit()
