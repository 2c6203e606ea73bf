"""Command line: one daily run, as the original job is run once per drop.

    python -m histwright run-day --root WAREHOUSE --kind type2 \\
        --transactions drops/transactions_01032021.txt \\
        --terminals drops/terminals_01032021.csv --blacklist drops/passport_blacklist_01032021.csv \\
        --clients SRC --accounts SRC --cards SRC [--run-ts "2021-03-01 08:00:00"] [--compat legacy]

``SRC`` is a Parquet path, a catalog table name, or ``jdbc:<url>#<table>`` (credentials
from ``--jdbc-user`` / the ``JDBC_PASSWORD`` environment variable). A JDBC source is read in
parallel with ``--jdbc-partition NAME=COLUMN:LOWER:UPPER:PARTS``; without it the read would be one
task, which has to be allowed with ``--jdbc-one-task``. Terminal and blacklist drops are read as
``;``-separated text, as Parquet when the path ends in ``.parquet``, and as workbooks when it ends in
``.xlsx``; ``--sheet-decoder MODULE:FUNCTION`` names their decoder (``sources.files.read_workbook_sheet``).
The business date (file date of terminals) comes from the ``_DDMMYYYY`` file name.
"""

from __future__ import annotations

import argparse
import datetime as dt
import importlib
import os
import re

from pyspark.sql import SparkSession

from .plans import jobs
from .schemas import BLACKLIST_FILE_ORDER, TERMINALS_FILE_ORDER, TRANSACTIONS_FILE_ORDER
from .session import RECOMMENDED_CONF
from .sources.files import read_delimited, read_source_table, read_workbook_sheet

SOURCE_COLUMNS = {
    "clients": ["client_id", "last_name", "first_name", "patronymic", "date_of_birth",
                "passport_num", "passport_valid_to", "phone"],
    "accounts": ["account", "valid_to", "client"],
    "cards": ["card_num", "account"],
}


def _drop(spark: SparkSession, path: str, columns, sheet: str | None = None, decoder=None):
    if path.endswith(".parquet"):
        return spark.read.parquet(path).toDF(*columns)
    if sheet and path.endswith(".xlsx"):
        return read_workbook_sheet(spark, path, sheet, columns, decoder)
    return read_delimited(spark, path, columns)


def named_function(text: str | None):
    """The function ``MODULE:FUNCTION`` names; the module has to be importable on the executors, too."""
    if not text:
        return None
    module, _, name = text.partition(":")
    return getattr(importlib.import_module(module), name)


def jdbc_options(src: str, name: str, user: str | None = None, partitions=(), one_task: bool = False) -> dict[str, str]:
    """Options of a ``jdbc:<url>#<table>`` source; ``partitions`` hold ``NAME=COLUMN:LOWER:UPPER:PARTS``."""
    url, table = src.split("#", 1)
    opts = {"url": url, "dbtable": table}
    if user:
        opts.update(user=user, password=os.environ.get("JDBC_PASSWORD", ""))
    chosen = dict(p.split("=", 1) for p in partitions)
    if name in chosen:
        # Bounds may be times, which hold colons themselves.
        m = re.fullmatch(r"([^:]+):(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d|[^:]+):(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d|[^:]+):(\d+)",
                         chosen[name])
        if not m:
            raise ValueError(f"--jdbc-partition {name}: expected COLUMN:LOWER:UPPER:PARTS, got {chosen[name]!r}")
        opts.update(zip(("partitionColumn", "lowerBound", "upperBound", "numPartitions"), m.groups()))
    elif not one_task:
        raise ValueError(f"{name}: a JDBC read without --jdbc-partition {name}=... is one task; allow it with --jdbc-one-task")
    return opts


def _source(spark: SparkSession, src: str, name: str, user: str | None, partitions=(), one_task: bool = False):
    cols = SOURCE_COLUMNS[name]
    if src.startswith("jdbc:"):
        return read_source_table(spark, None, cols, jdbc=jdbc_options(src, name, user, partitions, one_task))
    if "/" in src or src.endswith(".parquet"):
        return spark.read.parquet(src).select(*cols)
    return read_source_table(spark, src, cols)


def file_day(path: str) -> str | None:
    m = re.search(r"_(\d{2})(\d{2})(\d{4})\.[^./]+$", path)
    return f"{m.group(3)}-{m.group(2)}-{m.group(1)} 00:00:00" if m else None


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="histwright")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run-day", help="stage, load and report one day; publish all or nothing")
    r.add_argument("--root", required=True)
    r.add_argument("--kind", choices=["type1", "type2"], default="type2")
    r.add_argument("--compat", choices=["default", "legacy"], default="default")
    for f in ("transactions", "terminals", "blacklist", "clients", "accounts", "cards"):
        r.add_argument(f"--{f}", required=True)
    r.add_argument("--run-ts", help="run clock (default: now, to the second)")
    r.add_argument("--jdbc-user")
    r.add_argument("--jdbc-partition", action="append", default=[], metavar="NAME=COLUMN:LOWER:UPPER:PARTS")
    r.add_argument("--jdbc-one-task", action="store_true")
    r.add_argument("--sheet-decoder", metavar="MODULE:FUNCTION")
    r.add_argument("--max-delete-fraction", type=float)
    a = p.parse_args(argv)

    b = SparkSession.builder.appName("histwright-run-day")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    decoder = named_function(a.sheet_decoder)
    source = {n: _source(spark, getattr(a, n), n, a.jdbc_user, a.jdbc_partition, a.jdbc_one_task) for n in SOURCE_COLUMNS}
    day = jobs.DayInputs(
        transactions=_drop(spark, a.transactions, TRANSACTIONS_FILE_ORDER),
        terminals=_drop(spark, a.terminals, TERMINALS_FILE_ORDER, "terminals", decoder),
        blacklist=_drop(spark, a.blacklist, BLACKLIST_FILE_ORDER, "blacklist", decoder),
        **source,
        terminals_ts=file_day(a.terminals),
        files=[os.path.basename(x) for x in (a.transactions, a.terminals, a.blacklist)])
    run_ts = a.run_ts or dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    if a.kind == "type2":
        state = jobs.run_type2_day(spark, a.root, day, run_ts, a.compat,
                                   max_delete_fraction=a.max_delete_fraction)
    else:
        state = jobs.run_type1_day(spark, a.root, day, run_ts)
    print(f"published run {state.run_id}: " + ", ".join(
        f"{t}={len(v)} segment(s)" for t, v in sorted(state.tables.items())))


if __name__ == "__main__":
    main()
