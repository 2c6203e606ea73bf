"""Time helpers: run clock, interval arithmetic, dates carried in file names."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TS, ts_lit

# Business date in a drop's file name: ``name_DDMMYYYY.ext``.
FILE_DATE_PATTERN = r"_(\d{8})\.[^.]+$"
FILE_DATE_FORMAT = "ddMMyyyy"


def stamp_text(value) -> str:
    """Run clock as text at second resolution (a ``timestamp(0)`` rounds half up); a clock
    with a zone is converted to UTC, the warehouse's zone."""
    if isinstance(value, str):
        value = _dt.datetime.fromisoformat(value)
    if isinstance(value, _dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(_dt.timezone.utc)
    if isinstance(value, _dt.date) and not isinstance(value, _dt.datetime):
        value = _dt.datetime(value.year, value.month, value.day)
    if value.microsecond >= 500_000:
        value = value + _dt.timedelta(seconds=1)
    return value.replace(microsecond=0, tzinfo=None).strftime("%Y-%m-%d %H:%M:%S")


def run_stamp(value) -> Column:
    """The run clock as a ``TIMESTAMP_NTZ`` literal; constant for a whole run."""
    return ts_lit(stamp_text(value))


def minus_seconds(c: Column, n: int = 1) -> Column:
    return c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(n))


def plus_days(c: Column, n: int = 1) -> Column:
    return c + F.make_dt_interval(F.lit(n))


def minus_days(c: Column, n: int = 1) -> Column:
    return c - F.make_dt_interval(F.lit(n))


def file_date(path_col: Column | None = None) -> Column:
    """Business date of a drop from its file name (``_DDMMYYYY``), as midnight ``TIMESTAMP_NTZ``.

    Defaults to the hidden ``_metadata.file_name`` column of file sources.
    """
    name = path_col if path_col is not None else F.col("_metadata.file_name")
    digits = F.regexp_extract(name, FILE_DATE_PATTERN, 1)
    return F.to_date(F.nullif(digits, F.lit("")), FILE_DATE_FORMAT).cast(TS)
