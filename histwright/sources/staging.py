"""Staging: turn raw drops and source snapshots into typed, stamped frames.

Nothing is collected: each function is a projection that runs where the scan
runs. ANSI casts fail on malformed values, as the warehouse insert would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import run_stamp
from ..schemas import ACCOUNTS, BLACKLIST, CARDS, CLIENTS, TERMINALS, TRANSACTIONS, TS, DimSpec
from ..schemas import TRANSACTIONS_TYPE1


def amount_decimal(col: str | Column, precision: int = 12, scale: int = 2) -> Column:
    """Amount text with a decimal comma (``'12,50'``) as a decimal."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c.cast("string"), F.lit(","), F.lit(".")).cast(f"decimal({precision},{scale})")


def stamp(df: DataFrame, run_ts, column: str = "update_dt") -> DataFrame:
    """Add the run clock (constant for the whole run) as ``update_dt``."""
    return df.withColumn(column, run_stamp(run_ts))


def stage_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions (``trans_id`` long, ``trans_date`` timestamp, ``amt`` kept as text)."""
    cols = []
    for f in TRANSACTIONS.fields:
        c = F.col(f.name)
        cols.append((c.cast(f.dataType) if f.name in ("trans_id", "trans_date")
                     else c.cast("string")).alias(f.name))
    return raw.select(*cols)


def type1_transactions(staged: DataFrame) -> DataFrame:
    """Type-1 layout: id (widened to long, as the ids outgrow int), date only, decimal amount."""
    s = staged
    return s.select(
        F.col("trans_id").cast("long").alias("transactions_id"),
        F.to_date(F.col("trans_date").cast(TS)).alias("transactions_date"),
        F.col("card_num").cast("string"), F.col("oper_type").cast("string"),
        amount_decimal("amt").alias("amount"), F.col("oper_result").cast("string"),
        F.col("terminal").cast("string")).toDF(*TRANSACTIONS_TYPE1.fieldNames())


def stage_blacklist(raw: DataFrame) -> DataFrame:
    """Blacklist entries: the entry date (first ten characters) at midnight."""
    day = F.to_date(F.substring(F.col("entry_dt").cast("string"), 1, 10))
    return raw.select(day.cast(TS).alias("entry_dt"),
                      F.col("passport_num").cast("string")).toDF(*BLACKLIST.fieldNames())


def stage_snapshot(raw: DataFrame, spec: DimSpec, run_ts, rename: dict | None = None) -> DataFrame:
    """A dimension snapshot: rename source columns, type them, stamp ``update_dt``."""
    df = raw
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    schema = spec.snapshot_schema
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields
            if f.name != "update_dt"]
    return stamp(df.select(*cols), run_ts)


def stage_terminals(raw: DataFrame, run_ts) -> DataFrame:
    return stage_snapshot(raw, TERMINALS, run_ts)


def stage_cards(raw: DataFrame, run_ts) -> DataFrame:
    return stage_snapshot(raw, CARDS, run_ts, {"account": "account_num"})


def stage_accounts(raw: DataFrame, run_ts) -> DataFrame:
    return stage_snapshot(raw, ACCOUNTS, run_ts, {"account": "account_num"})


def stage_clients(raw: DataFrame, run_ts) -> DataFrame:
    return stage_snapshot(raw, CLIENTS, run_ts)
