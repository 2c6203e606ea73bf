"""Day snapshots and drops derived from the driver's test tables.

The reference ships no data, so the test inputs are views over the TPC-H-like
tables: ``orders`` plays cards, ``customer`` accounts and clients, ``part``
terminals and ``lineitem`` transactions. Each day's snapshot is the whole
table; modular arithmetic on the ids models which rows the source changed,
added or removed between days (it is the change model, not a row cap).
Every frame here is lazy and reads whole tables.

The views are defined once, as SQL text (source table, select list, filter),
and used by both engines: Spark runs them through ``where`` + ``selectExpr``
(reading ``timestamp`` as ``timestamp_ntz``), the DuckDB oracle as a ``select``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TS

# Stamp of day k (k = 1, 2, 3) for source-table snapshots.
DAY_STAMPS = {1: "2021-03-01 08:00:00", 2: "2021-03-02 08:00:00", 3: "2021-03-03 08:00:00"}
# Terminals are stamped with the drop's file date at midnight.
FILE_DAY_STAMPS = {1: "2021-03-01 00:00:00", 2: "2021-03-02 00:00:00", 3: "2021-03-03 00:00:00"}

# Declared schemas of the driver tables this package reads (only the columns it
# uses): no inference job per read, and the scan reads just these columns.
TABLE_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, "
                "l_extendedprice double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
}

# name -> (source table or view, select list, filter or None)
VIEW_DEFS: dict[str, tuple[str, list[str], str | None]] = {
    "cards_d1": ("orders", [
        "cast(o_orderkey as string) as card_num",
        "case when o_orderkey % 11 = 0 then null else cast(o_custkey as string) end as account_num",
    ], "o_orderkey % 10 <> 9"),
    "cards_d2": ("orders", [
        "cast(o_orderkey as string) as card_num",
        "case when o_orderkey % 22 = 0 then null when o_orderkey % 7 = 0 then cast(o_custkey + 1 as string) "
        "else cast(o_custkey as string) end as account_num",
    ], "o_orderkey % 17 <> 3"),
    "cards_d3": ("orders", [
        "cast(o_orderkey as string) as card_num",
        "case when o_orderkey % 22 = 0 then null when o_orderkey % 7 = 0 then cast(o_custkey + 1 as string) "
        "when o_orderkey % 34 = 3 then cast(o_custkey + 2 as string) "
        "when o_orderkey % 13 = 5 then cast(o_custkey + 3 as string) "
        "else cast(o_custkey as string) end as account_num",
    ], None),
    "terminals_d1": ("part", [
        "cast(p_partkey as string) as terminal_id", "p_type as terminal_type",
        "p_brand as terminal_city", "p_name as terminal_address",
    ], "p_partkey % 10 <> 9"),
    "terminals_d2": ("part", [
        "cast(p_partkey as string) as terminal_id", "p_type as terminal_type",
        "case when p_partkey % 11 = 0 then null else p_brand end as terminal_city",
        "case when p_partkey % 7 = 0 then p_name || ' 2' else p_name end as terminal_address",
    ], "p_partkey % 17 <> 3"),
    "accounts_d1": ("customer", [
        "cast(c_custkey as string) as account_num",
        "date '1995-01-01' + cast((c_custkey * 37) % 2500 as int) as valid_to",
        "case when c_custkey % 23 = 0 then null else cast(c_custkey as string) end as client",
    ], "c_custkey % 10 <> 9"),
    "accounts_d2": ("customer", [
        "cast(c_custkey as string) as account_num",
        "date '1995-01-01' + cast((c_custkey * 37) % 2500 + case when c_custkey % 7 = 0 then 30 else 0 end "
        "as int) as valid_to",
        "case when c_custkey % 23 = 0 then null else cast(c_custkey as string) end as client",
    ], "c_custkey % 17 <> 3"),
    "clients_d1": ("customer", [
        "cast(c_custkey as string) as client_id", "c_name as last_name", "c_mktsegment as first_name",
        "case when c_custkey % 19 = 0 then null else 'N' || cast(c_nationkey as string) end as patronymic",
        "date '1960-01-01' + cast((c_custkey * 11) % 15000 as int) as date_of_birth",
        "'PS' || cast(c_custkey as string) as passport_num",
        "case when c_custkey % 13 = 0 then null else date '1996-01-01' + cast((c_custkey * 53) % 2500 as int) "
        "end as passport_valid_to",
        "'+7' || cast(c_custkey as string) as phone",
    ], "c_custkey % 10 <> 9"),
    "clients_d2": ("customer", [
        "cast(c_custkey as string) as client_id", "c_name as last_name", "c_mktsegment as first_name",
        "case when c_custkey % 19 = 0 then 'X' else 'N' || cast(c_nationkey as string) end as patronymic",
        "date '1960-01-01' + cast((c_custkey * 11) % 15000 as int) as date_of_birth",
        "'PS' || cast(c_custkey as string) as passport_num",
        "case when c_custkey % 13 = 0 then null else date '1996-01-01' + cast((c_custkey * 53) % 2500 as int) "
        "end as passport_valid_to",
        "case when c_custkey % 7 = 0 then null else '+7' || cast(c_custkey as string) end as phone",
    ], "c_custkey % 17 <> 3"),
    "blacklist": ("customer", [
        "cast(date '1998-01-01' + cast(c_custkey % 1000 as int) as timestamp) as entry_dt",
        "'PS' || cast(c_custkey as string) as passport_num",
    ], "c_acctbal < 0"),
    "transactions": ("lineitem", [
        "l_orderkey * 8 + l_linenumber as trans_id",
        "l_shipdate + interval '1' hour * cast(l_partkey % 24 as int) as trans_date",
        "cast(l_orderkey as string) as card_num", "l_returnflag as oper_type",
        "replace(cast(cast(l_extendedprice as decimal(12,2)) as string), '.', ',') as amt",
        "l_linestatus as oper_result", "cast(l_partkey as string) as terminal",
    ], None),
    # Ten orders to a customer, so the passports grow with the clients.
    "prior_report": ("transactions", [
        "cast(trans_date as date) as event_dt",
        "'PS' || cast(cast(floor(trans_id / 80) as bigint) as string) as passport",
        "cast(null as string) as fio", "cast(null as string) as phone",
        "case when trans_id % 2 = 0 then '1' else '2' end as event_type",
    ], None),
    "cards_keyless": ("cards_d0", [
        "case when cast(card_num as bigint) % 4 = 0 then null else card_num end as card_num", "account_num"], None),
    "cards_padded": ("cards_d0", ["card_num || '  ' as card_num", "account_num"], None),
}
# Whole snapshots (no key left out), and a second whole version of the clients.
for _dim in ("cards", "terminals", "accounts", "clients"):
    _src, _cols, _ = VIEW_DEFS[f"{_dim}_d1"]
    VIEW_DEFS[f"{_dim}_d0"] = (_src, _cols, None)
VIEW_DEFS["clients_d0_next"] = (*VIEW_DEFS["clients_d2"][:2], None)
DISTINCT_VIEWS = {"prior_report"}


def view_sql(name: str) -> str:
    """The view as a DuckDB ``select``."""
    src, cols, cond = VIEW_DEFS[name]
    d = "distinct " if name in DISTINCT_VIEWS else ""
    return f"select {d}{', '.join(cols)} from {src}" + (f" where {cond}" if cond else "")


def _spark_text(expr: str) -> str:
    # Warehouse timestamps are zone-less: ``timestamp`` is ``timestamp_ntz`` in Spark.
    expr = re.sub(r"\bas timestamp\)", "as timestamp_ntz)", expr)
    # ``ts + interval '1' hour * n`` is the same value as ``timestampadd(HOUR, n, ts)``,
    # which Spark evaluates without building an interval per row.
    return re.sub(r"(\w+) \+ interval '1' hour \* (cast\([^)]*\))",
                  r"timestampadd(HOUR, \2, \1)", expr)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view as a lazy ``DataFrame`` (filter, then projection)."""
    src, cols, cond = VIEW_DEFS[name]
    df = view(spark, sf_dir, src) if src in VIEW_DEFS else table(spark, sf_dir, src)
    if cond:
        df = df.where(cond)
    df = df.selectExpr(*[_spark_text(c) for c in cols])
    return df.distinct() if name in DISTINCT_VIEWS else df


def snapshot(spark: SparkSession, sf_dir: str, dim: str, day: int) -> DataFrame:
    return view(spark, sf_dir, f"{dim}_d{day}")


def cards(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return snapshot(spark, sf_dir, "cards", day)


def terminals(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return snapshot(spark, sf_dir, "terminals", day)


def accounts(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return snapshot(spark, sf_dir, "accounts", day)


def clients(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    return snapshot(spark, sf_dir, "clients", day)


def cards_padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-1 cards with trailing blanks on the card number (the source pads it)."""
    return view(spark, sf_dir, "cards_padded")


def blacklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "blacklist")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "transactions")


def prior_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Report rows of earlier runs: (event_dt, passport, fio, phone, event_type)."""
    return view(spark, sf_dir, "prior_report")


# Transaction batches: batch 1 is everything before 1999-01-01, batch 2 from
# 1998-06-01 on; they overlap on purpose (already loaded ids must be skipped).
BATCH1_BEFORE = "1999-01-01 00:00:00"
BATCH2_FROM = "1998-06-01 00:00:00"


def transactions_batch(spark: SparkSession, sf_dir: str, batch: int) -> DataFrame:
    t = transactions(spark, sf_dir)
    if batch == 1:
        return t.where(F.col("trans_date") < F.lit(BATCH1_BEFORE).cast(TS))
    if batch == 2:
        return t.where(F.col("trans_date") >= F.lit(BATCH2_FROM).cast(TS))
    raise ValueError(batch)
