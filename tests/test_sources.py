"""Sources: delimited drops by position, workbook sheets, file dates, source tables."""

import datetime as dt
import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from histwright.functions import change_predicate_text, file_date, row_changed
from histwright.functions.compare import compared_columns
from histwright.session import cluster_conf
from histwright.schemas import (BLACKLIST_FILE_ORDER, CLIENTS, TERMINALS_FILE_ORDER,
                                TRANSACTIONS_FILE_ORDER)
from scratch import scratch_dir
from histwright.sources import staging
from histwright.sources.files import read_delimited, read_source_table, read_workbook_sheet


def test_delimited_by_position_header_ignored(spark):
    d = scratch_dir("csv-")
    path = f"{d}/transactions_01032021.txt"
    with open(path, "w") as f:
        f.write("x;y;z;w;v;u;t\n")  # header names are not used
        f.write("7;2021-03-01 10:00:00;12,50;K1;PAY;OK;T1\n")
        f.write("8;2021-03-01 11:30:00;3,00;K2;WDR;FAIL;T2\n")
    raw = read_delimited(spark, path, TRANSACTIONS_FILE_ORDER, with_file_date=True)
    assert raw.columns == [*TRANSACTIONS_FILE_ORDER, "file_date"]
    st = staging.stage_transactions(raw)
    r = st.orderBy("trans_id").collect()
    assert r[0].trans_id == 7 and r[0].amt == "12,50" and r[0].card_num == "K1"
    assert r[0].trans_date == dt.datetime(2021, 3, 1, 10, 0)
    amounts = [x.a for x in st.select(staging.amount_decimal("amt").alias("a")).orderBy("a").collect()]
    assert [str(a) for a in amounts] == ["3.00", "12.50"]
    assert {x.file_date for x in raw.collect()} == {dt.datetime(2021, 3, 1)}


def test_bad_amount_fails_under_ansi(spark):
    df = spark.createDataFrame([("12;5",)], "amt string")
    with pytest.raises(Exception):
        df.select(staging.amount_decimal("amt")).collect()


def test_file_date_from_name(spark):
    df = spark.createDataFrame([("passport_blacklist_03032021.xlsx",), ("nodate.txt",)], "n string")
    got = [r.d for r in df.select(file_date(F.col("n")).alias("d")).collect()]
    assert got == [dt.datetime(2021, 3, 3), None]


def test_workbook_sheet_with_decoder(spark):
    d = scratch_dir("xlsx-")
    for day in ("01", "02"):
        with open(f"{d}/terminals_{day}032021.xlsx", "wb") as f:
            f.write(f"P1,POS,City,addr {day}\nP2,ATM,Town,\n".encode())

    def decoder(content: bytes, sheet: str) -> pd.DataFrame:
        assert sheet == "terminals"
        rows = [line.split(",") for line in content.decode().splitlines()]
        return pd.DataFrame([[v or None for v in r] for r in rows])

    df = read_workbook_sheet(spark, d, "terminals", TERMINALS_FILE_ORDER,
                             decoder=decoder, with_file_date=True)
    got = sorted((r.terminal_id, r.terminal_address, str(r.file_date.date())) for r in df.collect())
    assert got == [("P1", "addr 01", "2021-03-01"), ("P1", "addr 02", "2021-03-02"),
                   ("P2", None, "2021-03-01"), ("P2", None, "2021-03-02")]


def test_source_table_rename_and_prune(spark):
    src = spark.createDataFrame([("A1", dt.date(2030, 1, 1), "CL1", "x")],
                                "account string, valid_to date, client string, extra string")
    df = read_source_table(spark, src, ["account", "valid_to", "client"],
                           rename={"account": "account_num"})
    assert df.columns == ["account_num", "valid_to", "client"]
    st = staging.stage_accounts(src.drop("extra"), "2021-03-01 08:00:00.6")
    assert str(st.first().update_dt) == "2021-03-01 08:00:01"


def test_change_predicate_text(spark):
    df = spark.createDataFrame([], CLIENTS.snapshot_schema)
    txt = [r.predicate for r in change_predicate_text(df).collect()]
    assert len(txt) == len(df.columns)
    assert txt[1] == "stg.last_name IS DISTINCT FROM tgt.last_name"


def test_blacklist_workbook_dates(spark):
    d = scratch_dir("xlsx-")
    with open(f"{d}/passport_blacklist_01032021.xlsx", "wb") as f:
        f.write(b"2021-03-01 00:00:00,P1\n2021-02-27,P2\n")

    def decoder(content: bytes, sheet: str) -> pd.DataFrame:
        return pd.DataFrame([line.split(",") for line in content.decode().splitlines()])

    raw = read_workbook_sheet(spark, d, "blacklist", BLACKLIST_FILE_ORDER, decoder=decoder)
    got = sorted((str(r.entry_dt), r.passport_num) for r in staging.stage_blacklist(raw).collect())
    assert got == [("2021-02-27 00:00:00", "P2"), ("2021-03-01 00:00:00", "P1")]


def test_compared_columns_drive_change_test(spark):
    snap = spark.createDataFrame([("C1", "L", "2021-03-01 08:00:00")],
                                 "client_id string, last_name string, update_dt string")
    cols = compared_columns(snap, exclude=["client_id"])
    assert cols == ["last_name"]
    a, b = snap.alias("a"), snap.withColumn("last_name", F.lit(None)).alias("b")
    j = a.join(b, "client_id").select(row_changed(cols, "a", "b").alias("c"))
    assert j.first().c is True


def test_cluster_conf_sizes_partitions():
    c = cluster_conf(total_cores=8000, largest_shuffle_bytes=40 << 40)
    assert int(c["spark.sql.shuffle.partitions"]) == (40 << 40) // (256 << 20)
    small = cluster_conf(total_cores=64, largest_shuffle_bytes=1 << 30)
    assert int(small["spark.sql.shuffle.partitions"]) == 128
    assert c["spark.sql.autoBroadcastJoinThreshold"] == "-1"
