"""Golden micro-scenarios: three days of cards, two of terminals, both reports."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scratch import rows
from histwright.functions import run_stamp
from histwright.operators import dims_type2 as d2
from histwright.operators import reports
from histwright.schemas import BLACKLIST, CARDS, TERMINALS, TS, empty

OPEN = "9999-12-31 00:00:00"


def snap(spark, spec, data, stamp):
    df = spark.createDataFrame(data, f"{spec.key} string, " + ", ".join(
        f"{a} string" for a in spec.attrs))
    return df.withColumn("update_dt", run_stamp(stamp))


CARD_DAYS = [
    [("C1", "A1"), ("C2", "A2"), ("C3", None), ("C4", "A4"), ("C5", "A5")],
    [("C1", "A1"), ("C2", "A9"), ("C3", "A3"), ("C6", "A6")],
    [("C1", "A1"), ("C2", "A9"), ("C3", None), ("C6", "A6"), ("C4", "A4"), ("C5", "A7")],
]
CARD_STAMPS = ["2021-03-01 08:00:00", "2021-03-02 08:00:00", "2021-03-03 08:00:00"]

CARDS_COMMON = [
    ("C1", "A1", "2021-03-01 08:00:00", OPEN, "N"),
    ("C2", "A2", "2021-03-01 08:00:00", "2021-03-02 07:59:59", "N"),
    ("C2", "A9", "2021-03-02 08:00:00", OPEN, "N"),
    ("C3", None, "2021-03-01 08:00:00", "2021-03-02 07:59:59", "N"),
    ("C3", "A3", "2021-03-02 08:00:00", "2021-03-03 07:59:59", "N"),
    ("C3", None, "2021-03-03 08:00:00", OPEN, "N"),
    ("C4", "A4", "2021-03-01 08:00:00", "2021-03-02 07:59:59", "N"),
    ("C5", "A5", "2021-03-01 08:00:00", "2021-03-02 07:59:59", "N"),
    ("C5", "A5", "2021-03-02 08:00:00", "2021-03-03 07:59:59", "Y"),
    ("C5", "A7", "2021-03-03 08:00:00", OPEN, "N"),
    ("C6", "A6", "2021-03-02 08:00:00", OPEN, "N"),
]
CARDS_LEGACY = CARDS_COMMON + [("C4", "A4", "2021-03-02 08:00:00", OPEN, "Y")]
CARDS_DEFAULT = CARDS_COMMON + [("C4", "A4", "2021-03-02 08:00:00", "2021-03-03 07:59:59", "Y"),
                                ("C4", "A4", "2021-03-03 08:00:00", OPEN, "N")]


def replay(spark, spec, days, stamps, compat, fn=d2.apply_snapshot):
    h = empty(spark, spec.history_schema)
    for data, ts in zip(days, stamps):
        h = fn(h, snap(spark, spec, data, ts), spec, ts, compat)
    return h


def srt(xs):
    return sorted(xs, key=repr)


@pytest.mark.parametrize("fn", [d2.apply_snapshot, d2.apply_stepwise])
@pytest.mark.parametrize("compat,expected", [("legacy", CARDS_LEGACY), ("default", CARDS_DEFAULT)])
def test_cards_three_days(spark, fn, compat, expected):
    h = replay(spark, CARDS, CARD_DAYS, CARD_STAMPS, compat, fn)
    assert rows(h) == srt(expected)


TERM_DAYS = [
    [("P1", "POS", "X", "a"), ("P2", "ATM", "Y", "b"), ("P3", "POS", "Z", "c")],
    [("P1", "POS", "X", "a"), ("P2", "ATM", "Y", "b2")],
]
TERM_STAMPS = ["2021-03-01 00:00:00", "2021-03-02 00:00:00"]
TERM_COMMON = [
    ("P1", "POS", "X", "a", "2021-03-01 00:00:00", OPEN, "N"),
    ("P2", "ATM", "Y", "b", "2021-03-01 00:00:00", "2021-03-01 23:59:59", "N"),
    ("P2", "ATM", "Y", "b2", "2021-03-02 00:00:00", OPEN, "N"),
    ("P3", "POS", "Z", "c", "2021-03-02 00:00:00", OPEN, "Y"),
]


@pytest.mark.parametrize("fn", [d2.apply_snapshot, d2.apply_stepwise])
def test_terminals_two_days(spark, fn):
    legacy = replay(spark, TERMINALS, TERM_DAYS, TERM_STAMPS, "legacy", fn)
    assert rows(legacy) == srt(TERM_COMMON + [
        ("P3", "POS", "Z", "c", "2021-02-28 00:00:00", "2021-02-28 23:59:59", "N")])
    default = replay(spark, TERMINALS, TERM_DAYS, TERM_STAMPS, "default", fn)
    assert rows(default) == srt(TERM_COMMON + [
        ("P3", "POS", "Z", "c", "2021-03-01 00:00:00", "2021-03-01 23:59:59", "N")])


def test_rerun_same_day_is_noop(spark):
    h = replay(spark, TERMINALS, TERM_DAYS, TERM_STAMPS, "default")
    again = d2.apply_snapshot(h, snap(spark, TERMINALS, TERM_DAYS[1], TERM_STAMPS[1]),
                              TERMINALS, TERM_STAMPS[1])
    assert rows(again) == rows(h)


# --- reports -------------------------------------------------------------------------------


def _hist(spark, schema_ddl, data, stamp="2021-03-01 08:00:00"):
    df = spark.createDataFrame(data, schema_ddl)
    return (df.withColumn("effective_from", run_stamp(stamp))
            .withColumn("effective_to", F.lit(OPEN).cast(TS))
            .withColumn("deleted_flg", F.lit("N")))


@pytest.fixture(scope="module")
def report_inputs(spark):
    tx = spark.createDataFrame([
        (1, "2021-03-01 00:00:00", "K1"), (2, "2021-03-01 10:00:00", "K1"),
        (3, "2021-03-01 09:00:00", "K2"), (4, "2021-03-01 00:00:00", "K3"),
        (5, "2021-03-01 12:00:00", "K4"), (6, "2021-03-01 11:00:00", "K9"),
        (7, "2021-03-01 15:00:00", "K1"), (8, "2021-03-01 08:00:00", "K3"),
        (9, "2021-03-02 10:00:00", "K1")], "trans_id long, t string, card_num string"
    ).select("trans_id", F.col("t").cast(TS).alias("trans_date"), "card_num")
    cards = _hist(spark, "card_num string, account_num string",
                  [("K1 ", "A1"), ("K2", "A2"), ("K3", "A3"), ("K4", "A4")])
    accounts = _hist(spark, "account_num string, valid_to date, client string", [
        ("A1", dt.date(2030, 1, 1), "CL1"), ("A2", dt.date(2021, 2, 1), "CL2"),
        ("A3", dt.date(2030, 1, 1), "CL3"), ("A4", dt.date(2020, 1, 1), None)])
    clients = _hist(spark, "client_id string, last_name string, first_name string, "
                           "patronymic string, passport_num string, passport_valid_to date, "
                           "phone string", [
        ("CL1", "L1", "F1", "M1", "P1", dt.date(2021, 3, 1), "101"),
        ("CL2", "L2", "F2", None, "P2", None, "102"),
        ("CL3", "L3", "F3", "M3", "P3", dt.date(2030, 1, 1), "103")])
    bl = spark.createDataFrame([("P3", "2021-03-01 00:00:00"), ("P2", "2021-03-05 00:00:00")],
                               "passport_num string, e string").select(
        F.col("e").cast(TS).alias("entry_dt"), "passport_num").toDF(*BLACKLIST.fieldNames())
    prior = spark.createDataFrame([(dt.date(2021, 3, 1), "P3", "1"), (dt.date(2021, 3, 2), "P1", "1")],
                                  "event_dt date, passport string, event_type string")
    return dict(trans=tx, cards=cards, accounts=accounts, clients=clients, blacklist=bl,
                prior=prior)


def _rep(df):
    return sorted(((r.event_dt.isoformat(), r.passport, r.fio, r.phone, r.event_type)
                   for r in df.collect()), key=repr)


def test_passport_events(spark, report_inputs):
    i = report_inputs
    args = (i["trans"], i["cards"], i["accounts"], i["clients"], i["blacklist"], i["prior"],
            "2021-03-03 09:00:00")
    legacy = reports.passport_events(*args, compat="legacy")
    assert _rep(legacy) == sorted([
        ("2021-03-01", "P1", "L1 F1 M1", "101", "1"), ("2021-03-01", "P3", "L3 F3 M3", "103", "1"),
        ("2021-03-02", "P1", "L1 F1 M1", "101", "1")], key=repr)
    default = reports.passport_events(*args, compat="default")
    assert _rep(default) == [("2021-03-01", "P1", "L1 F1 M1", "101", "1")]


def test_contract_events(spark, report_inputs):
    i = report_inputs
    for compat in ("legacy", "default"):
        out = reports.run_reports(i["trans"], i["cards"], i["accounts"], i["clients"],
                                  i["blacklist"], i["prior"], "2021-03-03 09:00:00", compat)
        r2 = out.where("event_type = '2'")
        assert _rep(r2) == sorted([("2021-03-01", "P2", None, "102", "2"),
                                   ("2021-03-01", None, None, None, "2")], key=repr)
        assert {str(r.report_dt) for r in out.collect()} == {"2021-03-03 09:00:00"}
