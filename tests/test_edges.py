"""Edge cases: NULL attributes, NULL and duplicate keys, empty snapshot, padded
card numbers, NULL name parts, expiry day, midnight operations."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from scratch import rows
from histwright.functions import row_changed, run_stamp
from histwright.operators import dims_type2 as d2
from histwright.operators import reports
from histwright.schemas import CARDS, TS, empty

OPEN = "9999-12-31 00:00:00"


def snap(spark, data, stamp="2021-03-01 08:00:00"):
    return spark.createDataFrame(data, "card_num string, account_num string").withColumn(
        "update_dt", run_stamp(stamp))


def test_null_attribute_both_ways(spark):
    df = spark.createDataFrame([(None, None), ("a", None), (None, "a"), ("a", "a")], "x string, y string")
    got = [r.c for r in df.select(row_changed(["x"], left_cols=[F.col("x")],
                                              right_cols=[F.col("y")]).alias("c")).collect()]
    assert got == [False, True, True, False]


def test_null_keys_are_quarantined(spark):
    h = d2.apply_snapshot(empty(spark, CARDS.history_schema),
                          snap(spark, [("C1", "A1"), (None, "A2")]), CARDS, "2021-03-01 08:00:00")
    assert [r.card_num for r in h.collect()] == ["C1"]
    _, bad = d2.split_null_keys(snap(spark, [("C1", "A1"), (None, "A2")]), CARDS)
    assert bad.count() == 1


def test_duplicate_keys_fail(spark):
    h = d2.apply_snapshot(empty(spark, CARDS.history_schema),
                          snap(spark, [("C1", "A1"), ("C1", "A2")]), CARDS, "2021-03-01 08:00:00")
    with pytest.raises(Exception, match="duplicate card_num"):
        h.collect()


def test_empty_snapshot_tombstones_everything(spark):
    h = d2.apply_snapshot(empty(spark, CARDS.history_schema),
                          snap(spark, [("C1", "A1"), ("C2", None)]), CARDS, "2021-03-01 08:00:00")
    h2 = d2.apply_snapshot(h, snap(spark, []), CARDS, "2021-03-02 08:00:00")
    assert d2.live_rows(h2).count() == 0
    assert h2.where("deleted_flg = 'Y'").count() == 2


def _profile_inputs(spark, card_num, trans_times, valid_to, pvt, patronymic="M"):
    tx = spark.createDataFrame([(i, t, "K1") for i, t in enumerate(trans_times)],
                               "trans_id long, t string, card_num string").select(
        "trans_id", F.col("t").cast(TS).alias("trans_date"), "card_num")

    def hist(df):
        return (df.withColumn("effective_from", run_stamp("2021-03-01 08:00:00"))
                .withColumn("effective_to", F.lit(OPEN).cast(TS)).withColumn("deleted_flg", F.lit("N")))

    cards = hist(spark.createDataFrame([(card_num, "A1")], "card_num string, account_num string"))
    acc = hist(spark.createDataFrame([("A1", valid_to, "CL1")],
                                     "account_num string, valid_to date, client string"))
    cli = hist(spark.createDataFrame(
        [("CL1", "L", "F", patronymic, "P1", pvt, "1")],
        "client_id string, last_name string, first_name string, patronymic string, "
        "passport_num string, passport_valid_to date, phone string"))
    bl = spark.createDataFrame([], "entry_dt timestamp_ntz, passport_num string")
    prior = spark.createDataFrame([], "event_dt date, passport string, event_type string")
    return tx, cards, acc, cli, bl, prior


def test_padded_card_numbers_match(spark):
    tx, cards, acc, cli, bl, prior = _profile_inputs(
        spark, "  K1  ", ["2021-03-02 10:00:00"], dt.date(2021, 3, 1), dt.date(2030, 1, 1))
    out = reports.contract_events(tx, cards, acc, cli, prior, "2021-03-03 00:00:00")
    assert out.count() == 1


def test_null_name_part_gives_null_fio(spark):
    tx, cards, acc, cli, bl, prior = _profile_inputs(
        spark, "K1", ["2021-03-02 10:00:00"], dt.date(2021, 3, 1), dt.date(2030, 1, 1),
        patronymic=None)
    r = reports.contract_events(tx, cards, acc, cli, prior, "2021-03-03 00:00:00").first()
    assert r.passport == "P1" and r.fio is None


@pytest.mark.parametrize("time,expected", [("2021-03-01 00:00:00", 0), ("2021-03-01 00:00:01", 1),
                                           ("2021-03-02 00:00:00", 1)])
def test_expiry_day(spark, time, expected):
    tx, cards, acc, cli, bl, prior = _profile_inputs(
        spark, "K1", [time], dt.date(2030, 1, 1), dt.date(2021, 3, 1))
    out = reports.passport_events(tx, cards, acc, cli, bl, prior, "2021-03-03 00:00:00")
    assert out.count() == expected


def test_midnight_operation_suppression(spark):
    tx, cards, acc, cli, bl, _ = _profile_inputs(
        spark, "K1", ["2021-03-02 00:00:00", "2021-03-03 10:00:00"], dt.date(2021, 3, 1),
        dt.date(2030, 1, 1))
    prior = spark.createDataFrame([(dt.date(2021, 3, 2), "P1", "2"), (dt.date(2021, 3, 3), "P1", "2")],
                                  "event_dt date, passport string, event_type string")
    legacy = reports.contract_events(tx, cards, acc, cli, prior, "2021-03-04 00:00:00", "legacy")
    # Legacy: only the midnight operation is matched by the earlier row.
    assert [str(r.event_dt) for r in legacy.collect()] == ["2021-03-03"]
    default = reports.contract_events(tx, cards, acc, cli, prior, "2021-03-04 00:00:00")
    assert default.count() == 0


def test_watermark_upsert_and_update_only(spark):
    from histwright.operators import meta
    stg = spark.createDataFrame([("2021-03-02 00:00:00",), ("2021-03-01 00:00:00",)], "u string") \
        .select(F.col("u").cast(TS).alias("update_dt"))
    seed = meta.seed(spark)
    up = {r.table_name: str(r.max_update_dt) for r in
          meta.update_watermark(seed, stg, "stg_terminals").collect()}
    assert up == {"first_etl": "1900-01-01 00:00:00", "stg_terminals": "2021-03-02 00:00:00"}
    only = meta.update_watermark(seed, stg, "stg_terminals", upsert=False)
    assert [r.table_name for r in only.collect()] == ["first_etl"]
    # An empty staging keeps the old mark.
    again = meta.update_watermark(meta.update_watermark(seed, stg, "stg_terminals"),
                                  stg.where("false"), "stg_terminals")
    assert {r.table_name: str(r.max_update_dt) for r in again.collect()} == up
