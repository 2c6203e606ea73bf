"""One pass for both reports of a run: what its plan does once, and legacy suppression by rows of the same run."""

import datetime as dt

import pytest

from histwright.operators import reports
from histwright.plans import day
from histwright.sources import fixtures as fx
from scratch import rows
from test_jobs import day_inputs

HIST = "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string"
RUN = "2021-03-10 08:00:00"


def _frames(spark):
    at = (dt.datetime(2021, 1, 1), dt.datetime(9999, 12, 31), "N")
    ops = [(c, dt.datetime(2021, 3, d)) for c in ("1", "2", "3", "4") for d in (1, 2, 3)]
    ops += [("1", dt.datetime(2021, 3, 3, 5)), ("2", None), (None, dt.datetime(2021, 3, 1))]
    return dict(
        trans=spark.createDataFrame(ops, "card_num string, trans_date timestamp_ntz"),
        cards=spark.createDataFrame([("1", "a", *at), ("2", "b", *at), ("3", "c", *at), ("4", "d", *at)],
                                    f"card_num string, account_num string, {HIST}"),
        accounts=spark.createDataFrame([(a, c, dt.date(2021, 2, 1), *at) for a, c in
                                        (("a", "A"), ("b", "B"), ("c", "none"), ("d", "D"))],
                                       f"account_num string, client string, valid_to date, {HIST}"),
        clients=spark.createDataFrame([("A", "a", "a", "a", "PA", None, "1", *at), ("B", "b", "b", "b", "PB", None, "2", *at),
                                       ("D", "d", "d", "d", None, None, "4", *at)],
                                      "client_id string, last_name string, first_name string, patronymic string, "
                                      f"passport_num string, passport_valid_to date, phone string, {HIST}"),
        blacklist=spark.createDataFrame([(dt.datetime(2021, 3, 2), "PB"), (dt.datetime(2021, 3, 3), "PA")],
                                        "entry_dt timestamp_ntz, passport_num string"),
        prior=spark.createDataFrame([(dt.date(2021, 3, 1), "PA", None, None, "2"), (dt.date(2021, 3, 1), "PA", "x", "1", "1"),
                                     (dt.date(2021, 3, 2), "PB", None, None, "1"), (dt.date(2021, 3, 1), None, None, None, "2")],
                                    "event_dt date, passport string, fio string, phone string, event_type string"))


def _plan(df):
    df._jdf.queryExecution().toRdd().count()
    return df._jdf.queryExecution().executedPlan().toString().split("\n+- == Initial Plan ==")[0]


def test_legacy_rows(spark):
    out = reports.run_reports(**_frames(spark), run_ts=RUN, compat="legacy")
    assert [(r.event_type, r.event_dt.day, r.passport) for r in
            out.orderBy("event_type", "event_dt", "passport", "phone").collect()] == [
        ("1", 3, "PA"), ("1", 3, "PB"),
        ("2", 1, None), ("2", 1, None), ("2", 1, "PB"), ("2", 2, None), ("2", 2, None), ("2", 2, "PA"),
        ("2", 3, None), ("2", 3, None), ("2", 3, "PA")]


@pytest.mark.parametrize("compat", ["default", "legacy"])
def test_operations_are_joined_once(spark, compat):
    text = _plan(reports.run_reports(**_frames(spark), run_ts=RUN, compat=compat))
    stats = [ln for ln in text.splitlines() if "partial_max(trans_date" in ln]
    assert len(stats) == 1, text


def test_second_day_does_not_run_the_first_again(spark):
    for compat in ("default", "legacy"):
        state = day.new_state(spark)
        for d in (1, 2):
            state = day.type2_day(state, day_inputs(spark, d), fx.DAY_STAMPS[d], compat)
        text = _plan(state["rep_fraud"])
        assert len([ln for ln in text.splitlines() if "partial_max(trans_date" in ln]) == 2, compat
        assert len([ln for ln in text.splitlines() if "partial_min(_ct" in ln]) == 4, compat
    assert rows(state["rep_fraud"])
