"""Properties of the history on random snapshots (seeded): single pass equals
step by step, one open version per key, abutting intervals, idempotent re-run,
live set equals the last snapshot."""

import datetime as dt
import random

import pytest

from scratch import rows
from histwright.functions import run_stamp
from histwright.operators import dims_type2 as d2
from histwright.schemas import CARDS, empty

STAMPS = ["2021-03-01 08:00:00", "2021-03-02 08:00:00", "2021-03-03 08:00:00",
          "2021-03-04 08:00:00"]


def random_days(seed, keys=40, days=4):
    rnd = random.Random(seed)
    out = []
    for _ in range(days):
        snap = []
        for k in range(keys):
            if rnd.random() < 0.2:
                continue  # absent (deleted or not yet created)
            acct = rnd.choice([None, "A1", "A2", "A3"])
            snap.append((f"K{k}", acct))
        out.append(snap)
    return out


def replay(spark, days, compat, fn):
    h = empty(spark, CARDS.history_schema)
    for data, ts in zip(days, STAMPS):
        s = spark.createDataFrame(data, "card_num string, account_num string").withColumn(
            "update_dt", run_stamp(ts))
        h = fn(h, s, CARDS, ts, compat)
    return h


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("compat", ["default", "legacy"])
def test_single_pass_equals_stepwise(spark, seed, compat):
    days = random_days(seed)
    one = rows(replay(spark, days, compat, d2.apply_snapshot))
    steps = rows(replay(spark, days, compat, d2.apply_stepwise))
    assert one == steps


@pytest.mark.parametrize("seed", [3])
def test_history_invariants(spark, seed):
    days = random_days(seed)
    h = replay(spark, days, "default", d2.apply_snapshot)
    data = rows(h)
    by_key = {}
    for k, _a, frm, to, flag in data:
        by_key.setdefault(k, []).append((frm, to, flag))
    one_sec = dt.timedelta(seconds=1)
    for k, vs in by_key.items():
        vs.sort()
        assert sum(1 for v in vs if v[1] == "9999-12-31 00:00:00") == 1, k
        for (f1, t1, _), (f2, _t2, _) in zip(vs, vs[1:]):
            assert dt.datetime.fromisoformat(t1) + one_sec == dt.datetime.fromisoformat(f2), k
    # Live set equals the last snapshot.
    live = {(r[0], r[1]) for r in data if r[3] == "9999-12-31 00:00:00" and r[4] == "N"}
    assert live == set(days[-1])
    # Re-running the last day changes nothing.
    s = spark.createDataFrame(days[-1], "card_num string, account_num string").withColumn(
        "update_dt", run_stamp(STAMPS[len(days) - 1]))
    again = d2.apply_snapshot(h, s, CARDS, STAMPS[len(days) - 1])
    assert rows(again) == data
