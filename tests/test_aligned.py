"""Three drop streams by business day: any order, any batches, one run a day, all files archived."""

import datetime as dt
import os
import time

import pytest

from histwright.plans import jobs, publish
from histwright.schemas import BLACKLIST_FILE_ORDER, TERMINALS_FILE_ORDER, TRANSACTIONS_FILE_ORDER
from histwright.sources import fixtures as fx
from histwright.sources.files import read_delimited
from histwright.streaming import aligned
from scratch import scratch_dir

SF = "/root/testdata/sf0.001"
PREFIX = ("transactions", "terminals", "passport_blacklist")


def drop(folder, day, *prefixes, ext="txt"):
    for p in prefixes or PREFIX:
        with open(f"{folder}/{p}_{day:02d}032021.{ext}", "w") as f:
            f.write("head\n")


@pytest.fixture
def place(spark):
    base = scratch_dir("aligned-")
    os.makedirs(f"{base}/in")
    ran = []

    def go(run=None, **kw):
        aligned.run_aligned(spark, f"{base}/in", run or (lambda day, paths: ran.append(day.day) or True),
                            checkpoint=f"{base}/ckpt", archive_dir=f"{base}/archive", **kw)

    return base, ran, go, lambda: {r.day[-2:]: r.status for r in aligned.open_days(spark, f"{base}/ckpt/status")}


def test_days_run_in_order_when_complete(place):
    base, ran, go, status = place
    drop(f"{base}/in", 2)
    drop(f"{base}/in", 1, "terminals")
    open(f"{base}/in/notes_01032021.txt", "w").close()
    go()
    # Day 2 is there, but day 1 is awaited.
    assert ran == [] and status() == {"01": "waiting", "02": "complete"}
    drop(f"{base}/in", 1, "passport_blacklist")
    drop(f"{base}/in", 3, "transactions")
    go(max_files=1)  # a file a batch
    assert ran == [] and status() == {"01": "waiting", "02": "complete", "03": "waiting"}
    drop(f"{base}/in", 1, "transactions")
    go()
    assert ran == [1, 2] and status() == {"03": "waiting"}
    assert sorted(os.listdir(f"{base}/archive")) == sorted(f"{p}_0{d}032021.txt" for p in PREFIX for d in (1, 2))
    assert sorted(os.listdir(f"{base}/in")) == ["notes_01032021.txt", "transactions_03032021.txt"]
    go()
    assert len(ran) == 2


def test_overdue_day_holds_no_other_and_conflict_is_not_run(place):
    base, ran, go, status = place
    drop(f"{base}/in", 1, "terminals", "transactions")
    go(patience=dt.timedelta(seconds=1))
    time.sleep(1.5)
    drop(f"{base}/in", 2)
    drop(f"{base}/in", 3)
    drop(f"{base}/in", 3, "terminals", ext="csv")
    go(patience=dt.timedelta(seconds=1))
    drop(f"{base}/in", 4)
    go(patience=dt.timedelta(seconds=1))
    assert ran == [2, 4] and status() == {"01": "overdue", "03": "conflict"}
    # The missing file comes after all: the day is complete, and the run decides that it is late.
    drop(f"{base}/in", 1, "passport_blacklist")
    go(run=lambda day, paths: False)
    assert status() == {"03": "conflict"}
    assert "terminals_01032021.txt" in os.listdir(f"{base}/in")


def test_failed_run_is_repeated(place):
    base, ran, go, status = place
    drop(f"{base}/in", 1)

    def fails(day, paths):
        raise RuntimeError("no executor")

    with pytest.raises(Exception, match="no executor"):
        go(run=fails)
    assert os.listdir(f"{base}/in") and not os.path.exists(f"{base}/archive")
    go()
    assert ran == [1] and status() == {} and not os.listdir(f"{base}/in")


def test_published_runs(spark, place):
    base, _, go, _ = place
    texts = {"transactions": (fx.transactions(spark, SF), TRANSACTIONS_FILE_ORDER),
             "terminals": (fx.terminals(spark, SF, 1), TERMINALS_FILE_ORDER),
             "passport_blacklist": (fx.blacklist(spark, SF), BLACKLIST_FILE_ORDER)}
    for p, (df, columns) in texts.items():
        rows = df.selectExpr(*[f"cast({c} as string) as {c}" for c in columns]).toPandas()
        for d in (1, 2):
            part = rows[int(rows.shape[0] / 2):] if d == 1 else rows[:int(rows.shape[0] / 2)]
            part.to_csv(f"{base}/in/{p}_0{d}032021.txt", sep=";", index=False)

    def inputs_for(day, paths):
        read = lambda kind, columns: read_delimited(spark, paths[kind], columns)
        return jobs.DayInputs(
            transactions=read("transactions", TRANSACTIONS_FILE_ORDER), terminals=read("terminals", TERMINALS_FILE_ORDER),
            blacklist=read("blacklist", BLACKLIST_FILE_ORDER), clients=fx.clients(spark, SF, day.day),
            accounts=fx.accounts(spark, SF, day.day), cards=fx.cards(spark, SF, day.day), terminals_ts=f"{day} 00:00:00")

    root = f"{base}/wh"
    go(run=aligned.job_runner(spark, root, inputs_for, lambda day: f"{day} 08:00:00", "type1"))
    state = publish.current(spark, root)
    assert state.run_id == "20210302T080000"
    assert state.read("fact_transactions_type1").count() == fx.transactions(spark, SF).count()
    names = [f"{p}_0{d}032021.txt" for p in PREFIX for d in (1, 2)]
    assert state.loaded(names) == set(names) == set(os.listdir(f"{base}/archive"))
