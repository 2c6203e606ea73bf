"""Reports against brute force: random small inputs (NULLs, midnight operations,
several versions per key, tombstones, repeated blacklist entries), compared with
the literal SQL (legacy) and its default form, run by DuckDB on the same rows."""

import datetime as dt
import random

import duckdb
import pytest

from histwright.operators import reports
from histwright.plans.report_sql import report
from scratch import scratch_dir

RUN = "2021-03-05 09:00:00"
OPEN = dt.datetime(9999, 12, 31)


def gen(seed):
    rnd = random.Random(seed)
    day = lambda: dt.date(2021, 3, rnd.randint(1, 4))
    tx = []
    for i in range(60):
        d = day()
        t = dt.datetime(d.year, d.month, d.day) if rnd.random() < 0.4 else \
            dt.datetime(d.year, d.month, d.day, rnd.randint(0, 23), rnd.choice([0, 30]))
        card = rnd.choice(["K1", "K2", "K3", "K4", "K5", None])
        tx.append((i, t, card))

    def versions(key, attrs_fn):
        out = []
        for v in range(rnd.randint(1, 3)):
            out.append((key, *attrs_fn(), dt.datetime(2021, 3, 1 + v), OPEN if v == 0 else
                        dt.datetime(2021, 3, 2 + v), rnd.choice(["N", "N", "Y"])))
        return out

    cards = [r for k in ["K1 ", "K2", "K3", " K4", "K5"]
             for r in versions(k, lambda: (rnd.choice(["A1", "A2", "A3", None]),))]
    accounts = [r for k in ["A1", "A2", "A3"] for r in versions(
        k, lambda: (rnd.choice([dt.date(2021, 3, 2), dt.date(2021, 3, 3), dt.date(2030, 1, 1), None]),
                    rnd.choice(["C1", "C2", "C3", None])))]
    clients = [r for k in ["C1", "C2", "C3"] for r in versions(
        k, lambda: (rnd.choice(["L", None]), "F", rnd.choice(["M", None]),
                    rnd.choice(["P1", "P2", "P3", None]),
                    rnd.choice([dt.date(2021, 3, 1), dt.date(2021, 3, 3), None]),
                    rnd.choice(["100", None])))]
    bl = [(dt.datetime(2021, 3, rnd.randint(1, 5)), rnd.choice(["P1", "P2", "P3"]))
          for _ in range(rnd.randint(0, 4))]
    prior = [(day(), *rnd.choice([("P1", "L F M", "100"), ("P2", None, None), ("P3", "x", "y"),
                                  (None, None, None), (None, "L F M", "100"), (None, None, "100")]),
              rnd.choice(["1", "2"])) for _ in range(rnd.randint(0, 9))]
    return tx, cards, accounts, clients, bl, prior


SCHEMAS = {
    "trans": "trans_id long, trans_date timestamp_ntz, card_num string",
    "cards": "card_num string, account_num string, effective_from timestamp_ntz, "
             "effective_to timestamp_ntz, deleted_flg string",
    "accounts": "account_num string, valid_to date, client string, effective_from timestamp_ntz, "
                "effective_to timestamp_ntz, deleted_flg string",
    "clients": "client_id string, last_name string, first_name string, patronymic string, "
               "passport_num string, passport_valid_to date, phone string, "
               "effective_from timestamp_ntz, effective_to timestamp_ntz, deleted_flg string",
    "blacklist": "entry_dt timestamp_ntz, passport_num string",
    "prior": "event_dt date, passport string, fio string, phone string, event_type string",
}

NAMES = dict(ops="trans", cards="cards", accounts="accounts", clients="clients", blacklist="blacklist")
SQL = {(which, compat): report(which, compat, **NAMES,
                               prior="seen" if (which, compat) == ("2", "legacy") else "prior")
       for which in "12" for compat in ("legacy", "default")}


def canon(rs):
    return sorted((tuple(None if v is None else str(v) for v in r) for r in rs), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_reports_equal_brute_force(spark, seed):
    data = dict(zip(SCHEMAS, gen(seed)))
    d = scratch_dir("rr-")
    frames = {}
    for n, rows_ in data.items():
        df = spark.createDataFrame(rows_, SCHEMAS[n])
        df.coalesce(1).write.parquet(f"{d}/{n}")
        frames[n] = spark.read.parquet(f"{d}/{n}")
    con = duckdb.connect()
    for n in SCHEMAS:
        con.execute(f"create view {n} as select * from read_parquet('{d}/{n}/*.parquet')")
    for compat in ("legacy", "default"):
        out = reports.run_reports(frames["trans"], frames["cards"], frames["accounts"],
                                  frames["clients"], frames["blacklist"], frames["prior"], RUN,
                                  compat).collect()
        r1 = [(r.event_dt, r.passport, r.fio, r.phone) for r in out if r.event_type == "1"]
        r2 = [(r.event_dt, r.passport, r.fio, r.phone) for r in out if r.event_type == "2"]
        e1 = con.execute(SQL[("1", compat)]).fetchall()
        assert canon(r1) == canon(e1), (seed, compat, "passport")
        con.execute("create or replace temp table seen as select event_dt, passport from prior")
        if compat == "legacy":
            con.execute(f"insert into seen select event_dt, passport from ({SQL[('1', 'legacy')]})")
        e2 = con.execute(SQL[("2", compat)]).fetchall()
        assert canon(r2) == canon(e2), (seed, compat, "contract")
