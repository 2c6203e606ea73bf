"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import decimal

import duckdb
import pytest

import __spark_entry__ as E
from histwright.plans import oracle, registry

SF = "/root/testdata/sf0.001"
TABLES = ["orders", "customer", "part", "lineitem"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, dt.datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, decimal.Decimal):
        return str(v)
    return str(v)


def canon(cols, rs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i]) for i in order) for r in rs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("key", sorted(registry.queries()))
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    got = df.collect()
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, got) == canon(ocols, cur.fetchall())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["event_dt", "passport", "fio", "phone", "event_type", "report_dt"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["hist_apply_terminals", "report_passport_events_legacy",
                                 "stage_transactions_typed", "meta_watermark"])
def test_results_do_not_depend_on_session_time_zone(spark, con, key):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Pacific/Kiritimati")
    try:
        df = E.queries()[key](spark, SF)
        got = df.collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    cur = con.execute(E.oracle_sql()[key])
    ocols = [d[0] for d in cur.description]
    assert canon(df.columns, got) == canon(ocols, cur.fetchall())
