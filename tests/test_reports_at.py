"""Point-in-time reports against one join per operation (DuckDB): random rows, versions that change within a day, a hot card."""

import duckdb
import pytest
from pyspark.sql import functions as F

from histwright.operators import reports_at
from histwright.plans import registry as R
from histwright.plans.report_sql import report_at
from histwright.sources import fixtures as fx
from scratch import scratch_dir
from test_reports_random import RUN, SCHEMAS, canon, gen

NAMES = dict(ops="trans", cards="cards", accounts="accounts", clients="clients", blacklist="blacklist", prior="prior")
HISTORIES = ("cards", "accounts", "clients")


def both(spark, frames):
    """(Spark's rows, DuckDB's rows) of each report over written frames."""
    d = scratch_dir("ra-")
    con = duckdb.connect()
    i = {}
    for n, df in frames.items():
        df.write.parquet(f"{d}/{n}")
        i[n] = spark.read.parquet(f"{d}/{n}")
        con.execute(f"create view {n} as select * from read_parquet('{d}/{n}/*.parquet')")
    dims = [i[n] for n in HISTORIES]
    out = {"1": reports_at.passport_events_at(i["trans"], *dims, i["blacklist"], i["prior"], RUN),
           "2": reports_at.contract_events_at(i["trans"], *dims, i["prior"], RUN)}
    return {w: (df, canon((r.event_dt, r.passport, r.fio, r.phone) for r in df.collect()),
                canon(con.execute(report_at(w, **NAMES)).fetchall())) for w, df in out.items()}


@pytest.mark.parametrize("seed", range(5))
def test_random_rows(spark, seed):
    frames = {n: spark.createDataFrame(rows, SCHEMAS[n]).coalesce(1) for n, rows in zip(SCHEMAS, gen(seed))}
    for n in HISTORIES:  # half of the versions change within a day, when operations run
        later = F.when(F.abs(F.hash("effective_from")) % 2 == 0, F.expr("interval 11 hours")).otherwise(
            F.expr("interval 0 hours"))
        frames[n] = frames[n].withColumn("effective_from", F.col("effective_from") + later)
    for which, (_, got, expected) in both(spark, frames).items():
        assert got == expected, (seed, which)


def test_hot_card(spark):
    """One card has a third of all operations, all on the day within which it comes back on another account."""
    sf = "/root/testdata/sf0.001"
    change = "1998-05-05 12:00:00"
    hot = F.col("trans_id") % 3 == 0
    at = F.expr("timestamp_ntz'1998-05-05 00:00:00' + make_dt_interval(0, 0, 0, trans_id % 86400)")
    tx = fx.transactions(spark, sf)
    tx = tx.withColumn("trans_date", F.when(hot, at).otherwise(F.col("trans_date").cast("timestamp_ntz"))).withColumn(
        "card_num", F.when(hot, F.lit("1")).otherwise(F.col("card_num")))
    frames = dict(trans=tx, **{n: R.history(spark, sf, n, 2) for n in HISTORIES}, blacklist=fx.blacklist(spark, sf),
                  prior=fx.prior_report(spark, sf))
    first = frames["cards"].where("card_num = '1'").limit(1)
    books = frames["accounts"].where("deleted_flg = 'N' and valid_to < date'1998-05-05'").select("account_num").distinct()
    two = [r.account_num for r in books.orderBy("account_num").limit(1).collect()]
    cards = frames["cards"].where("card_num <> '1'").unionByName(
        first.withColumns({"effective_from": F.lit("1998-01-01").cast("timestamp_ntz"), "deleted_flg": F.lit("Y")})).unionByName(
        first.withColumns({"effective_from": F.lit(change).cast("timestamp_ntz"), "deleted_flg": F.lit("N"),
                           "account_num": F.lit(two[0])}))
    got = both(spark, frames | {"cards": cards})
    for which, (df, rows, expected) in got.items():
        assert rows == expected and expected, which
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


def test_empty(spark):
    frames = {n: spark.createDataFrame([], s) for n, s in SCHEMAS.items()}
    assert all(got == expected == [] for _, got, expected in both(spark, frames).values())


def test_version_in_force_only(spark):
    """An operation before the contract's shortening is no event by the version then in force."""
    new = lambda *rows, s: spark.createDataFrame(list(rows), s)
    tx = spark.sql("select * from values (1L, timestamp_ntz'2021-03-02 09:00:00', 'K'), "
                   "(2L, timestamp_ntz'2021-03-02 13:00:00', 'K') t(trans_id, trans_date, card_num)")
    cards = spark.sql("select 'K ' card_num, 'A' account_num, timestamp_ntz'2021-03-01 00:00:00' effective_from, "
                      "timestamp_ntz'9999-12-31 00:00:00' effective_to, 'N' deleted_flg")
    accounts = spark.sql(
        "select 'A' account_num, date'2030-01-01' valid_to, 'C' client, timestamp_ntz'2021-03-05 00:00:00' effective_from, "
        "timestamp_ntz'9999-12-31 00:00:00' effective_to, 'N' deleted_flg")
    clients, prior = new(s=SCHEMAS["clients"]), new(s=SCHEMAS["prior"])
    short = accounts.withColumns({"valid_to": F.expr("date'2021-03-01'")})

    def days(acc, ops):
        return [str(r.event_dt) for r in reports_at.contract_events_at(ops, cards, acc, clients, prior, RUN).collect()]
    # The only version counts for all earlier operations; then a later one that had ended begins at noon.
    assert days(accounts, tx) == [] and days(short, tx) == ["2021-03-02"]
    noon = accounts.withColumn("effective_from", F.expr("timestamp_ntz'2021-03-01 00:00:00'")).unionByName(
        short.withColumn("effective_from", F.expr("timestamp_ntz'2021-03-02 12:00:00'")))
    assert days(noon, tx.where("trans_id = 1")) == [] and days(noon, tx) == ["2021-03-02"]
