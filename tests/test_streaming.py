"""Drop ingestion as a file stream: one run per file, restart adds nothing, archiving."""

import os

from pyspark.sql import functions as F

from histwright.plans import jobs, publish
from scratch import scratch_dir
from histwright.sources import fixtures as fx
from histwright.streaming.drops import day_handler, run_drops

SF = "/root/testdata/sf0.001"


def _write_drop(path, df):
    pdf = df.toPandas()
    # File order: id, date, amount, card, type, result, terminal.
    pdf = pdf[["trans_id", "trans_date", "amt", "card_num", "oper_type", "oper_result", "terminal"]]
    pdf.to_csv(path, sep=";", index=False)


def test_two_drops_stream(spark):
    base = scratch_dir("drops-")
    drops, archive, root = f"{base}/in", f"{base}/archive", f"{base}/wh"
    os.makedirs(drops)
    tx = fx.transactions(spark, SF).withColumn("trans_date", F.col("trans_date").cast("string"))
    _write_drop(f"{drops}/transactions_01032021.txt", tx.where("trans_id % 2 = 0"))
    _write_drop(f"{drops}/transactions_02032021.txt", tx.where("trans_id % 2 = 1"))

    def inputs_for(batch, date, name):
        day = 1 if date.day == 1 else 2
        return jobs.DayInputs(
            transactions=batch, terminals=fx.terminals(spark, SF, day),
            blacklist=fx.blacklist(spark, SF), clients=fx.clients(spark, SF, day),
            accounts=fx.accounts(spark, SF, day), cards=fx.cards(spark, SF, day),
            terminals_ts=date.strftime("%Y-%m-%d 00:00:00"), files=[name])

    def run_ts_for(date):
        return date.strftime("%Y-%m-%d 08:00:00")

    handle = day_handler(spark, root, inputs_for, run_ts_for)
    run_drops(spark, drops, handle, checkpoint=f"{base}/ckpt", archive_dir=archive)
    state = publish.current(spark, root)
    assert state.run_id == "20210302T080000"
    names = {"transactions_01032021.txt", "transactions_02032021.txt"}
    assert state.loaded([*names, "transactions_03032021.txt"]) == names
    assert state.read("fact_transactions").count() == tx.count()
    # Restart: nothing new, state unchanged.
    run_drops(spark, drops, handle, checkpoint=f"{base}/ckpt", archive_dir=archive)
    again = publish.current(spark, root)
    assert again.run_id == state.run_id
    assert again.read("fact_transactions").count() == tx.count()
    # The first file has been archived (a file is archived once a later batch ran).
    archived = [f for _, _, fs in os.walk(archive) for f in fs]
    assert "transactions_01032021.txt" in archived
