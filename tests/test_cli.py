"""Command line daily run on drop files and source tables written from the fixtures."""

import pytest
from pyspark.sql import functions as F

from histwright.__main__ import _drop, file_day, jdbc_options, main, named_function
from histwright.plans import publish
from scratch import scratch_dir
from histwright.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_run_day_from_files(spark, capsys):
    d = scratch_dir("cli-")
    tx = fx.transactions(spark, SF).select(
        "trans_id", F.col("trans_date").cast("string"), "amt", "card_num", "oper_type",
        "oper_result", "terminal")
    tx.toPandas().to_csv(f"{d}/transactions_01032021.txt", sep=";", index=False)
    fx.terminals(spark, SF, 1).toPandas().to_csv(f"{d}/terminals_01032021.csv", sep=";", index=False)
    bl = fx.blacklist(spark, SF).select(F.col("entry_dt").cast("string"), "passport_num")
    bl.toPandas().to_csv(f"{d}/passport_blacklist_01032021.csv", sep=";", index=False)
    fx.clients(spark, SF, 1).write.parquet(f"{d}/src/clients")
    fx.accounts(spark, SF, 1).withColumnRenamed("account_num", "account").write.parquet(
        f"{d}/src/accounts")
    fx.cards(spark, SF, 1).withColumnRenamed("account_num", "account").write.parquet(
        f"{d}/src/cards")
    root = f"{d}/wh"
    main(["run-day", "--root", root, "--transactions", f"{d}/transactions_01032021.txt",
          "--terminals", f"{d}/terminals_01032021.csv",
          "--blacklist", f"{d}/passport_blacklist_01032021.csv",
          "--clients", f"{d}/src/clients", "--accounts", f"{d}/src/accounts",
          "--cards", f"{d}/src/cards", "--run-ts", "2021-03-01 08:00:00"])
    assert "published run 20210301T080000" in capsys.readouterr().out
    st = publish.current(spark, root)
    assert st.read("dim_cards_hist").count() == fx.cards(spark, SF, 1).count()
    assert st.read("fact_transactions").count() == tx.count()
    t = st.read("dim_terminals_hist").select(F.col("effective_from").cast("string")).distinct()
    assert [r[0] for r in t.collect()] == ["2021-03-01 00:00:00"]
    assert file_day("x/terminals_02032021.xlsx") == "2021-03-02 00:00:00"


def test_jdbc_sources_are_partitioned_or_allowed():
    src = "jdbc:postgresql://host/db#bank.cards"
    with pytest.raises(ValueError, match="one task"):
        jdbc_options(src, "cards", partitions=["clients=id:1:9:4"])
    assert jdbc_options(src, "cards", one_task=True) == {"url": "jdbc:postgresql://host/db", "dbtable": "bank.cards"}
    got = jdbc_options(src, "cards", "me", ["cards=create_dt:2020-01-01 00:00:00:2021-01-01 00:00:00:64"])
    assert (got["user"], got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == (
        "me", "create_dt", "2020-01-01 00:00:00", "2021-01-01 00:00:00", "64")
    with pytest.raises(ValueError, match="expected COLUMN"):
        jdbc_options(src, "cards", partitions=["cards=id:1"])


DECODER = '''
"""Stands for a workbook decoder: the sheet's name, then its rows as text."""
import io
import pandas as pd


def sheet_of_text(content, sheet):
    name, _, text = content.decode().partition("\\n")
    assert name == sheet
    return pd.read_csv(io.StringIO(text), sep=";", dtype=object)
'''


def test_workbook_drop_with_named_decoder(spark, monkeypatch):
    d = scratch_dir("cli-")
    with open(f"{d}/sheet_text.py", "w") as f:
        f.write(DECODER)
    monkeypatch.syspath_prepend(d)
    spark.sparkContext.addPyFile(f"{d}/sheet_text.py")
    path = f"{d}/terminals_01032021.xlsx"
    with open(path, "w") as f:
        f.write("terminals\nid;type;city;address\nP1;ATM;Town;\n")
    decoder = named_function("sheet_text:sheet_of_text")
    got = _drop(spark, path, ["terminal_id", "terminal_type", "terminal_city", "terminal_address"], "terminals", decoder)
    assert [tuple(r) for r in got.collect()] == [("P1", "ATM", "Town", None)]
