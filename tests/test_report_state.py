"""The reports' kept state: what a day without changes reads does not grow with the days (from the event log).

Rows are counted, not bytes: of a segment that its statistics exclude, the footer is still read, until a
compaction merges the segments.
"""

import json
import os
import subprocess
import sys

from scratch import scratch_dir

SCRIPT = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from histwright.plans import jobs
from histwright.session import local_session
from histwright.sources import fixtures as fx
SF = "/root/testdata/sf0.001"
spark = local_session("4", shuffle_partitions=4, extra={"spark.eventLog.enabled": "true", "spark.eventLog.rolling.enabled": "false",
    "spark.eventLog.compress": "false", "spark.eventLog.dir": "file://" + sys.argv[2], "spark.ui.showConsoleProgress": "false"})
root = sys.argv[3]
for n in range(1, 7):
    tx = fx.transactions(spark, SF)
    if n > 1:  # some operations of the day, with ids of their own
        tx = tx.where("trans_id % 7 = 1").withColumn("trans_id", F.col("trans_id") + n * 10 ** 9).withColumn(
            "trans_date", F.lit(f"2021-03-0{n} 07:00:00").cast("timestamp_ntz"))
    bl = fx.blacklist(spark, SF)
    day = jobs.DayInputs(transactions=tx.select(*[F.col(c).cast("string") for c in tx.columns]),
        terminals=fx.terminals(spark, SF, 1), blacklist=bl if n == 1 else bl.where("false"),
        clients=fx.clients(spark, SF, 1), accounts=fx.accounts(spark, SF, 1), cards=fx.cards(spark, SF, 1),
        terminals_ts=f"2021-03-0{n} 00:00:00", files=[f"day{n}.txt"])
    state = jobs.run_type2_day(spark, root, day, f"2021-03-0{n} 08:00:00")
for r in state.read("rep_fraud").groupBy(F.dayofmonth("report_dt").alias("n")).count().orderBy("n").collect():
    print(r.n, r["count"], len(state.segments("card_profile")), flush=True)
spark.stop()
"""


def rows_by_manifest(folder):
    """Rows read by the tasks before each manifest write, from the event log."""
    names = [n for n in os.listdir(folder) if not n.startswith(".")]
    out, now = [], 0
    for line in open(os.path.join(folder, names[0])):
        e = json.loads(line)
        if e["Event"] == "SparkListenerTaskEnd":
            now += (e.get("Task Metrics") or {}).get("Input Metrics", {}).get("Records Read", 0)
        elif "/_manifests/" in line and e["Event"].endswith("SparkListenerSQLExecutionStart") and "Insert" in line:
            out.append(now)
            now = 0
    return out


def test_days_without_changes_read_the_same(tmp_path):
    log, root = scratch_dir("events-"), scratch_dir("wh-")
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", SCRIPT, top, log, root], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    days = [tuple(map(int, line.split())) for line in done.stdout.splitlines() if line[:1].isdigit()]
    assert [d[0] for d in days] == [1, 2, 3, 4, 5, 6]
    assert all(found > 0 for _, found, _ in days)  # each day's own operations are reported
    assert {profiles for _, _, profiles in days} == {1}  # no profile is worked out anew
    read = rows_by_manifest(log)
    assert len(read) == 6
    assert read[5] == read[4] == read[3] == read[2], read
