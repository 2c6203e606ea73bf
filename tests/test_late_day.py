"""Late days: whatever the order in which snapshots come in, the history is that of the days in order."""

import itertools

import pytest

from histwright.functions import run_stamp
from histwright.operators import dims_type2 as d2
from histwright.operators.dims_late import apply_late_snapshot
from histwright.schemas import CARDS, empty
from scratch import rows
from test_properties import STAMPS, random_days, replay

COLUMNS = "card_num string, account_num string"


def snapshot(spark, data, ts):
    return spark.createDataFrame(data, COLUMNS).withColumn("update_dt", run_stamp(ts))


def in_order_of(spark, days, order):
    """The history when day ``i`` of ``order`` comes in next, late or not."""
    h, seen = empty(spark, CARDS.history_schema), []
    for i in order:
        stg, later = snapshot(spark, days[i], STAMPS[i]), [j for j in seen if j > i]
        h = (apply_late_snapshot(h, stg, CARDS, STAMPS[i], STAMPS[min(later)]) if later
             else d2.apply_snapshot(h, stg, CARDS, STAMPS[i]))
        seen.append(i)
    return rows(h)


@pytest.mark.parametrize("order", [o for o in itertools.permutations(range(3)) if o != (0, 1, 2)])
def test_any_order_of_three_days(spark, order):
    # Every key takes one of all courses of three days: absent, without account, of account A1 or A2.
    states = [None, (None,), ("A1",), ("A2",)]
    courses = list(itertools.product(states, repeat=3))
    days = [[(f"K{k}", c[d][0]) for k, c in enumerate(courses) if c[d]] for d in range(3)]
    assert in_order_of(spark, days, order) == rows(replay(spark, days, "default", d2.apply_snapshot))


@pytest.mark.parametrize("seed,order", [(11, (0, 3, 1, 2)), (12, (2, 3, 0, 1)), (13, (3, 2, 1, 0))])
def test_several_late_days(spark, seed, order):
    days = random_days(seed)
    assert in_order_of(spark, days, order) == rows(replay(spark, days, "default", d2.apply_snapshot))


def test_empty_late_snapshot_and_keyless_rows(spark):
    days = [[("K1", "A1"), ("K2", None)], [(None, "A9")], [("K1", "A1"), ("K3", "A2")]]
    assert in_order_of(spark, days, (0, 2, 1)) == rows(replay(spark, days, "default", d2.apply_snapshot))
    days[1] = []
    assert in_order_of(spark, days, (0, 2, 1)) == rows(replay(spark, days, "default", d2.apply_snapshot))


def test_wrong_next_run_and_duplicates_fail(spark):
    days = random_days(14, days=3)
    h = replay(spark, days, "default", d2.apply_snapshot)
    late = snapshot(spark, days[0], STAMPS[0])
    with pytest.raises(ValueError, match="not after"):
        apply_late_snapshot(h, late, CARDS, STAMPS[1], STAMPS[1])
    with pytest.raises(Exception, match="lies between"):
        apply_late_snapshot(h, late, CARDS, "2021-02-28 08:00:00", STAMPS[2]).collect()
    twice = snapshot(spark, [("K1", "A1"), ("K1", "A2")], STAMPS[0])
    with pytest.raises(Exception, match="duplicate card_num"):
        apply_late_snapshot(h, twice, CARDS, "2021-02-28 08:00:00", STAMPS[0]).collect()


def test_only_versions_that_reach_the_late_day_are_read(spark, tmp_path):
    path = str(tmp_path / "hist")
    replay(spark, random_days(15), "default", d2.apply_snapshot).write.parquet(path)
    h = spark.read.schema(CARDS.history_schema).parquet(path)
    late = snapshot(spark, random_days(16)[0], STAMPS[3])
    out = apply_late_snapshot(h, late, CARDS, "2021-03-04 07:00:00", STAMPS[3])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(effective_to,2021-03-04T07:00)" in plan
