"""Hypothesis: single pass equals step by step on random terminal snapshots (three
attributes with NULLs), including the legacy shifted deletes of terminals."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from scratch import rows
from histwright.functions import run_stamp
from histwright.operators import dims_type2 as d2
from histwright.schemas import TERMINALS, empty

STAMPS = ["2021-03-01 00:00:00", "2021-03-02 00:00:00", "2021-03-03 00:00:00"]
ROW = st.tuples(st.sampled_from(["POS", "ATM", None]), st.sampled_from(["X", "Y", None]),
                st.sampled_from(["a", "b", None]))
DAY = st.dictionaries(st.sampled_from([f"T{i}" for i in range(8)]), ROW, max_size=8)


def replay(spark, days, compat, fn):
    h = empty(spark, TERMINALS.history_schema)
    for snap, ts in zip(days, STAMPS):
        data = [(k, *v) for k, v in sorted(snap.items())]
        s = spark.createDataFrame(data, "terminal_id string, terminal_type string, "
                                        "terminal_city string, terminal_address string")
        h = fn(h, s.withColumn("update_dt", run_stamp(ts)), TERMINALS, ts, compat)
    return h


@pytest.mark.parametrize("compat", ["legacy", "default"])
@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(days=st.lists(DAY, min_size=3, max_size=3))
def test_terminals_single_pass_equals_stepwise(spark, compat, days):
    assert rows(replay(spark, days, compat, d2.apply_snapshot)) == \
        rows(replay(spark, days, compat, d2.apply_stepwise))
