"""Whole days as data: the lazy frames hold what the published jobs leave in their tables."""

import pytest

from histwright.plans import day, jobs
from histwright.sources import fixtures as fx
from scratch import rows, scratch_dir
from test_jobs import SF, day_inputs


@pytest.mark.parametrize("kind", ["type1", "type2"])
def test_frames_equal_published_tables(spark, kind):
    days = [day_inputs(spark, d) for d in (1, 2)]
    days[0].cards = fx.view(spark, SF, "cards_keyless")
    published = jobs.replay(spark, scratch_dir("wh-"), days, [fx.DAY_STAMPS[d] for d in (1, 2)], kind=kind)
    state = day.new_state(spark, day.TYPE1 if kind == "type1" else day.TYPE2)
    for d, inputs in enumerate(days, 1):
        state = (day.type1_day if kind == "type1" else day.type2_day)(state, inputs, fx.DAY_STAMPS[d])
    got = rows(day.tagged_rows(state))
    assert len(got) > 1000 and any(r[0] == "quarantine_cards" for r in got)
    assert got == rows(day.tagged_rows({t: published.read(t) for t in state}))
