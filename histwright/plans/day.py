"""A whole daily run as data: every target table after the run, as one set of lazy frames.

``type2_day`` and ``type1_day`` compose the operators as the published jobs do (``jobs``), but write
nothing: state in, state out, so several days fold into one plan. ``tagged_rows`` turns a state into
one frame, each row tagged with its table, so a run can be compared or stored as a whole.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import stamp_text
from ..operators import dims_type1 as d1
from ..operators import dims_type2 as d2
from ..operators import facts, meta, reports
from ..schemas import DIMS, META, TABLES, empty
from ..sources import staging
from .jobs import DayInputs, stage_day

State = Mapping[str, DataFrame]

#: Tables of a type-2 and of a type-1 warehouse.
TYPE2 = (*(f"dim_{d}_hist" for d in DIMS), "fact_passport_blacklist", "fact_transactions", "rep_fraud", "meta",
         *(f"quarantine_{d}" for d in DIMS))
TYPE1 = (*(f"dim_{d}" for d in DIMS), "fact_passport_blacklist", "fact_transactions_type1", "rep_fraud_type1", "meta",
         *(f"quarantine_{d}" for d in DIMS))


def new_state(spark: SparkSession, tables=TYPE2) -> dict[str, DataFrame]:
    """An empty warehouse; the meta table holds its seed row."""
    return {t: meta.seed(spark) if t == "meta" else empty(spark, TABLES[t]) for t in tables}


def _common(state: State, day: DayInputs, run_ts: str) -> tuple[dict[str, DataFrame], dict[str, DataFrame], dict[str, DataFrame]]:
    """(staged frames, staged rows with a key by dimension, the tables both kinds of run treat alike)."""
    stg = stage_day(day, run_ts)
    keyed, out = {}, {}
    for name, spec in DIMS.items():
        good, bad = d2.split_null_keys(stg[name].select(*spec.columns, "update_dt"), spec)
        keyed[name] = d2.unique_keys(good, spec)
        out[f"quarantine_{name}"] = facts.append_all(state[f"quarantine_{name}"], bad)
    out["meta"] = meta.update_watermark(state["meta"], stg["terminals"], "stg_terminals").select(*META.fieldNames())
    out["fact_passport_blacklist"] = facts.append_all(state["fact_passport_blacklist"], stg["blacklist"])
    return stg, keyed, out


def type2_day(state: State, day: DayInputs, run_ts, compat: str = d2.DEFAULT) -> dict[str, DataFrame]:
    """The state after one run of the history job: dimensions, facts, then both reports over them."""
    run_ts = stamp_text(run_ts)
    stg, keyed, out = _common(state, day, run_ts)
    for name, spec in DIMS.items():
        ts = day.terminals_ts if name == "terminals" and day.terminals_ts else run_ts
        out[f"dim_{name}_hist"] = d2.apply_snapshot(state[f"dim_{name}_hist"], keyed[name], spec, ts, compat,
                                                    check_unique=False)  # keyed rows are checked already
    out["fact_transactions"] = facts.append_new(state["fact_transactions"], stg["transactions"], "trans_id")
    found = reports.run_reports(out["fact_transactions"], *(out[f"dim_{d}_hist"] for d in ("cards", "accounts", "clients")),
                                out["fact_passport_blacklist"], state["rep_fraud"], run_ts, compat)
    out["rep_fraud"] = state["rep_fraud"].unionByName(found.select(*TABLES["rep_fraud"].fieldNames()))
    return out


def type1_day(state: State, day: DayInputs, run_ts) -> dict[str, DataFrame]:
    """The state after one run of the insert-only job: new keys, all facts, reports on the day's sources."""
    run_ts = stamp_text(run_ts)
    stg, keyed, out = _common(state, day, run_ts)
    for name, spec in DIMS.items():
        out[f"dim_{name}"] = d1.insert_new(state[f"dim_{name}"], keyed[name], spec)
    out["fact_transactions_type1"] = facts.append_all(
        state["fact_transactions_type1"], staging.type1_transactions(stg["transactions"]))
    found = reports.expired_passports(stg["clients"], run_ts).unionByName(
        reports.expired_contracts(stg["accounts"], run_ts))
    out["rep_fraud_type1"] = state["rep_fraud_type1"].unionByName(found)
    return out


def tagged_rows(state: State) -> DataFrame:
    """All rows of all tables: ``of_table`` and every column of any table, as text (NULL where a table lacks it)."""
    parts = [df.select(F.lit(name).alias("of_table"), *[F.col(c).cast("string").alias(c) for c in df.columns])
             for name, df in sorted(state.items())]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out
