"""Registered queries: one Spark callable ``(spark, sf_dir) -> DataFrame`` per key.

Every query reads the driver's tables whole (through the derived day views of
``histwright.sources.fixtures``) and runs the package's operators on them.
Timestamps, dates and decimals are returned as text so both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import row_changed, run_stamp
from ..operators import dims_late
from ..operators import dims_type1 as d1
from ..operators import dims_type2 as d2
from ..operators import facts, meta, reports, reports_at
from ..schemas import DIMS, TS, empty
from ..sources import fixtures as fx
from ..sources import staging
from . import day as whole_day
from .jobs import DayInputs
from .oracle import DAY_CARDS, POINT_STAMPS, TYPE1_REPORT_TS

Query = Callable[[SparkSession, str], DataFrame]


def _text_times(df: DataFrame) -> DataFrame:
    """Timestamps, dates and decimals as text (``yyyy-MM-dd HH:mm:ss``, ``yyyy-MM-dd``,
    plain decimal), as in the oracle SQL."""
    def text(t) -> bool:
        return t.typeName().startswith(("timestamp", "date", "decimal"))
    return df.select(*[F.col(f.name).cast("string").alias(f.name) if text(f.dataType)
                       else F.col(f.name) for f in df.schema.fields])


def _stamps(dim: str) -> dict[int, str]:
    return fx.FILE_DAY_STAMPS if dim == "terminals" else fx.DAY_STAMPS


def staged(spark: SparkSession, sf: str, dim: str, day: int) -> DataFrame:
    return staging.stamp(fx.snapshot(spark, sf, dim, day), _stamps(dim)[day])


def whole(spark: SparkSession, sf: str, dim: str) -> DataFrame:
    """History after one snapshot of the whole table."""
    spec, ts = DIMS[dim], _stamps(dim)[1]
    stg = staging.stamp(fx.snapshot(spark, sf, dim, 0), ts)
    return d2.apply_snapshot(empty(spark, spec.history_schema), stg, spec, ts)


def history(spark: SparkSession, sf: str, dim: str, days: int,
            compat: str = d2.DEFAULT) -> DataFrame:
    """History of ``dim`` after ``days`` daily snapshots, single pass per day."""
    spec = DIMS[dim]
    h = empty(spark, spec.history_schema)
    for day in range(1, days + 1):
        h = d2.apply_snapshot(h, staged(spark, sf, dim, day), spec, _stamps(dim)[day], compat)
    return h


def _hist_key(dim: str, days: int, compat: str = d2.DEFAULT) -> Query:
    return lambda spark, sf: _text_times(history(spark, sf, dim, days, compat))


# --- staging -----------------------------------------------------------------------------------

def q_stage_transactions_typed(spark, sf):
    raw = fx.transactions(spark, sf)
    as_text = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    t = staging.stage_transactions(as_text)
    return _text_times(t.select(
        "trans_id", "trans_date", "card_num", "oper_type", "amt",
        staging.amount_decimal("amt").alias("amount"),
        F.to_date("trans_date").alias("trans_day"),
        F.col("trans_id").cast("long").alias("transactions_id"), "oper_result", "terminal"))


def q_stage_snapshot_stamped(spark, sf):
    return _text_times(staging.stamp(fx.clients(spark, sf, 0), fx.DAY_STAMPS[1]))


def q_stage_blacklist_dates(spark, sf):
    bl = fx.blacklist(spark, sf)
    return _text_times(staging.stage_blacklist(bl))


def q_changed_any_column(spark, sf):
    spec = DIMS["clients"]
    s = fx.view(spark, sf, "clients_d0_next").alias("s")
    t = fx.clients(spark, sf, 0).alias("t")
    return (s.join(t, F.col("s.client_id") == F.col("t.client_id"))
            .where(row_changed(spec.attrs, "s", "t")).select("s.client_id"))


# --- type 1 ------------------------------------------------------------------------------------

def _type1(dim: str) -> Query:
    def q(spark, sf):
        spec = DIMS[dim]
        dim0 = empty(spark, spec.type1_schema)
        stg = lambda d: staging.stamp(fx.snapshot(spark, sf, dim, d), fx.DAY_STAMPS[d])  # noqa
        after1 = d1.insert_new(dim0, stg(1), spec)
        return _text_times(d1.insert_new(after1, stg(2), spec))
    return q


# --- type 2 steps (day 2 on the day-1 history) -------------------------------------------------

def _day2(spark, sf, dim):
    return history(spark, sf, dim, 1), staged(spark, sf, dim, 2), DIMS[dim]


def _insert_new(dim: str) -> Query:
    def q(spark, sf):
        h, s, spec = _day2(spark, sf, dim)
        return _text_times(d2.insert_versions(h, s, spec))
    return q


def _after_insert(h, s, spec):
    return h.unionByName(d2.insert_versions(h, s, spec))


def _close_changed(dim: str) -> Query:
    def q(spark, sf):
        h, s, spec = _day2(spark, sf, dim)
        return _text_times(d2.close_changed(_after_insert(h, s, spec), s, spec).where(d2.is_closed()))
    return q


def _open_changed(dim: str) -> Query:
    def q(spark, sf):
        h, s, spec = _day2(spark, sf, dim)
        return _text_times(d2.open_changed(d2.close_changed(_after_insert(h, s, spec), s, spec), s, spec))
    return q


def _deleted_rows(dim: str, compat: str) -> Query:
    def q(spark, sf):
        h, s, spec = _day2(spark, sf, dim)
        gone = d2.live_rows(h).join(s.select(spec.key), spec.key, "left_anti").select(spec.key)
        after = d2.apply_stepwise(h, s, spec, _stamps(dim)[2], compat)
        rows = after.join(gone, spec.key, "left_semi")
        if compat == d2.DEFAULT:
            ts = run_stamp(_stamps(dim)[2])
            rows = rows.where((F.col("deleted_flg") == "Y")
                              | (F.col("effective_to") == ts - F.expr("INTERVAL 1 SECOND")))
        return _text_times(rows)
    return q


def q_hist_live_rows(spark, sf):
    return _text_times(d2.live_rows(history(spark, sf, "cards", 2)))


# --- facts, meta -------------------------------------------------------------------------------

BLACKLIST_LOADED_BEFORE = "1998-06-01 00:00:00"
BLACKLIST_REDROP_FROM = "1998-03-01 00:00:00"


def q_fact_append_all_blacklist(spark, sf):
    bl = fx.blacklist(spark, sf)
    loaded = bl.where(F.col("entry_dt") < F.lit(BLACKLIST_LOADED_BEFORE).cast(TS))
    drop = bl.where(F.col("entry_dt") >= F.lit(BLACKLIST_REDROP_FROM).cast(TS))
    return _text_times(facts.append_all(loaded, staging.stage_blacklist(drop)))


def q_fact_append_all_transactions(spark, sf):
    b1 = staging.type1_transactions(fx.transactions_batch(spark, sf, 1))
    b2 = staging.type1_transactions(fx.transactions_batch(spark, sf, 2))
    return _text_times(facts.append_all(b1, b2))


def q_fact_append_new_transactions(spark, sf):
    b1 = fx.transactions_batch(spark, sf, 1)
    b2 = fx.transactions_batch(spark, sf, 2)
    return _text_times(facts.append_new(b1, b2, "trans_id"))


def q_meta_watermark(spark, sf):
    stg = staging.stamp(fx.terminals(spark, sf, 0), fx.FILE_DAY_STAMPS[2])
    m = meta.update_watermark(meta.seed(spark), stg, "stg_terminals")
    return _text_times(m)


# --- reports -----------------------------------------------------------------------------------

def q_report_expired_passports(spark, sf):
    return _text_times(reports.expired_passports(fx.clients(spark, sf, 0), TYPE1_REPORT_TS))


def q_report_expired_contracts(spark, sf):
    return _text_times(reports.expired_contracts(fx.accounts(spark, sf, 0), TYPE1_REPORT_TS))


#: Days of the histories that the multi-day reports read: several versions and tombstones for a key.
REPORT_DAYS = {"cards": 3, "accounts": 2, "clients": 2}


def report_inputs(spark: SparkSession, sf: str, multi_day: bool = False) -> dict:
    """Histories (of one whole snapshot, or of several days), all transactions, the blacklist
    and earlier report rows."""
    hist = {dim: history(spark, sf, dim, days) if multi_day else whole(spark, sf, dim)
            for dim, days in REPORT_DAYS.items()}
    return dict(trans=fx.transactions(spark, sf), **hist, blacklist=fx.blacklist(spark, sf),
                prior=fx.prior_report(spark, sf))


def passport_report(spark: SparkSession, sf: str, compat: str = reports.DEFAULT,
                    multi_day: bool = False) -> DataFrame:
    i = report_inputs(spark, sf, multi_day)
    return reports.passport_events(i["trans"], i["cards"], i["accounts"], i["clients"],
                                   i["blacklist"], i["prior"], fx.DAY_STAMPS[1], compat)


def contract_report(spark: SparkSession, sf: str, compat: str = reports.DEFAULT,
                    multi_day: bool = False) -> DataFrame:
    i = report_inputs(spark, sf, multi_day)
    if compat == reports.DEFAULT:
        return reports.contract_events(i["trans"], i["cards"], i["accounts"], i["clients"], i["prior"],
                                       fx.DAY_STAMPS[1])
    rows = reports.run_reports(**i, run_ts=fx.DAY_STAMPS[1], compat=compat)
    return rows.where(F.col("event_type") == "2")


def q_quarantine_cards(spark, sf):
    """A snapshot in which a quarter of the cards has no number: what goes on and what is held."""
    good, bad = d2.split_null_keys(staging.stamp(fx.view(spark, sf, "cards_keyless"), fx.DAY_STAMPS[1]), DIMS["cards"])
    return _text_times(good.withColumn("place", F.lit("kept")).unionByName(
        bad.withColumn("place", F.lit("quarantined"))))


def q_report_padded_cards(spark, sf):
    """Contract events where the card source pads card numbers with blanks: the
    history keeps them as delivered, the report matches on the trimmed number."""
    i = report_inputs(spark, sf)
    spec = DIMS["cards"]
    padded = staging.stamp(fx.cards_padded(spark, sf), fx.DAY_STAMPS[1])
    cards = d2.apply_snapshot(empty(spark, spec.history_schema), padded, spec, fx.DAY_STAMPS[1])
    out = reports.contract_events(i["trans"], cards, i["accounts"], i["clients"], i["prior"],
                                  fx.DAY_STAMPS[1])
    return _text_times(out)


def _report_at(kind: str) -> Query:
    """A report by the versions in force, over histories whose runs lie among the operations."""
    def q(spark, sf):
        hist = {}
        for dim, days in REPORT_DAYS.items():
            h = empty(spark, DIMS[dim].history_schema)
            for day in range(1, days + 1):
                ts = POINT_STAMPS[day]
                h = d2.apply_snapshot(h, staging.stamp(fx.snapshot(spark, sf, dim, day), ts), DIMS[dim], ts)
            hist[dim] = h
        args = [fx.transactions(spark, sf), hist["cards"], hist["accounts"], hist["clients"]]
        if kind == "passport":
            args.append(fx.blacklist(spark, sf))
        fn = reports_at.passport_events_at if kind == "passport" else reports_at.contract_events_at
        return _text_times(fn(*args, fx.prior_report(spark, sf), fx.DAY_STAMPS[1]))
    return q


def _report(kind: str, compat: str, multi_day: bool = False) -> Query:
    fn = passport_report if kind == "passport" else contract_report
    return lambda spark, sf: _text_times(fn(spark, sf, compat, multi_day))


# --- whole daily runs --------------------------------------------------------------------------

def day_inputs(spark: SparkSession, sf: str, day: int) -> DayInputs:
    """Everything one daily run reads: drops and snapshots of the whole tables. Some cards of day 1 have no number."""
    bl = fx.blacklist(spark, sf)
    drop = (bl.where(F.col("entry_dt") < F.lit(BLACKLIST_LOADED_BEFORE).cast(TS)) if day == 1
            else bl.where(F.col("entry_dt") >= F.lit(BLACKLIST_REDROP_FROM).cast(TS)))
    return DayInputs(
        transactions=fx.transactions_batch(spark, sf, day), blacklist=drop, cards=fx.view(spark, sf, DAY_CARDS[day]),
        **{d: fx.snapshot(spark, sf, d, day) for d in ("terminals", "accounts", "clients")},
        terminals_ts=fx.FILE_DAY_STAMPS[day])


def _two_days(kind: str, compat: str = d2.DEFAULT) -> Query:
    """All target tables after the runs of two days, row by row with their table."""
    def q(spark, sf):
        state = whole_day.new_state(spark, whole_day.TYPE1 if kind == "type1" else whole_day.TYPE2)
        for day in (1, 2):
            inputs, ts = day_inputs(spark, sf, day), fx.DAY_STAMPS[day]
            state = (whole_day.type1_day(state, inputs, ts) if kind == "type1"
                     else whole_day.type2_day(state, inputs, ts, compat))
        return whole_day.tagged_rows(state)
    return q


#: Snapshots of a replay of all dimensions; the third day brings most keys of the first back.
REPLAY_DAYS = {"cards": (1, 2, 3), "terminals": (1, 2, 1), "accounts": (1, 2, 1), "clients": (1, 2, 1)}


def q_replay_all_dimensions(spark, sf):
    """The histories of all four dimensions after three daily snapshots."""
    state = {}
    for dim, days in REPLAY_DAYS.items():
        spec = DIMS[dim]
        h = empty(spark, spec.history_schema)
        for day, view in enumerate(days, 1):
            ts = _stamps(dim)[day]
            h = d2.apply_snapshot(h, staging.stamp(fx.snapshot(spark, sf, dim, view), ts), spec, ts)
        state[f"dim_{dim}_hist"] = h
    return whole_day.tagged_rows(state)


def q_replay_late_day(spark, sf):
    """The histories of all four dimensions when the second day's snapshot comes after the third's."""
    state = {}
    for dim, (first, late, last) in REPLAY_DAYS.items():
        spec, at = DIMS[dim], _stamps(dim)
        stg = lambda view, day: staging.stamp(fx.snapshot(spark, sf, dim, view), at[day])  # noqa: B023, E731
        h = d2.apply_snapshot(empty(spark, spec.history_schema), stg(first, 1), spec, at[1])
        h = d2.apply_snapshot(h, stg(last, 3), spec, at[3])
        state[f"dim_{dim}_hist"] = dims_late.apply_late_snapshot(h, stg(late, 2), spec, at[2], at[3])
    return whole_day.tagged_rows(state)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "stage_transactions_typed": q_stage_transactions_typed,
        "stage_snapshot_stamped": q_stage_snapshot_stamped,
        "stage_blacklist_dates": q_stage_blacklist_dates,
        "changed_any_column": q_changed_any_column,
    }
    for dim in ("cards", "terminals", "accounts", "clients"):
        q[f"dim_insert_new_{dim}"] = _type1(dim)
    for dim in ("cards", "terminals", "accounts", "clients"):
        q[f"hist_insert_new_{dim}"] = _insert_new(dim)
        q[f"hist_close_changed_{dim}"] = _close_changed(dim)
        q[f"hist_open_changed_{dim}"] = _open_changed(dim)
        q[f"hist_mark_deleted_{dim}"] = _deleted_rows(dim, d2.DEFAULT)
    q["hist_mark_deleted_terminals_legacy"] = _deleted_rows("terminals", d2.LEGACY)
    for dim in ("cards", "terminals", "accounts", "clients"):
        q[f"hist_apply_{dim}"] = _hist_key(dim, 2)
    q["hist_replay_three_days"] = _hist_key("cards", 3)
    q["hist_replay_three_days_legacy"] = _hist_key("cards", 3, d2.LEGACY)
    for dim in ("terminals", "accounts", "clients"):
        q[f"hist_apply_{dim}_legacy"] = _hist_key(dim, 2, d2.LEGACY)
    q["hist_live_rows"] = q_hist_live_rows
    q["quarantine_cards"] = q_quarantine_cards
    q["fact_append_all_blacklist"] = q_fact_append_all_blacklist
    q["fact_append_all_transactions"] = q_fact_append_all_transactions
    q["fact_append_new_transactions"] = q_fact_append_new_transactions
    q["meta_watermark"] = q_meta_watermark
    q["report_expired_passports"] = q_report_expired_passports
    q["report_expired_contracts"] = q_report_expired_contracts
    q["report_passport_events"] = _report("passport", reports.DEFAULT)
    q["report_passport_events_legacy"] = _report("passport", reports.LEGACY)
    q["report_contract_events"] = _report("contract", reports.DEFAULT)
    q["report_contract_events_legacy"] = _report("contract", reports.LEGACY)
    for kind in ("passport", "contract"):
        q[f"report_{kind}_events_multi_day"] = _report(kind, reports.DEFAULT, True)
        q[f"report_{kind}_events_multi_day_legacy"] = _report(kind, reports.LEGACY, True)
        q[f"report_{kind}_events_point_in_time"] = _report_at(kind)
    q["report_padded_cards"] = q_report_padded_cards
    q["day_type1_all_tables"] = _two_days("type1")
    q["day_type2_all_tables"] = _two_days("type2")
    q["day_type2_all_tables_legacy"] = _two_days("type2", d2.LEGACY)
    q["replay_all_dimensions"] = q_replay_all_dimensions
    q["replay_late_day"] = q_replay_late_day
    return q
