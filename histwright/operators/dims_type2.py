"""Type-2 (full history) dimensions.

A history row is ``key, attrs..., effective_from, effective_to, deleted_flg``;
the current version of a key has ``effective_to = 9999-12-31`` (open).

Two formulations are provided:

* ``apply_snapshot`` - the production path: one full-outer join of the open
  versions with the staged snapshot on the key (a single shuffle), each joined
  pair emitting at most two result rows. The daily job passes open versions only, so closed
  ones are never read there; called on a whole history, all its versions take part in the join.
* the step functions ``insert_versions``, ``close_changed``, ``open_changed``,
  ``reopen_returned`` and ``mark_deleted`` composed by ``apply_stepwise`` -
  the same result step by step, in the order a set-based SQL job runs them
  (insert new keys, close changed, open their replacement, mark deletions).
  They exist to cross-check the single pass and to expose each step.

``compat="legacy"`` keeps two literal behaviours of the original job: a key
that returns unchanged after deletion stays deleted, and deleted terminals get
their interval moved one day back (tombstone one day after the old start).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.compare import row_changed
from ..functions.timefn import minus_days, minus_seconds, plus_days, run_stamp, stamp_text
from ..schemas import FLAG_DELETED, FLAG_LIVE, OPEN_END_TEXT, TS, DimSpec, open_end

DEFAULT = "default"
LEGACY = "legacy"


def _check_compat(compat: str) -> None:
    if compat not in (DEFAULT, LEGACY):
        raise ValueError(f"compat must be {DEFAULT!r} or {LEGACY!r}, got {compat!r}")


def shifts_deletes(spec: DimSpec, compat: str) -> bool:
    """Legacy terminals move a deleted interval one day back (see module doc)."""
    return compat == LEGACY and spec.name == "terminals"


OPEN_SQL = f"TIMESTAMP_NTZ'{OPEN_END_TEXT}'"


# Plain comparisons so that Parquet scans get them as pushed filters.
OPEN_PRED = f"effective_to = {OPEN_SQL}"
CLOSED_PRED = f"(effective_to <> {OPEN_SQL} OR effective_to IS NULL)"


def is_open() -> Column:
    """Open version (NULL-free in the history; NULL counts as not open in filters)."""
    return F.expr(OPEN_PRED)


def is_closed() -> Column:
    return F.expr(CLOSED_PRED)


def live_rows(hist: DataFrame) -> DataFrame:
    """Current, not deleted versions."""
    return hist.where(is_open() & (F.col("deleted_flg") == F.lit(FLAG_LIVE)))


def split_null_keys(stg: DataFrame, spec: DimSpec) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, quarantined rows whose key is NULL)."""
    k = F.col(spec.key)
    return stg.where(k.isNotNull()), stg.where(k.isNull())


def unique_keys(stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Fail the job when a snapshot holds a key twice (it would open two versions).

    The count runs in a window partitioned by the key, so its shuffle and sort are
    the ones the following join on the key needs anyway.
    """
    k = spec.key
    return (stg.withColumn("_n", F.expr(f"count(1) OVER (PARTITION BY {k})"))
            .where(f"CASE WHEN _n > 1 THEN raise_error(concat('duplicate {k} in {spec.name} "
                   f"snapshot: ', coalesce({k}, 'NULL'))) ELSE true END")
            .drop("_n"))


def _version(spec: DimSpec, key: Column, attrs: list[Column], frm: Column, to: Column,
             flag: Column) -> Column:
    fields = [key.alias(spec.key)]
    fields += [a.alias(n) for a, n in zip(attrs, spec.attrs)]
    fields += [frm.cast(TS).alias("effective_from"), to.cast(TS).alias("effective_to"),
               flag.alias("deleted_flg")]
    return F.struct(*fields)


def _sql_version(spec: DimSpec, key: str, src: str, frm: str, to: str, flag: str) -> str:
    fields = [f"'{spec.key}', {key}"] + [f"'{a}', {src}.{a}" for a in spec.attrs]
    fields += [f"'effective_from', CAST({frm} AS TIMESTAMP_NTZ)",
               f"'effective_to', CAST({to} AS TIMESTAMP_NTZ)", f"'deleted_flg', {flag}"]
    return f"named_struct({', '.join(fields)})"


def snapshot_delta(versions: DataFrame, stg: DataFrame, spec: DimSpec, run_ts,
                   compat: str = DEFAULT) -> DataFrame:
    """New state of every version and every staged key, in one join.

    ``versions`` are the open versions, or the whole history: closed versions match no staged
    row and come out as they are (so chained applies read each version once). ``stg`` the snapshot (``key, attrs,
    update_dt``) with unique non-NULL keys. Output rows are history rows: the
    old version as it becomes (unchanged or closed) and, where needed, one new
    open version (changed, new, returned or tombstone):

    ======================  ===========================  ==========================
    case                    old version                  new version
    ======================  ===========================  ==========================
    new key                 -                            staged, open, ``N``
    unchanged, live         unchanged                    -
    changed (any flag)      closed at update_dt - 1 s    staged, open, ``N``
    back unchanged (``Y``)  default: closed; legacy: as  default: staged, open
    missing, live           closed at run_ts - 1 s       copy, open, ``Y``
    missing, tombstone      unchanged                    -
    ======================  ===========================  ==========================

    The emission is one SQL expression (an array of at most two structs,
    ``inline``-d), evaluated inside the join's whole-stage code.
    """
    _check_compat(compat)
    k = spec.key
    attrs = ", ".join(spec.attrs)
    o = versions.selectExpr(f"{k} AS _ko", f"{OPEN_PRED} AS _open",
                            f"struct({attrs}, effective_from, effective_to, deleted_flg) AS o")
    s = stg.selectExpr(f"{k} AS _ks", f"struct({attrs}, update_dt) AS s")
    j = o.join(s, F.expr("_ko = _ks AND _open"), "full_outer").selectExpr(
        "coalesce(_ko, _ks) AS _k", "_open", "o", "s")

    ts = f"TIMESTAMP_NTZ'{stamp_text(run_ts)}'"
    open_ = f"TIMESTAMP_NTZ'{OPEN_END_TEXT}'"
    sec, day = "INTERVAL 1 SECOND", "INTERVAL 1 DAY"
    changed = " OR ".join(f"NOT (o.{a} <=> s.{a})" for a in spec.attrs)
    live = f"o.deleted_flg = '{FLAG_LIVE}'"
    deleted = f"(o IS NOT NULL AND s IS NULL AND _open AND {live})"
    returned = (f"(o IS NOT NULL AND s IS NOT NULL AND NOT ({changed}) AND NOT {live})"
                if compat == DEFAULT else "false")
    replaced = f"(o IS NOT NULL AND s IS NOT NULL AND (({changed}) OR {returned}))"
    if shifts_deletes(spec, compat):
        old_from = f"CASE WHEN {deleted} THEN o.effective_from - {day} ELSE o.effective_from END"
        del_to, tomb_from = f"o.effective_from - {sec}", f"o.effective_from + {day}"
    else:
        old_from, del_to, tomb_from = "o.effective_from", f"{ts} - {sec}", ts
    old_to = (f"CASE WHEN {deleted} THEN {del_to} WHEN {replaced} THEN s.update_dt - {sec} "
              f"ELSE o.effective_to END")
    old_row = (f"CASE WHEN o IS NOT NULL THEN "
               f"{_sql_version(spec, '_k', 'o', old_from, old_to, 'o.deleted_flg')} END")
    staged_row = _sql_version(spec, "_k", "s", "s.update_dt", open_, f"'{FLAG_LIVE}'")
    tomb_row = _sql_version(spec, "_k", "o", tomb_from, open_, f"'{FLAG_DELETED}'")
    new_row = (f"CASE WHEN o IS NULL THEN {staged_row} WHEN {deleted} THEN {tomb_row} "
               f"WHEN {replaced} THEN {staged_row} END")
    return j.selectExpr(f"inline(array_compact(array({old_row}, {new_row})))")


def apply_snapshot(hist: DataFrame, stg: DataFrame, spec: DimSpec, run_ts,
                   compat: str = DEFAULT, check_unique: bool = True) -> DataFrame:
    """History after applying one full snapshot (single pass).

    ``run_ts`` stamps deletions (keys missing from the snapshot); staged rows
    carry their own ``update_dt``. NULL keys are left out (see
    ``split_null_keys`` for the quarantine); duplicate keys fail the job.
    """
    stg = stg.select(*spec.columns, "update_dt").where(f"{spec.key} IS NOT NULL")
    if check_unique:
        stg = unique_keys(stg, spec)
    return snapshot_delta(hist.select(*spec.history_columns), stg, spec, run_ts, compat)


def deletion_guard(hist: DataFrame, stg: DataFrame, spec: DimSpec,
                   max_fraction: float) -> tuple[int, int]:
    """Fail before anything is written when a snapshot would delete more than
    ``max_fraction`` of the live keys (an empty or truncated extract would
    otherwise tombstone the whole dimension).

    One anti join on key columns only; returns (live keys, keys to delete).
    """
    live = live_rows(hist).select(spec.key)
    staged_keys = stg.select(spec.key).where(F.col(spec.key).isNotNull())
    r = (live.join(staged_keys, spec.key, "left_anti").select(F.lit(1).alias("gone"))
         .unionByName(live.select(F.lit(0).alias("gone")))
         .agg(F.count(F.lit(1)).alias("n"), F.sum("gone").alias("gone")).first())
    n_live, n_gone = int(r.n - (r.gone or 0)), int(r.gone or 0)
    if n_live and n_gone / n_live > max_fraction:
        raise ValueError(f"{spec.name}: snapshot deletes {n_gone} of {n_live} live keys "
                         f"(more than {max_fraction:.0%}); nothing published")
    return n_live, n_gone


# --- step by step ---------------------------------------------------------------------------
#
# Each step joins the whole history once with the staged snapshot on the key and
# re-emits every history row (possibly rewritten) plus the rows the step adds,
# so a chain of steps stays a linear plan: one join per step, where the single
# pass needs one join per run.

def _stg(stg: DataFrame, spec: DimSpec) -> DataFrame:
    return split_null_keys(stg.select(*spec.columns, "update_dt"), spec)[0]


def _join_stg(hist: DataFrame, stg: DataFrame, spec: DimSpec, how: str) -> DataFrame:
    s = _stg(stg, spec).select(F.col(spec.key).alias("_sk"),
                               F.struct(*spec.attrs, "update_dt").alias("s"))
    return hist.select(*spec.history_columns).join(s, F.col(spec.key) == F.col("_sk"), how)


def _hist_row(spec: DimSpec, frm: Column | None = None, to: Column | None = None) -> Column:
    return _version(spec, F.col(spec.key), [F.col(a) for a in spec.attrs],
                    F.col("effective_from") if frm is None else frm,
                    F.col("effective_to") if to is None else to, F.col("deleted_flg"))


def _staged_row(spec: DimSpec, key: Column | None = None) -> Column:
    s = F.col("s")
    return _version(spec, F.col(spec.key) if key is None else key, [s[a] for a in spec.attrs],
                    s["update_dt"], open_end(), F.lit(FLAG_LIVE))


def _emit(j: DataFrame, *rows: Column) -> DataFrame:
    return j.select(F.inline(F.array_compact(F.array(*rows))))


def _changed_vs_stg(spec: DimSpec) -> Column:
    return row_changed(spec.attrs, left_cols=[F.col(a) for a in spec.attrs],
                       right_cols=[F.col("s")[a] for a in spec.attrs])


def insert_versions(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Rows for staged keys unknown to every version: open, live, from ``update_dt``."""
    new = _stg(stg, spec).join(hist.select(spec.key), spec.key, "left_anti")
    return new.select(*spec.columns, F.col("update_dt").cast(TS).alias("effective_from"),
                      open_end().alias("effective_to"), F.lit(FLAG_LIVE).alias("deleted_flg"))


def _insert_step(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    j = _join_stg(hist, stg, spec, "full_outer")
    known = F.col("effective_to").isNotNull()
    return _emit(j, F.when(known, _hist_row(spec)),
                 F.when(~known, _staged_row(spec, F.col("_sk"))))


def close_changed(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """History with each open version whose attributes changed closed at ``update_dt - 1 s``.

    No test on ``deleted_flg``: a tombstone whose key comes back changed is closed too.
    """
    j = _join_stg(hist, stg, spec, "left")
    hit = F.coalesce(is_open(), F.lit(False)) & F.col("s").isNotNull() & _changed_vs_stg(spec)
    to = F.when(hit, minus_seconds(F.col("s")["update_dt"], 1)).otherwise(F.col("effective_to"))
    return _emit(j, _hist_row(spec, to=to))


def _opens(spec: DimSpec) -> Column:
    s = F.col("s")
    return (s.isNotNull() & (F.col("effective_to") == minus_seconds(s["update_dt"], 1))
            & _changed_vs_stg(spec))


def open_changed(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Replacement versions: staged rows whose key has a version closed at ``update_dt - 1 s``
    with different attributes (run after ``close_changed``)."""
    j = _join_stg(hist, stg, spec, "inner")
    return _emit(j, F.when(_opens(spec), _staged_row(spec)))


def _open_step(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    j = _join_stg(hist, stg, spec, "left")
    return _emit(j, _hist_row(spec), F.when(_opens(spec), _staged_row(spec)))


def reopen_returned(hist: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Default mode only: a tombstoned key that is back unchanged gets a live version;
    the tombstone closes at ``update_dt - 1 s``."""
    j = _join_stg(hist, stg, spec, "left")
    back = (is_open() & (F.col("deleted_flg") == F.lit(FLAG_DELETED)) & F.col("s").isNotNull()
            & ~_changed_vs_stg(spec))
    to = F.when(back, minus_seconds(F.col("s")["update_dt"], 1)).otherwise(F.col("effective_to"))
    return _emit(j, _hist_row(spec, to=to), F.when(back, _staged_row(spec)))


def mark_deleted(hist: DataFrame, stg: DataFrame, spec: DimSpec, run_ts,
                 compat: str = DEFAULT) -> DataFrame:
    """History with live keys missing from the snapshot tombstoned.

    The live version is closed at ``run_ts - 1 s`` and a ``'Y'`` copy opens at
    ``run_ts`` (legacy terminals: see module doc).
    """
    _check_compat(compat)
    j = _join_stg(hist, stg, spec, "left")
    gone = is_open() & (F.col("deleted_flg") == F.lit(FLAG_LIVE)) & F.col("s").isNull()
    frm, ts = F.col("effective_from"), run_stamp(run_ts)
    if shifts_deletes(spec, compat):
        old = _hist_row(spec, frm=F.when(gone, minus_days(frm, 1)).otherwise(frm),
                        to=F.when(gone, minus_seconds(frm, 1)).otherwise(F.col("effective_to")))
        tomb_from = plus_days(frm, 1)
    else:
        old = _hist_row(spec, to=F.when(gone, minus_seconds(ts, 1))
                        .otherwise(F.col("effective_to")))
        tomb_from = ts
    tomb = _version(spec, F.col(spec.key), [F.col(a) for a in spec.attrs], tomb_from,
                    open_end(), F.lit(FLAG_DELETED))
    return _emit(j, old, F.when(gone, tomb))


def apply_stepwise(hist: DataFrame, stg: DataFrame, spec: DimSpec, run_ts,
                   compat: str = DEFAULT) -> DataFrame:
    """Same result as ``apply_snapshot``, one step (one join) at a time."""
    _check_compat(compat)
    h = _insert_step(hist, stg, spec)
    h = close_changed(h, stg, spec)
    h = _open_step(h, stg, spec)
    if compat == DEFAULT:
        h = reopen_returned(h, stg, spec)
    return mark_deleted(h, stg, spec, run_ts, compat)
