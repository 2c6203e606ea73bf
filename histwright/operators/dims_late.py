"""Late days: a snapshot applied to a history that later runs have already extended.

A history is what its runs saw, run-length encoded: a version says that every run in its interval
saw these attributes, a tombstone that they saw none. A snapshot of an earlier time T therefore
changes, of each key, the stretch from T to the next run's time alone:

* before T stays what was in force there,
* from T on holds what the late snapshot says (a missing key: a tombstone of what was in force),
* from the next run on holds what that run saw: the version in force there. A tombstone copies the attributes
  last seen, now the late ones; a key seen by the late snapshot alone is deleted by the next run.

Neighbours that came out alike are one version again. The result is the history of all snapshots in order.

Only versions that reach T are read (a pushed filter on ``effective_to``); those that begin after the next run
give just their earliest start. Per key this is one aggregate and one join on the same shuffle, and all
other versions pass through without one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefn import stamp_text
from ..schemas import FLAG_DELETED, FLAG_LIVE, OPEN_END_TEXT, DimSpec
from .dims_type2 import unique_keys

_SECOND = "INTERVAL 1 SECOND"


def _stamp(text: str) -> str:
    return f"TIMESTAMP_NTZ'{text}'"


def _attrs(spec: DimSpec, src: str) -> str:
    return "struct(" + ", ".join(f"{src}.{a} AS {a}" for a in spec.attrs) + ")"


def _row(spec: DimSpec, src: str, frm: str, to: str, flag: str) -> str:
    fields = [f"'{spec.key}', _k", *(f"'{a}', {src}.{a}" for a in spec.attrs), f"'effective_from', {frm}",
              f"'effective_to', {to}", f"'deleted_flg', {flag}"]
    return f"named_struct({', '.join(fields)})"


def apply_late_snapshot(hist: DataFrame, stg: DataFrame, spec: DimSpec, run_ts, next_ts) -> DataFrame:
    """History after the snapshot of ``run_ts`` came in late; ``next_ts`` is the time of the first run after it.

    Default mode only (a legacy history doesn't tell a returned key from a deleted one). ``update_dt`` of the
    staged rows is not used: they hold from ``run_ts``. Rows with a NULL key are left out, duplicate keys fail, an
    empty snapshot deletes what was live at ``run_ts`` up to the next run. A version that begins from
    ``run_ts`` on but before ``next_ts`` fails the job, as then another run is the next one, or the day
    is loaded already.
    """
    late, then = stamp_text(run_ts), stamp_text(next_ts)
    if not late < then:
        raise ValueError(f"the next run ({then}) is not after the late one ({late}); apply_snapshot appends")
    k, t, n, open_ = spec.key, _stamp(late), _stamp(then), _stamp(OPEN_END_TEXT)
    hist = hist.select(*spec.history_columns)
    reach = hist.where(f"effective_to >= {t}").where(
        f"CASE WHEN effective_from >= {t} AND effective_from < {n} THEN raise_error(concat('{spec.name}: a run at ', "
        f"CAST(effective_from AS STRING), ' lies between the late one and the next')) ELSE true END")
    version = f"struct({', '.join(spec.attrs)}, effective_from, effective_to, deleted_flg)"
    # At most one version of a key holds before T, and one at the next run.
    around = reach.selectExpr(
        f"{k} AS _kh", f"CASE WHEN effective_from < {t} THEN {version} END AS p",
        f"CASE WHEN effective_from <= {n} AND effective_to >= {n} THEN {version} END AS x",
        f"CASE WHEN effective_from > {n} THEN effective_from END AS f")
    around = around.groupBy("_kh").agg(F.max("p").alias("p"), F.max("x").alias("x"), F.min("f").alias("f"))
    staged = unique_keys(stg.select(*spec.columns).where(f"{k} IS NOT NULL"), spec)
    staged = staged.selectExpr(f"{k} AS _ks", f"struct({', '.join(spec.attrs)}) AS s")
    joined = around.join(staged, F.expr("_kh = _ks"), "full_outer").selectExpr(
        "coalesce(_kh, _ks) AS _k", "p", "x", "f", "s",
        # What holds from T on: nothing, or attributes and a flag.
        f"CASE WHEN s IS NOT NULL THEN s WHEN p IS NOT NULL THEN {_attrs(spec, 'p')} END AS la",
        f"CASE WHEN s IS NOT NULL THEN '{FLAG_LIVE}' WHEN p IS NOT NULL THEN '{FLAG_DELETED}' END AS lf")
    joined = joined.selectExpr(
        "*",
        f"CASE WHEN x IS NOT NULL AND (x.deleted_flg = '{FLAG_LIVE}' OR la IS NULL) THEN {_attrs(spec, 'x')} ELSE la END AS xa",
        f"CASE WHEN x IS NOT NULL THEN x.deleted_flg WHEN la IS NOT NULL THEN '{FLAG_DELETED}' END AS xf",
        f"CASE WHEN x IS NOT NULL THEN x.effective_to ELSE coalesce(f - {_SECOND}, {open_}) END AS x_to")
    joined = joined.selectExpr(
        "*", f"p IS NOT NULL AND la IS NOT NULL AND {_attrs(spec, 'p')} <=> la AND p.deleted_flg = lf AS ab",
        "la IS NOT NULL AND la <=> xa AND lf = xf AS bc")
    late_to = f"CASE WHEN bc THEN x_to ELSE {n} - {_SECOND} END"
    before = _row(spec, "p", "p.effective_from", f"CASE WHEN ab THEN {late_to} ELSE {t} - {_SECOND} END", "p.deleted_flg")
    between, after = _row(spec, "la", t, late_to, "lf"), _row(spec, "xa", n, "x_to", "xf")
    changed = joined.selectExpr(
        f"inline(array_compact(array(CASE WHEN p IS NOT NULL THEN {before} END, "
        f"CASE WHEN la IS NOT NULL AND NOT ab THEN {between} END, CASE WHEN xa IS NOT NULL AND NOT bc THEN {after} END)))")
    untouched = hist.where(f"effective_to < {t} OR effective_to IS NULL OR effective_from > {n}")
    return untouched.unionByName(changed)
