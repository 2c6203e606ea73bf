"""Daily jobs: stage, apply dimensions, append facts, report, publish.

``run_type2_day`` is the history job, ``run_type1_day`` the insert-only one;
``replay`` runs a sequence of days. Inputs are ``DataFrame``s (from
``histwright.sources``) so the same job serves files, tables and streams.
The state a run starts from is read from the published warehouse, so each run
starts from Parquet scans: no lineage is carried from one run to the next.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.timefn import run_stamp, stamp_text
from ..operators import dims_type1 as d1
from ..operators import dims_type2 as d2
from ..operators import facts, meta, reports
from ..schemas import DIMS, EVENT_CONTRACT, EVENT_PASSPORT, META, TABLES, card_bucket, event_year
from ..sources import staging
from .publish import PartlyLoadedError, Run, State, current, start


@dataclass
class DayInputs:
    """One day's raw inputs (columns by name, any types castable to the staged ones).

    ``transactions`` and ``blacklist`` are the day's drops; ``terminals`` the
    terminal drop (stamped with ``terminals_ts``, the file date, when given);
    ``clients``, ``accounts``, ``cards`` full snapshots of the source tables
    (``account`` is accepted for ``account_num``). ``files`` are the names of
    the drop files, recorded in the manifest.
    """

    transactions: DataFrame
    terminals: DataFrame
    blacklist: DataFrame
    clients: DataFrame
    accounts: DataFrame
    cards: DataFrame
    terminals_ts: str | None = None
    files: list[str] = field(default_factory=list)


def run_id_of(run_ts) -> str:
    return stamp_text(run_ts).replace("-", "").replace(":", "").replace(" ", "T")


def stage_day(day: DayInputs, run_ts) -> dict[str, DataFrame]:
    """Typed, stamped staging frames of one day (lazy)."""
    return {
        "transactions": staging.stage_transactions(day.transactions),
        "blacklist": staging.stage_blacklist(day.blacklist),
        "terminals": staging.stage_terminals(day.terminals, day.terminals_ts or run_ts),
        "cards": staging.stage_cards(day.cards, run_ts),
        "accounts": staging.stage_accounts(day.accounts, run_ts),
        "clients": staging.stage_clients(day.clients, run_ts),
    }


def begin(spark: SparkSession, root: str, run_ts: str, files, skip_loaded_files: bool) -> Run | State:
    """The run to fill, or the published state when all its drop files (or, without any, the
    run itself) are loaded already. Raises ``PartlyLoadedError`` when only some are, and
    ``LateRunError`` for a run that is not after the published one."""
    rid = run_id_of(run_ts)
    now = current(spark, root)
    if skip_loaded_files:
        known = now.loaded(files)
        if files and known == set(files) or not files and rid == now.run_id:
            return now
        if known:
            raise PartlyLoadedError(f"already loaded: {sorted(known)}; not loaded: "
                                    f"{sorted(set(files) - known)}")
    state = start(spark, root, rid, redo=not skip_loaded_files)
    known = state.loaded(files) if not skip_loaded_files else set()
    return Run(state, rid, run_ts, set(files) - known)


def store_staging(run: Run, staged: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write every staging frame once, to this attempt's own folder, and read it from there.

    Guard, watermark, new ids, their bounds and the dimensions then all see the same rows,
    whatever the sources do meanwhile, and each source is read once.
    """
    def write(name: str, df: DataFrame) -> None:
        df.write.parquet(run.path(f"staging_{name}"))

    _run_all([lambda n=n, df=df: write(n, df) for n, df in staged.items()])
    return {n: run.spark.read.schema(df.schema).parquet(run.path(f"staging_{n}"))
            for n, df in staged.items()}


def keyed(run: Run, stg: dict[str, DataFrame], writes: list) -> dict[str, DataFrame]:
    """Each dimension's staged rows with a key, once each; writes of the rows without one join ``writes``."""
    out = {}
    for name, spec in DIMS.items():
        good, bad = d2.split_null_keys(stg[name].select(*spec.columns, "update_dt"), spec)
        out[name] = d2.unique_keys(good, spec)
        writes.append(lambda t=f"quarantine_{name}", df=bad: run.append(t, df))
    return out


def since(versions: DataFrame, run_ts: str) -> DataFrame:
    """Versions that begin with the run."""
    return versions.where(F.col("effective_from") >= run_stamp(run_ts))


def _meta(state: State, run: Run, stg: DataFrame) -> None:
    m = state.read("meta") if state.segments("meta") else meta.seed(state.spark)
    run.replace("meta", meta.update_watermark(m, stg, "stg_terminals").select(*META.fieldNames()))


def _run_all(writes, threads: int = 4) -> None:
    """Run independent segment writes as concurrent Spark jobs (the scheduler shares
    the executors between them); the first failure is raised after all finished,
    and the run is then not committed."""
    with ThreadPoolExecutor(max_workers=threads) as pool:
        futures = [pool.submit(w) for w in writes]
    for f in futures:
        f.result()


def run_type2_day(spark: SparkSession, root: str, day: DayInputs, run_ts,
                  compat: str = d2.DEFAULT, skip_loaded_files: bool = True,
                  max_delete_fraction: float | None = None, full_reports: bool = False) -> State:
    """One day of the history job, published all-or-nothing.

    Order as in the original job: staging and watermark, the four dimensions
    (single pass each), blacklist and new transactions, then both reports over
    the new state. With ``max_delete_fraction`` a snapshot that would delete a
    larger share of a dimension's live keys stops the run before any write but
    staging. Staged rows without a key go to the dimension's quarantine table.

    Default-mode reports look at the run's own operations and at cards whose profile the run
    changed (``incremental_reports``), not at all operations ever loaded;
    ``full_reports`` recomputes them from everything, with the same result.
    """
    run_ts = stamp_text(run_ts)
    run = begin(spark, root, run_ts, day.files, skip_loaded_files)
    if isinstance(run, State):
        return run
    state = run.state
    stg = store_staging(run, stage_day(day, run_ts))
    if max_delete_fraction is not None:
        for name, spec in DIMS.items():
            d2.deletion_guard(state.read(f"dim_{name}_hist"), stg[name], spec,
                              max_delete_fraction)
    writes = [lambda: _meta(state, run, stg["terminals"])]
    snapshots = keyed(run, stg, writes)
    for name, spec in DIMS.items():
        hist = state.read(f"dim_{name}_hist")
        dim_ts = day.terminals_ts if name == "terminals" and day.terminals_ts else run_ts
        delta = d2.snapshot_delta(hist.where(d2.is_open()), snapshots[name], spec, dim_ts, compat)
        writes.append(lambda t=f"dim_{name}_hist", df=delta: run.history(t, df))
    fact_tx = state.read("fact_transactions")
    writes.append(lambda: run.append("fact_passport_blacklist", stg["blacklist"]))

    def new_facts() -> None:
        # Fact segments are sorted by id, so their Parquet statistics let the next
        # runs' id-range filter skip them.
        path = run.append("fact_transactions", facts.new_rows(
            fact_tx, stg["transactions"], "trans_id", eager_bounds=True)
            .sortWithinPartitions("trans_id"))
        # (card, day) statistics of this run's new operations only: the reports
        # merge the kept statistics instead of re-reading every operation each day.
        new_tx = state.spark.read.schema(TABLES["fact_transactions"]).parquet(path)
        run.append("fact_card_day_stats", reports.day_statistics(new_tx))

    writes.append(new_facts)
    _run_all(writes)
    if compat == d2.DEFAULT and not full_reports:
        incremental_reports(run, run_ts)
        return run.commit()
    cards, accounts, clients = (run.read(f"dim_{d}_hist") for d in HOLDERS)
    stats, prior = run.read("fact_card_day_stats"), state.read("rep_fraud")
    columns = TABLES["rep_fraud"].fieldNames()
    # The passport rows are written first; the legacy contract report reads them back as reported.
    run.append("rep_fraud", reports.passport_events(
        None, cards, accounts, clients, run.read("fact_passport_blacklist"), prior, run_ts, compat,
        stats=stats).select(*columns), "passport")
    seen = run.read("rep_fraud") if compat == d2.LEGACY else prior
    run.append("rep_fraud", reports.contract_events(
        None, cards, accounts, clients, seen, run_ts, compat, stats=stats).select(*columns), "contract")
    # The kept profiles are of an earlier run now: the next incremental run builds them anew.
    run.drop("card_profile")
    return run.commit()


#: Dimensions on the way from a card to its holder.
HOLDERS = ("cards", "accounts", "clients")


def _values(df: DataFrame, column) -> list[int]:
    """Distinct partition numbers (at most as many as there are buckets)."""
    return sorted(r[0] for r in df.select(column).distinct().collect() if r[0] is not None)


def incremental_reports(run: Run, run_ts: str) -> None:
    """Both default-mode reports from the kept state, of which only what the run touches is read.

    Statistics and profiles are stored in hash buckets of the card. The run's own operations meet the kept
    profiles of their buckets. Earlier statistics matter only for cards whose profile the run changed: their
    buckets alone are read, and their profiles are worked out anew from the histories and replace the kept
    ones. On a day without changes no earlier statistics and no history are read at all. The candidates
    are written first; of the earlier report rows then only their years' folders and days are read.
    """
    state = run.state
    hist = {d: run.read(f"dim_{d}_hist") for d in HOLDERS}
    listed, new = run.read("fact_passport_blacklist"), run.read_new("fact_card_day_stats")
    if not state.segments("card_profile"):  # the first run, or one after a full report
        run.append("card_profile", reports.kept_profiles(*hist.values(), listed, run_ts), "reports")
        stats = run.read("fact_card_day_stats")
    else:
        changed = [since(run.read_new(f"dim_{d}_hist"), run_ts) for d in HOLDERS]
        entries = run.read_new("fact_passport_blacklist")
        stats = new
        some = entries.select(F.lit(1))
        for df in changed:
            some = some.union(df.select(F.lit(1)))
        if not some.isEmpty():
            held = run.store("affected", reports.affected_cards(*hist.values(), *changed, entries))
            buckets = _values(held, card_bucket())
            trimmed = hist["cards"].withColumn("_card", F.trim("card_num"))
            cards = trimmed.join(held.select(F.col("card_num").alias("_card")), "_card", "left_semi").drop("_card")
            run.append("card_profile", reports.kept_profiles(cards, hist["accounts"], hist["clients"], listed, run_ts),
                       "reports")
            earlier = (state.scan("fact_card_day_stats").where(F.col("bucket").isin(buckets)).drop("bucket")
                       .join(held, "card_num", "left_semi"))
            stats = earlier.unionByName(new)
    merged = run.store("statistics", reports.merge_statistics(stats))
    profiles = run.now().scan("card_profile").where(F.col("bucket").isin(_values(merged, card_bucket())))
    profiles = reports.latest_profiles(profiles.drop("bucket"))
    columns = TABLES["rep_fraud"].fieldNames()

    def report(event_type: str, part: str) -> None:
        found = run.store(f"candidates_{part}", reports.candidates(merged, profiles, event_type))
        # The years choose folders, the first and last day the files and row groups in them.
        days = found.agg(F.collect_set(event_year()), F.min("event_dt"), F.max("event_dt")).first()
        prior = state.scan("rep_fraud").where(F.col("event_year").isin(sorted(days[0])))
        if days[0]:
            prior = prior.where(F.col("event_dt").between(days[1], days[2]))
        run.append("rep_fraud", reports.unreported(found, prior, event_type, run_ts).select(*columns), part)

    _run_all([lambda: report(EVENT_PASSPORT, "passport"), lambda: report(EVENT_CONTRACT, "contract")])


def run_type1_day(spark: SparkSession, root: str, day: DayInputs, run_ts,
                  skip_loaded_files: bool = True) -> State:
    """One day of the insert-only job: new keys, all facts, source-based reports."""
    run_ts = stamp_text(run_ts)
    run = begin(spark, root, run_ts, day.files, skip_loaded_files)
    if isinstance(run, State):
        return run
    state = run.state
    stg = store_staging(run, stage_day(day, run_ts))
    writes = [lambda: _meta(state, run, stg["terminals"])]
    snapshots = keyed(run, stg, writes)
    for name, spec in DIMS.items():
        rows = d1.new_rows(state.read(f"dim_{name}"), snapshots[name], spec)
        writes.append(lambda t=f"dim_{name}", df=rows: run.append(t, df))
    writes.append(lambda: run.append("fact_passport_blacklist", stg["blacklist"]))
    writes.append(lambda: run.append("fact_transactions_type1",
                                     staging.type1_transactions(stg["transactions"])))
    rep = reports.expired_passports(stg["clients"], run_ts).unionByName(
        reports.expired_contracts(stg["accounts"], run_ts))
    writes.append(lambda: run.append("rep_fraud_type1", rep))
    _run_all(writes)
    return run.commit()


def replay(spark: SparkSession, root: str, days, run_times, kind: str = "type2",
           compat: str = d2.DEFAULT) -> State:
    """Run consecutive days in order (each publishes before the next starts)."""
    state = None
    for day, ts in zip(days, run_times):
        if kind == "type2":
            state = run_type2_day(spark, root, day, ts, compat)
        else:
            state = run_type1_day(spark, root, day, ts)
    return state
