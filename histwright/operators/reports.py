"""Fraud reports.

Type 1 (source snapshot): clients with an expired passport, accounts with an
expired contract.

Type 2 (warehouse): operations made with an expired or blacklisted passport
(event ``'1'``) or under an expired contract (event ``'2'``). An operation is
joined to every version of card, account and client (no validity test), and
each (day, passport, name, phone) is reported once; rows reported earlier are
suppressed.

Plan shape, built for a fact table far larger than any dimension and for hot
keys (one card, account or client may own a large share of all operations):

1. operations are reduced to one row per (card, day) with the few statistics the
   predicates need (latest time, latest time after midnight, any operation at
   midnight); the partial aggregate runs before the shuffle, so a hot card sends
   one row per day and task, not its operations;
2. the dimension chain card -> account -> client (-> first blacklist entry) is
   joined on its own into per-card profiles (dimension-sized), so the fact side
   meets one join, on the card number;
3. candidate rows are filtered and made distinct (partial aggregation before the
   shuffle), then anti/left-joined with earlier report rows on (passport, day).

Joins are plain equi-joins: AQE turns them into broadcasts when a side is
measured small at run time, and splits skewed partitions otherwise.

``compat="legacy"`` reproduces the original SQL literally: ``A or B and not
exists`` (only the blacklist branch is suppressed), suppression matches an
operation time against a report date (so only operations at midnight can be
suppressed), ignores the event type, and the contract report also sees the
passport report rows of the same run. The default suppresses both branches,
compares days, only looks at earlier rows of the same event type, and suppresses a person
without a passport by name and phone, so such a row is reported once too.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.timefn import run_stamp
from ..schemas import EVENT_CONTRACT, EVENT_PASSPORT, REASON_CONTRACT, REASON_PASSPORT, TS

DEFAULT = "default"
LEGACY = "legacy"

#: Whom a report row names.
PERSON = ("passport", "fio", "phone")


# --- type 1 ----------------------------------------------------------------------------------

def expired_passports(clients: DataFrame, run_ts) -> DataFrame:
    """Clients whose passport expired before the run: (client_id, reason, report_dt)."""
    ts = run_stamp(run_ts)
    vt = F.col("passport_valid_to")
    return clients.where(vt.isNotNull() & (vt.cast(TS) < ts)).select(
        "client_id", F.lit(REASON_PASSPORT).alias("blcklst_reason"), ts.alias("report_dt"))


def expired_contracts(accounts: DataFrame, run_ts) -> DataFrame:
    """Accounts whose contract ended before the run: (client as client_id, reason, report_dt)."""
    ts = run_stamp(run_ts)
    return accounts.where(F.col("valid_to").cast(TS) < ts).select(
        F.col("client").alias("client_id"), F.lit(REASON_CONTRACT).alias("blcklst_reason"),
        ts.alias("report_dt"))


# --- type 2: shared plan -----------------------------------------------------------------------

def _day_stats(trans: DataFrame, late: bool = True) -> DataFrame:
    """One row per (card_num, event_dt): latest time and, when ``late``, the latest
    time after midnight and whether any operation ran exactly at midnight."""
    ts = F.col("trans_date").cast(TS)
    day = F.to_date(ts)
    at_midnight = ts == day.cast(TS)
    aggs = [F.max(ts).alias("max_ts")]
    if late:
        aggs += [F.max(F.when(~at_midnight, ts)).alias("max_late_ts"),
                 F.bool_or(at_midnight).alias("has_midnight")]
    return (trans.select("card_num", ts.alias("trans_date"))
            .groupBy("card_num", day.alias("event_dt")).agg(*aggs))


def day_statistics(trans: DataFrame) -> DataFrame:
    """The (card, day) statistics of a set of operations; mergeable (see
    ``merge_statistics``), so a warehouse can keep them per load instead of
    re-reading every operation for each report."""
    return _day_stats(trans, late=True)


def merge_statistics(stats: DataFrame) -> DataFrame:
    """Combine statistics kept per load into one row per (card, day): the
    maxima and the midnight flag are associative, so the result equals the
    statistics of all operations at once."""
    return stats.groupBy("card_num", "event_dt").agg(
        F.max("max_ts").alias("max_ts"), F.max("max_late_ts").alias("max_late_ts"),
        F.bool_or("has_midnight").alias("has_midnight"))


def _fio(last: str = "last_name", first: str = "first_name", middle: str = "patronymic") -> Column:
    """Full name; NULL when any part is NULL."""
    return F.concat(F.col(last), F.lit(" "), F.col(first), F.lit(" "), F.col(middle))


def card_profiles(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  blacklist: DataFrame | None = None, need_client: bool = False,
                  mark_known: bool = False) -> DataFrame:
    """Per trimmed card number and person (passport, name, phone) what the reports test: the
    earliest contract end, passport end and (with ``blacklist``) blacklist entry over all
    versions of card, account and client.

    Every test of the reports is "later than (or at) the bound", so of several versions
    the earliest bound decides, and the versions collapse before the fact is joined.
    The account-level part (account -> client -> first blacklist entry) is joined
    and collapsed first, on the account-sized side; the card side meets it once. The joins above
    read plain shuffles, so adaptive execution can still split a hot account or card.
    Accounts are required; clients too with ``need_client``, else a card without one keeps a
    NULL person. ``mark_known`` adds whether there is a client at all, for profiles that both reports read.
    """
    bounds = ["_vt", "_ct"] + (["_entry"] if blacklist is not None else [])
    person = [*PERSON] + (["known"] if mark_known else [])

    def collapse(df: DataFrame, key: str) -> DataFrame:
        return df.groupBy(key, *person).agg(*[F.min(b).alias(b) for b in bounds])

    c = cards.select(F.trim("card_num").alias("card_num"), "account_num").where(
        F.col("account_num").isNotNull())
    a = accounts.select("account_num", "client", F.col("valid_to").cast(TS).alias("_ct"))
    cl = clients.select(F.col("client_id").alias("client"),
                        F.col("passport_num").alias("passport"), _fio().alias("fio"), "phone",
                        F.col("passport_valid_to").cast(TS).alias("_vt"))
    if mark_known:
        cl = cl.withColumn("known", F.lit(True))
    acc = a.join(cl, "client", "inner" if need_client else "left")
    if mark_known:
        acc = acc.withColumn("known", F.coalesce("known", F.lit(False)))
    if blacklist is not None:
        first_entry = (blacklist.where(F.col("passport_num").isNotNull())
                       .groupBy(F.col("passport_num").alias("passport"))
                       .agg(F.min(F.col("entry_dt").cast(TS)).alias("_entry")))
        acc = acc.join(first_entry, "passport", "left")
    return collapse(c.join(collapse(acc, "account_num"), "account_num"), "card_num")


def person_key() -> Column:
    """Whom an earlier report row suppresses in default mode: the passport or, where that is not
    known, name and phone as far as they are (NULL equals NULL)."""
    unknown = F.concat(F.lit("N"), F.coalesce("fio", F.lit("")), F.lit("|"), F.coalesce("phone", F.lit("")))
    return F.coalesce(F.concat(F.lit("P"), F.col("passport")), unknown)


def _distinct_marks(cand: DataFrame, marks: list[str]) -> DataFrame:
    """One row per (day, person) of the candidates with any of the boolean ``marks``, and which of them it has.

    The distinct is a regular aggregate, so duplicates collapse map-side before
    the shuffle (a hot client on one day must not send all its candidate rows
    to one task); only distinct rows meet the suppression join. The marks travel as bits of
    one number: frames that read different marks share the aggregate's exchange, as
    none of them can drop a column of it.
    """
    bits = functools.reduce(Column.__add__, [F.when(F.col(m), 1 << i).otherwise(0) for i, m in enumerate(marks)])
    found = (cand.where(functools.reduce(Column.__or__, [F.col(m) for m in marks]))
             .groupBy("event_dt", *PERSON).agg(F.bit_or(bits).alias("_marks")))
    return found.select("event_dt", *PERSON, *[(F.col("_marks").bitwiseAND(1 << i) != 0).alias(m)
                                               for i, m in enumerate(marks)])


def distinct_candidates(cand: DataFrame) -> DataFrame:
    """One row per (day, person) of the candidates that a report keeps or checks."""
    return _distinct_marks(cand, ["keep", "check"])


def unreported(grouped: DataFrame, prior: DataFrame, event_type: str, run_ts, compat: str = DEFAULT,
               this_run: DataFrame | None = None) -> DataFrame:
    """The report rows of distinct candidates, without those that earlier rows (``prior``) suppress.

    Only earlier rows of the candidates' own days can suppress one, so ``prior`` may be any part that holds those.
    In legacy mode only rows that are checked and not kept meet the earlier ones, and those of ``this_run`` after them.
    """
    if compat == LEGACY:
        # A missing passport matches nothing. On the earlier rows' side it gets a key of its own instead of
        # a filter, which would make their plan another than that of the same rows elsewhere in a run.
        key = F.concat(F.lit("P"), F.col("passport"))
        checked = grouped.where(~F.col("keep") & F.col("check")).withColumn("_passport", key)
        for earlier in [prior] + ([this_run] if this_run is not None else []):
            seen = earlier.select("event_dt", F.coalesce(key, F.lit("N")).alias("_passport"))
            checked = checked.join(seen, ["event_dt", "_passport"], "left_anti")
        out = grouped.where("keep").unionByName(checked.select(*grouped.columns))
    else:
        missing = [F.lit(None).cast("string").alias(c) for c in ("fio", "phone") if c not in prior.columns]
        seen = (prior.where(F.col("event_type") == F.lit(event_type)).select("*", *missing)
                .select("event_dt", person_key().alias("_person")))
        out = grouped.withColumn("_person", person_key()).join(seen, ["event_dt", "_person"], "left_anti")
    return out.select("event_dt", *PERSON, F.lit(event_type).alias("event_type"), run_stamp(run_ts).alias("report_dt"))


def _finish(cand: DataFrame, prior: DataFrame, event_type: str, run_ts, compat: str) -> DataFrame:
    """Distinct report rows from candidates, suppressing rows reported before.

    ``cand`` has (event_dt, passport, fio, phone, keep, check): ``keep`` rows are
    reported unless suppressed in default mode; ``check`` rows (legacy only) are
    reported only when no earlier row has the same passport and day.
    """
    return unreported(distinct_candidates(cand), prior, event_type, run_ts, compat)


def _check(compat: str) -> None:
    if compat not in (DEFAULT, LEGACY):
        raise ValueError(f"compat must be {DEFAULT!r} or {LEGACY!r}, got {compat!r}")


def _no(c: Column) -> Column:
    return F.coalesce(c, F.lit(False))


def passport_marks(compat: str) -> tuple[Column, Column]:
    """(keep, check) of the passport report for day statistics joined to card profiles."""
    expired = _no(F.col("max_ts") > F.col("_vt"))
    if compat == LEGACY:
        return (expired | _no(F.col("max_late_ts") >= F.col("_entry")),
                _no(F.col("has_midnight") & (F.col("event_dt").cast(TS) >= F.col("_entry"))))
    return expired | _no(F.col("max_ts") >= F.col("_entry")), F.lit(False)


def contract_marks(compat: str) -> tuple[Column, Column]:
    """(keep, check) of the contract report for day statistics joined to card profiles."""
    if compat == LEGACY:
        return (_no(F.col("max_late_ts") > F.col("_ct")),
                _no(F.col("has_midnight") & (F.col("event_dt").cast(TS) > F.col("_ct"))))
    return _no(F.col("max_ts") > F.col("_ct")), F.lit(False)


def _candidates(stats: DataFrame, marks: tuple[Column, Column]) -> DataFrame:
    return stats.select("event_dt", *PERSON, marks[0].alias("keep"), marks[1].alias("check"))


def passport_candidates(stats: DataFrame, compat: str) -> DataFrame:
    """Passport-report candidates from day statistics joined to card profiles."""
    return _candidates(stats, passport_marks(compat))


def contract_candidates(stats: DataFrame, compat: str) -> DataFrame:
    """Contract-report candidates from day statistics joined to card profiles."""
    return _candidates(stats, contract_marks(compat))


def _stats(trans, profiles, compat, stats=None):
    """Day statistics joined to profiles. Operations without a time pass no test; they go here, for every
    report alike, and not by filters that are inferred for some uses only (their plans would differ)."""
    day = merge_statistics(stats) if stats is not None else _day_stats(trans, late=compat == LEGACY)
    return day.where("event_dt IS NOT NULL AND max_ts IS NOT NULL").join(profiles, "card_num")


# --- type 2: reports ---------------------------------------------------------------------------

def passport_events(trans: DataFrame, cards: DataFrame, accounts: DataFrame,
                    clients: DataFrame, blacklist: DataFrame, prior: DataFrame, run_ts,
                    compat: str = DEFAULT, stats: DataFrame | None = None) -> DataFrame:
    """Operations with an expired passport (``trans_date > passport_valid_to``) or a
    blacklisted one (``entry_dt <= trans_date``): event ``'1'``.

    ``cards``, ``accounts``, ``clients`` are history dimensions (all versions),
    ``blacklist`` the blacklist fact, ``prior`` earlier report rows. ``stats``
    (kept (card, day) statistics, see ``day_statistics``) replaces ``trans``.
    """
    _check(compat)
    prof = card_profiles(cards, accounts, clients, blacklist, need_client=True).where(
        F.col("_vt").isNotNull() | F.col("_entry").isNotNull())
    cand = passport_candidates(_stats(trans, prof, compat, stats), compat)
    return _finish(cand, prior, EVENT_PASSPORT, run_ts, compat)


def contract_events(trans: DataFrame, cards: DataFrame, accounts: DataFrame,
                    clients: DataFrame, prior: DataFrame, run_ts,
                    compat: str = DEFAULT, stats: DataFrame | None = None) -> DataFrame:
    """Operations after the account's contract ended (``trans_date > valid_to``): event ``'2'``.

    Accounts without a (known) client are reported with NULL passport, name and
    phone. In legacy mode ``prior`` must already hold this run's passport report.
    """
    _check(compat)
    prof = card_profiles(cards, accounts, clients).where(F.col("_ct").isNotNull())
    cand = contract_candidates(_stats(trans, prof, compat, stats), compat)
    return _finish(cand, prior, EVENT_CONTRACT, run_ts, compat)


def affected_cards(cards: DataFrame, accounts: DataFrame, clients: DataFrame, new_cards: DataFrame,
                   new_accounts: DataFrame, new_clients: DataFrame, new_blacklist: DataFrame) -> DataFrame:
    """Trimmed numbers of the cards whose profile got a new bound: a new version of the card, of an account
    of its, of a client of that, or a new blacklist entry of the client's passport.

    All other (card, day) rows met the same bounds before, so what they give in default mode was
    reported then and is suppressed now. ``new_*``: versions and entries that begin with the run.
    """
    listed = clients.join(new_blacklist.select("passport_num"), "passport_num", "left_semi").select("client_id")
    people = listed.unionByName(new_clients.select("client_id")).select(F.col("client_id").alias("client"))
    owned = accounts.join(people, "client", "left_semi").select("account_num")
    books = owned.unionByName(new_accounts.select("account_num"))
    return (cards.join(books, "account_num", "left_semi").select("card_num")
            .unionByName(new_cards.select("card_num")).select(F.trim("card_num").alias("card_num")).distinct())


def kept_profiles(cards: DataFrame, accounts: DataFrame, clients: DataFrame, blacklist: DataFrame,
                  run_ts) -> DataFrame:
    """Profiles that both reports read, stamped with the run (see ``schemas.CARD_PROFILE``)."""
    return (card_profiles(cards, accounts, clients, blacklist, mark_known=True)
            .select("card_num", "passport", "fio", "phone", "known", "_vt", "_ct", "_entry",
                    run_stamp(run_ts).alias("run_ts")))


def latest_profiles(profiles: DataFrame) -> DataFrame:
    """Each card's rows of the latest run that wrote any: those replace all earlier ones, whose persons may be others."""
    last = F.max("run_ts").over(Window.partitionBy("card_num"))
    return profiles.withColumn("_last", last).where(F.col("run_ts") == F.col("_last")).drop("_last")


def candidates(stats: DataFrame, profiles: DataFrame, event_type: str) -> DataFrame:
    """Distinct default-mode candidates of a report from merged statistics and kept profiles."""
    if event_type == EVENT_PASSPORT:
        held = profiles.where(F.col("known") & (F.col("_vt").isNotNull() | F.col("_entry").isNotNull()))
        return distinct_candidates(passport_candidates(stats.join(held, "card_num"), DEFAULT))
    held = profiles.where(F.col("_ct").isNotNull())
    return distinct_candidates(contract_candidates(stats.join(held, "card_num"), DEFAULT))


def run_reports(trans: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                blacklist: DataFrame, prior: DataFrame, run_ts,
                compat: str = DEFAULT, stats: DataFrame | None = None) -> DataFrame:
    """Both reports of one run, as the rows to append (passport report first).

    The same rows as ``passport_events`` and ``contract_events`` give, from one pass: one set of
    profiles, one join with the statistics and one distinct of the candidates of both.
    """
    _check(compat)
    profiles = card_profiles(cards, accounts, clients, blacklist, mark_known=True)
    joined = _stats(trans, profiles, compat, stats)
    keep_1, check_1 = passport_marks(compat)
    keep_2, check_2 = contract_marks(compat)
    both = _distinct_marks(joined.select(
        "event_dt", *PERSON, (F.col("known") & keep_1).alias("keep_1"), (F.col("known") & check_1).alias("check_1"),
        keep_2.alias("keep_2"), check_2.alias("check_2")), ["keep_1", "check_1", "keep_2", "check_2"])

    def of(report: str) -> DataFrame:
        keep, check = F.col(f"keep_{report}"), F.col(f"check_{report}")
        return both.where(keep | check).select("event_dt", *PERSON, keep.alias("keep"), check.alias("check"))

    # In legacy mode the contract report also sees this run's passport rows. Rows that ``prior`` suppresses may be
    # among them here: ``prior`` holds their (passport, day) already, so they need no suppression of their own.
    return (unreported(of("1"), prior, EVENT_PASSPORT, run_ts, compat)
            .unionByName(unreported(of("2"), prior, EVENT_CONTRACT, run_ts, compat,
                                    of("1") if compat == LEGACY else None)))
