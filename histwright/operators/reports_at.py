"""Fraud reports at the point in time: an operation meets the versions that were in force when it was made.

The reports of ``reports`` join an operation to every version of its card, account and client. Here only the
version in force counts: the last one that began at or before the operation, and for operations before the
first version that one, since histories begin when loading began. A tombstone in force means that the
card or account was gone, so nothing is reported; a client that was gone leaves NULL passport, name and phone.

Plan shape:

1. versions become spans [from, until) by one window per dimension; spans of card, account and client are joined
   on their keys where they overlap, so the dimensions give one list of spans per card;
2. operations are reduced to one row per (card, day), which alone meets the spans. Where a span holds for the whole
   day up to its last operation, the latest time decides, as in ``reports``;
3. only days within which a version changed need single operations: those are joined to that day's spans on
   (card, day) and reduced again before the shuffle. A hot card is thus dealt by day, and a hot day of one
   card is split by adaptive execution, as the other side has few rows.

Defined results: rows with a NULL key, card number or time are not reported; versions that begin together
count in the order of their ends; padded card numbers match as in ``reports``; repeated operations and
versions give a row once; empty inputs give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import EVENT_CONTRACT, EVENT_PASSPORT, FLAG_LIVE, TS
from .reports import (DEFAULT, _day_stats, _finish, _fio, contract_candidates, passport_candidates)


def spans(hist: DataFrame, key: str) -> DataFrame:
    """Versions with ``_from`` and ``_until``: in force at ``_from <= t < _until``; NULL is without a bound."""
    w = Window.partitionBy(key).orderBy("effective_from", "effective_to")
    return (hist.where(F.col(key).isNotNull())
            .withColumn("_from", F.when(F.row_number().over(w) > 1, F.col("effective_from")))
            .withColumn("_until", F.lead("effective_from").over(w)))


def _starts_before(start: str, end: Column) -> Column:
    return F.coalesce(F.col(start) < end, F.lit(True))


def _overlap(left: DataFrame, right: DataFrame, on: str, how: str = "inner") -> DataFrame:
    """Join on ``on`` where the spans overlap; the span is what they share."""
    r = right.withColumnsRenamed({on: "_on", "_from": "_rfrom", "_until": "_runtil"})
    met = ((F.col(on) == F.col("_on")) & _starts_before("_from", F.col("_runtil"))
           & _starts_before("_rfrom", F.col("_until")))
    return (left.join(r, met, how)
            .withColumn("_from", F.greatest("_from", "_rfrom")).withColumn("_until", F.least("_until", "_runtil"))
            .where(_starts_before("_from", F.col("_until"))).drop("_on", "_rfrom", "_runtil"))


def profile_spans(cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                  blacklist: DataFrame | None = None) -> DataFrame:
    """Per trimmed card number and span: person, passport end, contract end, first blacklist entry."""
    live = F.col("deleted_flg") == F.lit(FLAG_LIVE)

    def known(c: Column) -> Column:
        return F.when(live, c)

    c = spans(cards, "card_num").where(live & F.col("account_num").isNotNull()).select(
        F.trim("card_num").alias("card_num"), "account_num", "_from", "_until")
    a = spans(accounts, "account_num").where(live).select(
        "account_num", "client", F.col("valid_to").cast(TS).alias("_ct"), "_from", "_until")
    cl = spans(clients, "client_id").select(
        F.col("client_id").alias("client"), known(F.col("passport_num")).alias("passport"),
        known(_fio()).alias("fio"), known(F.col("phone")).alias("phone"),
        known(F.col("passport_valid_to").cast(TS)).alias("_vt"), "_from", "_until")
    books = _overlap(a, cl, "client", "left")
    if blacklist is not None:
        entry = (blacklist.where(F.col("passport_num").isNotNull()).groupBy(F.col("passport_num").alias("passport"))
                 .agg(F.min(F.col("entry_dt").cast(TS)).alias("_entry")))
        books = books.join(entry, "passport", "left")
    return _overlap(c, books, "account_num").drop("account_num", "client")


def _at(trans: DataFrame, profiles: DataFrame, bounds: list[str], hit: Column) -> DataFrame:
    """(event_dt, person, bounds, max_ts): the latest operation of a day under each span that ``hit`` may hold for."""
    held = ["event_dt", "passport", "fio", "phone", *bounds]
    day_start = F.col("event_dt").cast(TS)
    pieces = _day_stats(trans, late=False).join(profiles, "card_num").where(
        hit & F.coalesce(F.col("_from") <= F.col("max_ts"), F.lit(True)) & F.coalesce(F.col("_until") > day_start, F.lit(True)))
    whole = (F.coalesce(F.col("_from") <= day_start, F.lit(True))
             & F.coalesce(F.col("_until") > F.col("max_ts"), F.lit(True)))
    cut = pieces.where(~whole).select("card_num", "_from", "_until", *held)
    at = F.col("trans_date").cast(TS)
    ops = trans.select("card_num", at.alias("_t"), F.to_date(at).alias("event_dt"))
    inside = (F.coalesce(F.col("_from") <= F.col("_t"), F.lit(True))
              & F.coalesce(F.col("_until") > F.col("_t"), F.lit(True)))
    single = ops.join(cut, ["card_num", "event_dt"]).where(inside).groupBy(*held).agg(F.max("_t").alias("max_ts"))
    return pieces.where(whole).select(*held, "max_ts").unionByName(single)


def passport_events_at(trans: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                       blacklist: DataFrame, prior: DataFrame, run_ts) -> DataFrame:
    """Operations with a passport that had expired or was blacklisted by the versions then in force: event ``'1'``."""
    hit = F.coalesce(F.col("max_ts") > F.col("_vt"), F.lit(False)) | F.coalesce(
        F.col("max_ts") >= F.col("_entry"), F.lit(False))
    stats = _at(trans, profile_spans(cards, accounts, clients, blacklist), ["_vt", "_entry"], hit)
    return _finish(passport_candidates(stats, DEFAULT), prior, EVENT_PASSPORT, run_ts, DEFAULT)


def contract_events_at(trans: DataFrame, cards: DataFrame, accounts: DataFrame, clients: DataFrame,
                       prior: DataFrame, run_ts) -> DataFrame:
    """Operations after the end of the contract then in force: event ``'2'``."""
    stats = _at(trans, profile_spans(cards, accounts, clients), ["_ct"], F.col("max_ts") > F.col("_ct"))
    return _finish(contract_candidates(stats, DEFAULT), prior, EVENT_CONTRACT, run_ts, DEFAULT)
