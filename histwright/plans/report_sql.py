"""The type-2 reports as SQL over one row per operation: the oracle's and the tests' reference form."""

from __future__ import annotations


def report(which: str, compat: str, ops: str = "transactions", cards: str = "cards_hist",
           accounts: str = "accounts_hist", clients: str = "clients_hist",
           blacklist: str = "blacklist", prior: str = "prior_report") -> str:
    """Distinct (event_dt, passport, fio, phone) of the passport (``'1'``) or contract (``'2'``) report.

    ``prior`` holds earlier report rows (event_dt, passport, fio, phone, event_type); for the legacy contract report
    also this run's passport rows.
    """
    legacy = compat == "legacy"
    when = "o.at" if legacy else "o.on_day"
    kind = "" if legacy else f" AND p.event_type = '{which}'"
    # Default: a person without a passport is known by name and phone.
    person = ("coalesce('P' || {0}.passport, 'N' || coalesce({0}.fio, '') || '|' || coalesce({0}.phone, ''))"
              if not legacy else "{0}.passport")
    told = (f"EXISTS (SELECT 1 FROM {prior} p WHERE {person.format('p')} = {person.format('w')} "
            f"AND p.event_dt = {when}{kind})")
    if which == "2":
        test = f"o.at > w.contract_end AND NOT {told}"
    else:
        expired = "coalesce(o.at > w.passport_end, false)"
        listed = (f"EXISTS (SELECT 1 FROM {blacklist} b WHERE b.passport_num = w.passport "
                  "AND b.entry_dt <= o.at)")
        test = (f"{expired} OR ({listed} AND NOT {told})" if legacy
                else f"({expired} OR {listed}) AND NOT {told}")
    return f"""
WITH holders AS (
  SELECT trim(k.card_num) AS card_no, a.valid_to AS contract_end, h.passport_num AS passport, h.phone,
         h.passport_valid_to AS passport_end,
         h.last_name || ' ' || h.first_name || ' ' || h.patronymic AS fio
  FROM {cards} k JOIN {accounts} a ON a.account_num = k.account_num
  LEFT JOIN {clients} h ON h.client_id = a.client),
o AS (SELECT card_num, trans_date AS at, CAST(trans_date AS DATE) AS on_day FROM {ops})
SELECT o.on_day AS event_dt, w.passport, w.fio, w.phone
FROM o JOIN holders w ON w.card_no = o.card_num
WHERE {test}
GROUP BY o.on_day, w.passport, w.fio, w.phone"""


def report_at(which: str, ops: str = "transactions", cards: str = "cards_hist", accounts: str = "accounts_hist",
              clients: str = "clients_hist", blacklist: str = "blacklist", prior: str = "prior_report") -> str:
    """The same rows at the point in time: each operation joined to the one version in force when it was made."""
    def versions(table: str, key: str) -> str:
        order = f"(PARTITION BY {key} ORDER BY effective_from, effective_to)"
        return (f"SELECT *, row_number() OVER {order} AS nth, lead(effective_from) OVER {order} AS next_from "
                f"FROM {table} WHERE {key} IS NOT NULL")

    def in_force(v: str) -> str:
        return (f"{v}.deleted_flg = 'N' AND ({v}.nth = 1 OR {v}.effective_from <= o.trans_date) "
                f"AND ({v}.next_from IS NULL OR o.trans_date < {v}.next_from)")

    person = "coalesce('P' || {0}.passport, 'N' || coalesce({0}.fio, '') || '|' || coalesce({0}.phone, ''))"
    if which == "2":
        test = "w.at > w.contract_end"
    else:
        test = (f"(coalesce(w.at > w.passport_end, false) OR EXISTS (SELECT 1 FROM {blacklist} b "
                "WHERE b.passport_num = w.passport AND b.entry_dt <= w.at))")
    return f"""
WITH kv AS ({versions(cards, 'card_num')}), av AS ({versions(accounts, 'account_num')}),
hv AS ({versions(clients, 'client_id')}),
w AS (
  SELECT o.trans_date AS at, CAST(o.trans_date AS DATE) AS on_day, a.valid_to AS contract_end,
         h.passport_num AS passport, h.phone, h.passport_valid_to AS passport_end,
         h.last_name || ' ' || h.first_name || ' ' || h.patronymic AS fio
  FROM {ops} o JOIN kv k ON trim(k.card_num) = o.card_num AND {in_force('k')}
  JOIN av a ON a.account_num = k.account_num AND {in_force('a')}
  LEFT JOIN hv h ON h.client_id = a.client AND {in_force('h')})
SELECT on_day AS event_dt, passport, fio, phone FROM w
WHERE {test} AND NOT EXISTS (SELECT 1 FROM {prior} p WHERE {person.format('p')} = {person.format('w')}
  AND p.event_dt = w.on_day AND p.event_type = '{which}')
GROUP BY on_day, passport, fio, phone"""
