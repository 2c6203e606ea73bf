"""Schema registry: staged inputs, dimensions, facts, reports, meta.

All times are ``TIMESTAMP_NTZ`` (the warehouse stores zone-less second
resolution timestamps); literals are always built from text so that results
never depend on the session time zone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

S = T.StringType()
D = T.DateType()
TS = T.TimestampNTZType()

# Fixed values of the warehouse model.
OPEN_END_TEXT = "9999-12-31 00:00:00"  # open end of a validity interval
FLAG_LIVE = "N"                        # deleted_flg of a live version
FLAG_DELETED = "Y"                     # deleted_flg of a tombstone
EVENT_PASSPORT = "1"                   # type-2 report: expired or blacklisted passport
EVENT_CONTRACT = "2"                   # type-2 report: expired contract
REASON_PASSPORT = "passport_expired"   # type-1 report reasons
REASON_CONTRACT = "contract_expired"
META_SCHEMA = "dwh"                    # schema_name of the meta rows
META_SEED_TABLE = "first_etl"          # table_name of the seeded meta row
META_SEED_TEXT = "1900-01-01 00:00:00"


def ts_lit(text: str) -> Column:
    """A ``TIMESTAMP_NTZ`` literal from ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.lit(text).cast(TS)


def open_end() -> Column:
    return ts_lit(OPEN_END_TEXT)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


@dataclass(frozen=True)
class DimSpec:
    """A dimension: business key, compared attributes and their types."""

    name: str
    key: str
    attrs: tuple[str, ...]
    types: tuple[T.DataType, ...]

    @property
    def columns(self) -> list[str]:
        return [self.key, *self.attrs]

    @property
    def snapshot_schema(self) -> T.StructType:
        """Staged snapshot: key, attributes, ``update_dt``."""
        return _struct((self.key, S), *zip(self.attrs, self.types), ("update_dt", TS))

    @property
    def history_schema(self) -> T.StructType:
        """Type-2 history: key, attributes, validity interval, delete flag."""
        return _struct((self.key, S), *zip(self.attrs, self.types),
                       ("effective_from", TS), ("effective_to", TS), ("deleted_flg", S))

    @property
    def type1_schema(self) -> T.StructType:
        """Type-1 dimension: key, attributes, ``create_dt``, ``update_dt``."""
        return _struct((self.key, S), *zip(self.attrs, self.types),
                       ("create_dt", TS), ("update_dt", TS))

    @property
    def quarantine_schema(self) -> T.StructType:
        """Staged rows whose key is NULL: all attributes and the load stamp."""
        return self.snapshot_schema

    @property
    def history_columns(self) -> list[str]:
        return [*self.columns, "effective_from", "effective_to", "deleted_flg"]

    @property
    def type1_columns(self) -> list[str]:
        return [*self.columns, "create_dt", "update_dt"]


TERMINALS = DimSpec("terminals", "terminal_id",
                    ("terminal_type", "terminal_city", "terminal_address"), (S, S, S))
CARDS = DimSpec("cards", "card_num", ("account_num",), (S,))
ACCOUNTS = DimSpec("accounts", "account_num", ("valid_to", "client"), (D, S))
CLIENTS = DimSpec("clients", "client_id",
                  ("last_name", "first_name", "patronymic", "date_of_birth",
                   "passport_num", "passport_valid_to", "phone"),
                  (S, S, S, D, S, D, S))

DIMS: dict[str, DimSpec] = {d.name: d for d in (TERMINALS, CARDS, ACCOUNTS, CLIENTS)}

# Type-1 terminals never receive an address (the loader leaves it out).
TYPE1_UNLOADED = {"terminals": ("terminal_address",)}

# Column order of the drops, by position; header names in the files are ignored.
TRANSACTIONS_FILE_ORDER = ("trans_id", "trans_date", "amt", "card_num",
                           "oper_type", "oper_result", "terminal")
TERMINALS_FILE_ORDER = ("terminal_id", "terminal_type", "terminal_city", "terminal_address")
BLACKLIST_FILE_ORDER = ("entry_dt", "passport_num")

TRANSACTIONS = _struct(("trans_id", T.LongType()), ("trans_date", TS), ("card_num", S),
                       ("oper_type", S), ("amt", S), ("oper_result", S), ("terminal", S))
TRANSACTIONS_TYPE1 = _struct(("transactions_id", T.LongType()), ("transactions_date", D),
                             ("card_num", S), ("oper_type", S),
                             ("amount", T.DecimalType(12, 2)), ("oper_result", S),
                             ("terminal", S))
BLACKLIST = _struct(("entry_dt", TS), ("passport_num", S))
REPORT = _struct(("event_dt", D), ("passport", S), ("fio", S), ("phone", S),
                 ("event_type", S), ("report_dt", TS))
REPORT_TYPE1 = _struct(("client_id", S), ("blcklst_reason", S), ("report_dt", TS))
META = _struct(("schema_name", S), ("table_name", S), ("max_update_dt", TS))
CARD_DAY_STATS = _struct(("card_num", S), ("event_dt", D), ("max_ts", TS), ("max_late_ts", TS),
                         ("has_midnight", T.BooleanType()))

#: What the reports test of a card and a person, as of the run that wrote it; a card's rows of its latest run hold.
CARD_PROFILE = _struct(("card_num", S), ("passport", S), ("fio", S), ("phone", S), ("known", T.BooleanType()),
                       ("_vt", TS), ("_ct", TS), ("_entry", TS), ("run_ts", TS))

LEDGER = _struct(("run_id", S), ("file", S))

TABLES: dict[str, T.StructType] = {
    "fact_transactions": TRANSACTIONS,
    "fact_transactions_type1": TRANSACTIONS_TYPE1,
    "fact_passport_blacklist": BLACKLIST,
    "rep_fraud": REPORT,
    "rep_fraud_type1": REPORT_TYPE1,
    "meta": META,
    "fact_card_day_stats": CARD_DAY_STATS,
    "card_profile": CARD_PROFILE,
    **{f"dim_{d.name}_hist": d.history_schema for d in DIMS.values()},
    **{f"dim_{d.name}": d.type1_schema for d in DIMS.values()},
    # Staged rows without a key, which no dimension can hold.
    **{f"quarantine_{d.name}": d.quarantine_schema for d in DIMS.values()},
}


#: Hash buckets of the cards in the reports' kept state.
STATE_BUCKETS = 16


def card_bucket(card: str = "card_num") -> Column:
    return F.pmod(F.xxhash64(card), F.lit(STATE_BUCKETS)).cast("int")


def event_year(day: str = "event_dt") -> Column:
    return F.year(day).cast("int")


# Tables stored in folders by a column derived from their rows, so a run reads the folders it needs.
PARTITIONED = {"fact_card_day_stats": ("bucket", card_bucket), "card_profile": ("bucket", card_bucket),
               "rep_fraud": ("event_year", event_year)}


def empty(spark, schema: T.StructType):
    """An empty frame of ``schema`` (first run of a table).

    Built as a projection under ``WHERE false`` so Catalyst knows it is empty and
    drops joins and unions against it (a first load is a plain projection).
    """
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return spark.range(1).select(*cols).where(F.lit(False))
