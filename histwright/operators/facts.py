"""Fact tables: append-only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_all(fact: DataFrame, stg: DataFrame) -> DataFrame:
    """Fact after appending every staged row (no duplicate check), by column position.

    A staging frame of another width is an error, as it is for an insert by position.
    """
    if len(stg.columns) != len(fact.columns):
        raise ValueError(f"{len(stg.columns)} staged columns do not fit {len(fact.columns)}: "
                         f"{stg.columns} into {fact.columns}")
    return fact.union(stg.toDF(*fact.columns))


def new_rows(fact: DataFrame, stg: DataFrame, key: str, dedupe_batch: bool = False,
             bound_by_range: bool = True, eager_bounds: bool = False) -> DataFrame:
    """Staged rows whose ``key`` is not in the fact yet.

    Duplicate ids inside one batch all pass unless ``dedupe_batch``. Only the
    fact's key column is read; with ``bound_by_range`` (exact: an id outside
    the batch's [min, max] cannot match) it is filtered before the shuffle, so
    a daily batch shuffles the fact ids of its own id range, not the whole fact.
    The bounds are scalar subqueries (lazy); with ``eager_bounds`` they are
    computed first (two numbers reach the driver) and become literal filters
    that Parquet pushes down: files and row groups whose id statistics lie
    outside the range are not read at all.
    """
    ids = fact.select(key)
    if bound_by_range:
        k = F.col(key)
        if eager_bounds:
            b = stg.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
            if b.lo is None:  # no staged ids: nothing can match
                ids = ids.where(F.lit(False))
            else:
                ids = ids.where((k >= F.lit(b.lo)) & (k <= F.lit(b.hi)))
        else:
            lo = stg.select(F.min(key)).scalar()
            hi = stg.select(F.max(key)).scalar()
            ids = ids.where((k >= lo) & (k <= hi))
    rows = stg.join(ids, key, "left_anti")
    if dedupe_batch:
        rows = rows.dropDuplicates([key])
    return rows


def append_new(fact: DataFrame, stg: DataFrame, key: str, dedupe_batch: bool = False) -> DataFrame:
    """Fact after appending the staged rows with new ids."""
    return fact.unionByName(new_rows(fact, stg.select(*fact.columns), key, dedupe_batch))
