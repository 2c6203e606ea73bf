"""Change detection between a staged row and a stored version."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TECHNICAL_COLUMNS = ("update_dt", "create_dt", "effective_from", "effective_to", "deleted_flg")


def row_changed(columns, left: str | None = None, right: str | None = None,
                left_cols=None, right_cols=None) -> Column:
    """True when any of ``columns`` differs, NULL-safe (NULL vs value counts as a change).

    Either give qualifiers (``left.c`` / ``right.c``) or explicit column lists.
    Written as ``NOT (a <=> b)`` rather than the three-way ``a <> b OR a IS NULL ...``
    form, which Catalyst does not simplify.
    """
    cols = list(columns)
    if not cols:
        return F.lit(False)
    lc = left_cols or [F.col(f"{left}.{c}") if left else F.col(c) for c in cols]
    rc = right_cols or [F.col(f"{right}.{c}") if right else F.col(c) for c in cols]
    return reduce(or_, [~a.eqNullSafe(b) for a, b in zip(lc, rc)])


def compared_columns(df: DataFrame, exclude=()) -> list[str]:
    """Columns of ``df`` that take part in change detection."""
    skip = set(exclude) | set(TECHNICAL_COLUMNS)
    return [c for c in df.columns if c not in skip]


def change_predicate_text(df: DataFrame, exclude=(), left: str = "stg",
                          right: str = "tgt") -> DataFrame:
    """One text row per column of ``df``: the SQL change test for that column.

    Reads the catalog-like schema of ``df`` (no data is touched) and yields a
    one-column frame ``predicate``; joined with `` or `` the rows make the
    change predicate a hand-written job would paste into its SQL.
    """
    spark = df.sparkSession
    names = [(c,) for c in df.columns if c not in set(exclude)]
    cols = spark.createDataFrame(names, "column_name string")
    c = F.col("column_name")
    text = F.concat(F.lit(f"{left}."), c, F.lit(f" IS DISTINCT FROM {right}."), c)
    return cols.select(text.alias("predicate"))
