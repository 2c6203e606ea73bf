"""Type-1 dimensions: insert staged keys that are not known yet.

The original job never overwrites (``update_dt`` stays NULL, existing rows are
untouched) and leaves some columns unloaded (terminal addresses).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import TS, TYPE1_UNLOADED, DimSpec


def new_rows(dim: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Rows to insert: staged keys absent from ``dim``, shaped like the dimension."""
    skipped = set(TYPE1_UNLOADED.get(spec.name, ()))
    new = stg.join(dim.select(spec.key), spec.key, "left_anti")
    cols = [F.col(spec.key)]
    cols += [F.lit(None).cast(dim.schema[a].dataType).alias(a) if a in skipped else F.col(a)
             for a in spec.attrs]
    cols += [F.col("update_dt").cast(TS).alias("create_dt"), F.lit(None).cast(TS).alias("update_dt")]
    return new.select(*cols)


def insert_new(dim: DataFrame, stg: DataFrame, spec: DimSpec) -> DataFrame:
    """Dimension after inserting staged rows whose key is absent.

    New rows get ``create_dt = staged update_dt`` and ``update_dt = NULL``.
    The key test is an anti join: one shuffle of the staged keys and the
    dimension's key column only.
    """
    return dim.select(*spec.type1_columns).unionByName(new_rows(dim, stg, spec))
