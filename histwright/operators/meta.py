"""Load watermarks: one ``max_update_dt`` per staged table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import META_SCHEMA, META_SEED_TABLE, META_SEED_TEXT, TS, META


def seed(spark) -> DataFrame:
    """The meta table as created: one seeded row."""
    return spark.createDataFrame([(META_SCHEMA, META_SEED_TABLE, None)], META).select(
        "schema_name", "table_name", F.lit(META_SEED_TEXT).cast(TS).alias("max_update_dt"))


def update_watermark(meta: DataFrame, stg: DataFrame, table_name: str,
                     schema_name: str = META_SCHEMA, upsert: bool = True) -> DataFrame:
    """Meta after ``max_update_dt = coalesce(max(staged update_dt), max_update_dt)``
    for the row of ``table_name``.

    The staged side is reduced to one row by a global aggregate (partial
    aggregation on every partition); it is then merged with the meta rows by a
    union and a group-by on (schema_name, table_name), so no join is planned.
    With ``upsert`` (default) a missing row is added; without it, as in the
    original job, only an existing row is updated.
    """
    keys = ["schema_name", "table_name"]
    mark = stg.agg(F.max(F.col("update_dt").cast(TS)).alias("_mark")).select(
        F.lit(schema_name).alias("schema_name"), F.lit(table_name).alias("table_name"),
        F.lit(None).cast(TS).alias("_old"), "_mark", F.lit(False).alias("_had"))
    old = meta.select(*keys, F.col("max_update_dt").cast(TS).alias("_old"),
                      F.lit(None).cast(TS).alias("_mark"), F.lit(True).alias("_had"))
    merged = old.unionByName(mark).groupBy(*keys).agg(
        F.coalesce(F.max("_mark"), F.max("_old")).alias("max_update_dt"),
        F.bool_or("_had").alias("_had"))
    keep = F.col("_had") | (F.col("max_update_dt").isNotNull() if upsert else F.lit(False))
    return merged.where(keep).select(*keys, "max_update_dt")
