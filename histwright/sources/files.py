"""File and table sources for the daily drops and the operational snapshots."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timefn import file_date


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(spark: SparkSession, path, columns, sep: str = ";",
                   header: bool = True, with_file_date: bool = False) -> DataFrame:
    """Delimited drop(s): columns by position as text; a header line is skipped, not used.

    ``path`` may be a file, a folder or a glob; files are split and read in
    parallel. ``with_file_date`` adds ``file_date`` from the ``_DDMMYYYY`` file name.
    """
    df = (spark.read.schema(text_schema(columns)).option("sep", sep)
          .option("header", header).option("enforceSchema", True).option("mode", "FAILFAST")
          .csv(path))
    if with_file_date:
        df = df.withColumn("file_date", file_date())
    return df


def read_workbook_sheet(spark: SparkSession, path, sheet: str, columns,
                        decoder: Callable[[bytes, str], pd.DataFrame] | None = None,
                        with_file_date: bool = False) -> DataFrame:
    """One sheet of each workbook under ``path``, columns by position as text.

    Workbooks are read as binary files (one row per file, so files spread over
    tasks) and decoded in ``mapInPandas``. ``decoder(content, sheet)`` returns a
    pandas frame; the default uses ``pandas.read_excel`` and needs an Excel
    engine installed on the executors.
    """
    names = list(columns)
    decode = decoder or _read_excel

    def parse(batches):
        for pdf in batches:
            for content, name in zip(pdf["content"], pdf["path"]):
                sheet_df = decode(bytes(content), sheet)
                if sheet_df.shape[1] != len(names):
                    raise ValueError(f"{name}: sheet {sheet} has {sheet_df.shape[1]} columns, "
                                     f"expected {len(names)}")
                out = sheet_df.astype(object)
                out.columns = names
                out = out.where(out.notna(), None).map(lambda v: None if v is None else str(v))
                out["_file"] = name
                yield out

    schema = text_schema([*names, "_file"])
    df = spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(
        parse, schema)
    if with_file_date:
        df = df.withColumn("file_date", file_date(F.col("_file")))
    return df.drop("_file")


def _read_excel(content: bytes, sheet: str) -> pd.DataFrame:
    import io
    return pd.read_excel(io.BytesIO(content), sheet_name=sheet, header=0, dtype=object)


def read_source_table(spark: SparkSession, source, columns, rename: dict | None = None,
                      jdbc: dict | None = None) -> DataFrame:
    """An operational table: a ``DataFrame``, a catalog table name, or JDBC options.

    For JDBC pass ``url``, ``dbtable`` and, for a parallel read,
    ``partitionColumn``, ``lowerBound``, ``upperBound``, ``numPartitions``;
    credentials come from the caller. Only ``columns`` are read (pruned at the source).
    """
    if jdbc is not None:
        df = spark.read.format("jdbc").options(**jdbc).load()
    elif isinstance(source, DataFrame):
        df = source
    else:
        df = spark.table(source)
    df = df.select(*columns)
    for old, new in (rename or {}).items():
        df = df.withColumnRenamed(old, new)
    return df
