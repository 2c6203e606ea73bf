"""Corpus pipeline: quality, line dedup, near-duplicates, decontamination, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run`` writes it as Parquet to the
shared folder and reads it again as the next stage's ``docs``. All stages but the last return the
columns of ``documents``. Clean documents pass every filter.

Defined results: rows with a NULL ``doc_id`` pass on their text alone; rows that repeat a ``doc_id``
are one document, of which one row stays after the near-duplicate stage; an empty table passes through;
extra columns are passed on up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from histwright.llm import line_dedup, packing, quality, superminhash, winnowing
from histwright.llm.common import materialize, ship_package, table

#: Documents below this quality score go.
QUALITY_CUT = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; trained on the labels of ``docs``."""
    ship_package(spark)
    return quality.keep(docs, quality.fit(docs, table(spark, sf_dir, "labels")), QUALITY_CUT)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; ``n_chars`` follows the text.

    Only documents that have no line of their own keep theirs, as copies for the next stage.
    """
    done = line_dedup.remove_boilerplate(docs)
    return (done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*docs.columns))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of smallest id."""
    ship_package(spark)
    kept = superminhash.near_duplicates(docs).where("kept and doc_id is not null").select("doc_id").distinct()
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))
    once = (docs.join(kept, "doc_id", "left_semi").withColumn("__copy", copy).where("__copy = 1")
            .select(*docs.columns))
    return once.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no benchmark span."""
    ship_package(spark)
    found = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    bad = found.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("__id"))
                     & (winnowing.row_key(F.col("text")) == F.col("__key")), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences."""
    ship_package(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_stage), ("line_dedup", line_dedup_stage),
          ("near_duplicates", near_duplicate_stage), ("decontamination", decontamination_stage),
          ("packing", packing_stage)]

#: The classifier, the tokenizer and the packing have no SQL form; each operator's own test compares with a plain version,
#: where there is one, and the pipeline's test only with the operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
