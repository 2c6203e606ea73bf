"""Shared helpers: the cluster's shared folder, stage outputs, held-out rows."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share (``spark.checkpoint.dir``).

    Only a local session without the setting gets a scratch folder of its own;
    a cluster session without it is an error, as a driver-local folder would
    be lost with the driver and unseen by the executors.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="histwright-llm-")
        spark.conf.set(CHECKPOINT_DIR, path)
    return path.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers once per context, through Spark's own file server.

    Needed where the workers can't import it already (``--py-files`` or an installed package).
    """
    sc = spark.sparkContext
    if getattr(sc, "_histwright_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="histwright-zip-"), "histwright_pkg.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
    sc.addPyFile(archive)
    sc._histwright_shipped = True


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written.

    Cuts the lineage without recomputing anything (a Dataset checkpoint runs
    its last stage twice) and survives lost executors. The files stay there
    for the lifetime the cluster gives its checkpoint folder.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """Rows never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int,
                    max_chars: int) -> list[tuple[str, int]]:
    """At most ``rows`` labelled (text, label) pairs that are not held out.

    The bound is on the labelled rows only: the ``rows`` smallest hashes of the
    document id, so the sample is the same on every run and does not depend on
    partitioning. Documents longer than ``max_chars`` are not drawn, which
    bounds the sample's size by ``rows * max_chars`` characters. The drawn ids
    (a bounded table) are broadcast to one scan of the documents. The order of
    the returned list is fixed.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit(7))
    drawn = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("y").alias("y"))
             .orderBy(key, "doc_id").limit(rows))
    got = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
           .where((F.octet_length("text") <= 4 * max_chars) & (F.length("text") <= max_chars))
           .join(F.broadcast(drawn), "doc_id")
           .select("doc_id", "text", "y").toArrow().to_pylist())
    got.sort(key=lambda r: (r["doc_id"], r["text"], r["y"]))
    return [(r["text"], r["y"]) for r in got]
