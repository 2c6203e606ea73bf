"""Session helpers.

Library code never creates or reconfigures a session; these helpers are for
tests, the bench and command-line jobs.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every job of this package is written against.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on sizes measured at run time (AQE, after the shuffle map
    # stage), never on the planner's estimate from compressed file sizes.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
    "spark.ui.enabled": "false",
}


def cluster_conf(total_cores: int, largest_shuffle_bytes: int,
                 target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, sized so shuffle partitions fit executor memory.

    ``largest_shuffle_bytes`` is the biggest expected shuffle (for the daily run:
    the transaction fact's (card, day) statistics, or the open versions of the
    largest dimension). Partitions start at the larger of ``2 x cores`` and
    ``shuffle / target`` and AQE coalesces them to the target size at run time;
    partitions of a hot key above twice the target are split.
    """
    n = max(2 * total_cores, -(-largest_shuffle_bytes // target_partition_bytes))
    return {
        **RECOMMENDED_CONF,
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "histwright", extra: dict | None = None) -> SparkSession:
    """A local session for tests and benches (never used by library code)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is used as is. Where it is unset, ``fallback`` is set or, in a local session
    only, a fresh scratch folder; a cluster session needs one of the two, as a
    folder on the driver's machine would be lost with it and unseen by the executors.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        if not fallback and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        current = fallback or tempfile.mkdtemp(prefix="histwright-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
