"""Session defaults for local runs and tests.

On a cluster the session comes from the submitter; these settings only fill
what is unset. AQE re-plans joins from measured sizes (and splits skewed
join partitions); the shuffle partition count is a starting point that AQE
coalesces.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Cluster runs (100 TB of readings and weighbridge rows): large input splits,
# a high initial shuffle partition count that AQE coalesces to ~256 MB per
# partition, skewed join partitions split at runtime, and a broadcast
# threshold that AQE applies to measured shuffle sizes. Applied only where
# the submitter left a setting unset.
CLUSTER_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.filterPushdown": "true",
}


def apply_cluster_defaults(spark: SparkSession) -> None:
    submitted = spark.sparkContext.getConf()
    for k, v in CLUSTER_DEFAULTS.items():
        if not submitted.contains(k):
            spark.conf.set(k, v)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "palmyra", driver_memory: str = "16g") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # Local mode runs every task inside the driver JVM.
            builder = builder.config("spark.driver.memory", driver_memory)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    is_local = (master or spark.sparkContext.master).startswith("local")
    if not is_local:
        apply_cluster_defaults(spark)
    if is_local and not spark.conf.get("spark.checkpoint.dir", None) and \
            spark.sparkContext.getCheckpointDir() is None:
        # Local runs only. On a cluster the shared folder must come from
        # spark.checkpoint.dir; writers.shared_dir fails clearly without it.
        d = tempfile.mkdtemp(prefix="palmyra-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.sparkContext.setCheckpointDir(d)
    return spark
