"""Spark session defaults for the clip store.

The same settings are meant for a large cluster; only ``master`` and the
shuffle partition count change between a laptop and a 1000-executor job.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# Settings every job relies on: UTC timestamps, ANSI arithmetic (errors are
# bugs, zero-safe ratios are written explicitly), AQE for runtime re-planning,
# skew-join splitting and partition coalescing.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # merged and split parts of a shuffle: sorted rows take ten to fifteen times their
    # bytes in the shuffle, so a task sorts some 200 MB and spills nothing
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(16 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # files up to 128 MB per scan split; at 100 TB that is ~800k tasks over
    # the whole store, each comfortably inside executor memory.
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    # stored layers are read a few times and lie on disk until the job ends
    "spark.sql.parquet.compression.codec": "zstd",
    # what a job has shuffled goes when it ends, not when the driver happens to collect its garbage
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "reelmart", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the store's defaults."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    if master:
        builder = builder.master(master)
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    memory = os.environ.get("REELMART_DRIVER_MEMORY")
    if memory or (master or "").startswith("local"):  # one JVM does all the work
        builder = builder.config("spark.driver.memory", memory or "8g")
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply runtime-settable SQL options to a session someone else built."""
    for key, value in CORE_CONF.items():
        if key.startswith("spark.sql.") and key not in (
            "spark.sql.execution.arrow.pyspark.enabled",
        ):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf in a foreign session: leave it
                pass
