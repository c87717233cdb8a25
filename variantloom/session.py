"""Session settings the engine is designed for, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
from functools import lru_cache

from pyspark.sql import SparkSession

# Everything here is a standard Spark SQL option; on a cluster they belong in the job's own configuration.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join side even when that costs one more exchange
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(master: str | None = None, shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the engine's settings.

    Leave ``shuffle_partitions`` unset on a cluster: set it there to about 128 MB of shuffle data
    per partition and let adaptive execution coalesce."""
    builder = SparkSession.builder.appName("variantloom")
    if master:
        builder = builder.master(master)
    options = dict(SETTINGS)
    if shuffle_partitions:
        options["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    options.update(extra)
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_folder() -> tempfile.TemporaryDirectory:
    """One folder for the process, removed when it ends."""
    return tempfile.TemporaryDirectory(prefix="variantloom-", ignore_cleanup_errors=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only a local session without that setting
    gets a temporary folder, one for the process."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a shared folder")
    return _local_folder().name
