"""Session settings the library is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution sizes shuffle partitions and splits skewed ones at run time, so the
# initial number only has to be large enough for the biggest shuffle.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def cluster_session(app: str, shuffle_partitions: int, checkpoint_dir: str) -> SparkSession:
    """A session for large runs; ``checkpoint_dir`` is a folder all executors share."""
    builder = SparkSession.builder.appName(app)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
        .config("spark.checkpoint.dir", checkpoint_dir)
        .getOrCreate()
    )
