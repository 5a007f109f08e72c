"""Spark session helpers.

The library never creates a cluster session on its own; `local_session` is for
tests and the benchmark.  Nothing in the library checkpoints: lineage ends in
the prepared tables, which lie where the caller puts them.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job in this package relies on: UTC for timestamp -> year,
# AQE for runtime re-planning (partition coalescing, skew-join splitting and
# broadcast conversion driven by measured shuffle sizes).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Runtime SQL settings for a large cluster (opt-in via `configure`): start
# shuffles wide and let AQE coalesce them to ~128 MB partitions, read Parquet
# in 256 MB splits, and split skewed join partitions (a hot author).  Broadcast
# stays at Spark's size-checked default: AQE converts a join to broadcast only
# after measuring the shuffled side.
SCALE_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(256 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
}


def configure(spark: SparkSession, scale: bool = True, override: bool = False) -> dict[str, str]:
    """Apply SESSION_DEFAULTS (and SCALE_DEFAULTS when `scale`) to an existing
    session.  Keys the user set explicitly are kept unless `override`.
    Returns what was set."""
    wanted = dict(SESSION_DEFAULTS)
    if scale:
        wanted.update(SCALE_DEFAULTS)
    applied = {}
    for key, value in wanted.items():
        if (override or spark.conf.get(key, None) is None) and spark.conf.isModifiable(key):
            spark.conf.set(key, value)
            applied[key] = value
    return applied


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "collabstats") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the actions inside the block; the session has its own back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
