"""Session defaults the transformations rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # One clock everywhere: timestamps are UTC microseconds
    "spark.sql.session.timeZone": "UTC",
    # A bad cast raises instead of turning into null
    "spark.sql.ansi.enabled": "true",
    # Runtime sizes decide broadcast joins, partition counts and skew splits
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = 8, memory: str = "12g", **extra: str) -> SparkSession:
    """A single-JVM session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("inkmeter")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
