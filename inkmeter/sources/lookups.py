"""Lookup tables: metric concepts, manual works, the manual manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed

METRIC_SCHEMA = (
    "metric_name string, display_name string, category string, unit string, "
    "higher_means string, description string, formula string, "
    "is_multivalue boolean, additivity string"
)
MANUAL_WORKS_SCHEMA = (
    "work_id string, title string, author string, tradition string, era string, "
    "is_self int, path string, loaded_at timestamp"
)


def metric_concepts(spark: SparkSession) -> DataFrame:
    """The metric concepts, a fixed handful of rows."""
    return spark.createDataFrame(list(fixed.METRIC_ROWS), METRIC_SCHEMA)


def read_lookup(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A lookup CSV with a declared schema."""
    return spark.read.csv(path, header=True, schema=schema, escape='"')


def read_manual_works(spark: SparkSession, path: str) -> DataFrame:
    return read_lookup(spark, path, MANUAL_WORKS_SCHEMA)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(work_id, loaded_at) of manually landed works; the stamps are UTC."""
    raw = spark.read.csv(path, header=True, escape='"')
    stamp = F.concat("loaded_at", F.lit(" +0000"))
    return raw.select(
        "work_id", F.to_timestamp(stamp, "yyyy-MM-dd HH:mm:ss Z").alias("loaded_at")
    )
