"""Intermediate tables on the storage that all executors share.

Writing a table and reading it back is what cuts lineage here: a lost
executor costs the retry of its tasks, never of the steps before.
"""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD_BREAK = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@cache
def _own_folder(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"{application_id}-")


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``.

    The cluster names that folder; only where it is unset, as in a test on one
    machine, the session gets a temporary folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or _own_folder(
        spark.sparkContext.applicationId
    )
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stage(df: DataFrame) -> DataFrame:
    """Write the rows once and return a reader of them."""
    folder = shared_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text):  # noqa: ANN001, ANN201
    """The text with A-Z, and nothing else, lower-cased; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def numbered(df: DataFrame, *order) -> DataFrame:  # noqa: ANN002
    """The rows with their 1-based rank in a global order, as ``position``.

    Rows are dealt by range and written, so that a partition keeps its number;
    partitions are counted, and each row's rank is its rank in the partition
    plus the rows before it.  What the driver sees is one count per partition.
    Equal rows of the order get neighbouring ranks in either order.
    """
    from pyspark.sql import Window

    parts = stage(
        df.repartitionByRange(*order).withColumn("range_part", F.spark_partition_id())
    )
    counts = sorted(
        (r["range_part"], r["count"]) for r in parts.groupBy("range_part").count().collect()
    )
    before, offsets = 0, [(-1, 0)]
    for part, count in counts:
        offsets.append((part, before))
        before += count
    spark = df.sparkSession
    starts = spark.createDataFrame(offsets, "range_part int, range_start long")
    ranks = Window.partitionBy("range_part").orderBy(*order)
    return (
        parts.join(F.broadcast(starts), "range_part")
        .withColumn("position", F.row_number().over(ranks) + F.col("range_start"))
        .drop("range_part", "range_start")
    )
