"""Text files and corpus folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_texts(spark: SparkSession, folder: str, pattern: str = "*.txt") -> DataFrame:
    """(work_id, content) of the raw files in a folder, named by work."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select(file_stem(F.col("path")).alias("work_id"), "content")


def read_corpus(spark: SparkSession, root: str, self_folder: str) -> DataFrame:
    """(work_id, is_self, text) of every markdown file below a corpus root."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.md")
        .load(root)
    )
    path = F.col("path")
    return files.select(
        source_work_id(path, self_folder).alias("work_id"),
        (parent_folder(path) == self_folder).cast("int").alias("is_self"),
        F.decode("content", "utf-8").alias("text"),
    )


def file_stem(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?\z", 1)


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/[^/]*\z", 1)


def source_work_id(path: Column, self_folder: str) -> Column:
    """File name up to its first '-', or the whole stem in the self folder."""
    name = F.substring_index(F.regexp_extract(path, r"[^/]*\z", 0), "-", 1)
    return F.when(parent_folder(path) == self_folder, file_stem(path)).otherwise(name)


def missing_texts(roster: DataFrame, landed: DataFrame) -> DataFrame:
    """Roster works without a landed file."""
    return roster.join(landed.select("work_id"), "work_id", "left_anti")


def orphan_texts(roster: DataFrame, landed: DataFrame, id_name: str = "catalog_id") -> DataFrame:
    """Landed files, by stem, to delete: numeric names that left the roster."""
    kept = roster.select(F.col(id_name).cast("string").alias("_kept"))
    numeric = landed.filter(F.col("stem").rlike(r"^[0-9]+\z"))
    # '007' names work 7
    as_id = F.coalesce(
        F.nullif(F.regexp_replace("stem", "^0+", ""), F.lit("")), F.lit("0")
    )
    return numeric.join(kept, as_id == F.col("_kept"), "left_anti")
