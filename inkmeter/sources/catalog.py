"""The catalog feed: a CSV of text columns with one strict id."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkmeter.functions.keys import row_hash


def normalize_column(name: str) -> str:
    """'Text#' -> 'text', 'LoCC' -> 'locc'."""
    return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")


def read_catalog(
    spark: SparkSession, path: str, run_ts: str, id_header: str = "text", id_name: str = "catalog_id"
) -> DataFrame:
    """Read, normalise, type, hash and stamp a catalog CSV.

    Only the header line is read ahead.  Quoted fields may span lines, so a
    file is one split: land a large feed as several files.
    """
    options = {"header": True, "multiLine": True, "quote": '"', "escape": '"'}
    names = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = spark.read.schema(schema).options(**options).csv(path)
    return stamp(type_catalog(raw, id_header, id_name), run_ts, id_name)


def type_catalog(raw: DataFrame, id_header: str = "text", id_name: str = "catalog_id") -> DataFrame:
    """Normalised headers; the id must exist and a bad one raises (ANSI cast)."""
    named = raw.toDF(*[normalize_column(c) for c in raw.columns])
    if id_header not in named.columns:
        raise KeyError(f"no {id_header!r} column in the catalog, got {named.columns}")
    return named.withColumnRenamed(id_header, id_name).withColumn(
        id_name, F.col(id_name).cast("bigint")
    )


def stamp(catalog: DataFrame, run_ts: str, id_name: str = "catalog_id") -> DataFrame:
    """Row hash over the feed's own columns, then the load stamps."""
    run = F.lit(run_ts).cast("timestamp")
    return catalog.select(
        "*",
        row_hash(catalog, id_name).alias("catalog_row_hash"),
        F.date_format(run, "yyyy-MM-dd").alias("snapshot_date"),
        run.alias("loaded_at"),
    )
