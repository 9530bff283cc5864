"""Typed one-to-one views over the raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.functions import catalog as c

VALUE_TYPE = "decimal(18,6)"


def stg_works(raw_works: DataFrame) -> DataFrame:
    return raw_works.select(
        F.col("catalog_id").cast("bigint").alias("catalog_id"),
        "title",
        "authors",
        c.primary_author().alias("author_name"),
        c.empty_to_date(F.col("issued")).alias("issued"),
        "subjects",
        "bookshelves",
        "genre",
        c.is_translation().alias("is_translation"),
        c.is_juvenile().alias("is_juvenile"),
        c.is_play().alias("is_play"),
        c.is_poetry().alias("is_poetry"),
        c.birth_year().alias("birth_year"),
        c.death_year().alias("death_year"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
    )


def stg_measurements(raw_measurements: DataFrame) -> DataFrame:
    return raw_measurements.select(
        F.col("work_id").cast("string").alias("work_id"),
        F.col("metric").cast("string").alias("metric_name"),
        F.col("value").cast(VALUE_TYPE).alias("value"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
    )


def stg_vocab(raw_vocab: DataFrame) -> DataFrame:
    return raw_vocab.select(
        F.col("work_id").cast("string").alias("work_id"),
        F.col("term").cast("string").alias("term"),
        F.col("term_count").cast("bigint").alias("term_count"),
        F.col("loaded_at").cast("timestamp").alias("loaded_at"),
    )
