"""Serving marts: z-scores, distinctiveness, author rollups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.functions import catalog as c


def standardised(value: Column, mean: Column, spread: Column) -> Column:
    """Null where the series does not vary."""
    return (value - mean) / F.nullif(spread, F.lit(0.0))


def zscore(df: DataFrame, value: str, series: str, into: str = "zscore") -> DataFrame:
    """Adds how many population stdevs a value sits from its series' mean.

    Aggregates per series (map-side, one row per series and task) and joins
    the statistics back; at run time their size decides how.
    """
    x = F.col(value).cast("double")
    stats = df.groupBy(F.col(series).alias("_series")).agg(
        F.avg(x).alias("_mean"), F.stddev_pop(x).alias("_spread")
    )
    return (
        df.join(stats, F.col(series).eqNullSafe(F.col("_series")), "left")
        .withColumn(into, standardised(x, F.col("_mean"), F.col("_spread")))
        .drop("_series", "_mean", "_spread")
    )


def zscore_window(value: str, series: str) -> Column:
    """The same as a window expression: one sort per series."""
    x, whole = F.col(value).cast("double"), Window.partitionBy(series)
    return standardised(x, F.avg(x).over(whole), F.stddev_pop(x).over(whole))


def mart_style_long(
    fact: DataFrame, works: DataFrame, authors: DataFrame, metrics: DataFrame
) -> DataFrame:
    """One row per work and style series, with labels and z-score.

    Authors are joined to works first, so the long fact is joined once by
    work, a key with a bounded number of rows.
    """
    names = authors.select("author_key", F.col("name").alias("author"))
    owned = works.select("work_key", "work_id", "author_key").join(names, "author_key")
    concepts = metrics.select(
        "metric_key",
        F.col("metric_name").alias("concept_name"),
        "display_name",
        "category",
        "is_multivalue",
    )
    # A fact's author is its work's author, so the work key alone relates them
    joined = (
        fact.drop("author_key")
        .join(concepts, "metric_key")
        .join(owned, "work_key")
    )
    scored = zscore(joined, "value", "metric_name")
    return scored.select(
        "work_key",
        "work_id",
        "author_key",
        "author",
        "metric_key",
        "metric_name",
        "concept_name",
        "display_name",
        "category",
        "is_multivalue",
        c.series_label(F.col("metric_name"), F.col("concept_name")).alias("series_label"),
        "value",
        "zscore",
        "loaded_date",
    )


def excess_index(style: DataFrame, beyond: float = fixed.Z_EXCESS_BEYOND) -> DataFrame:
    """Summed z-score mass beyond the threshold, and series measured, per work."""
    size = F.abs("zscore")
    return style.groupBy("work_key").agg(
        F.sum(F.when(size > beyond, size - beyond).otherwise(F.lit(0.0))).alias("excess"),
        F.count(F.lit(1)).alias("series_measured"),
    )


def mart_work(works: DataFrame, authors: DataFrame, style: DataFrame) -> DataFrame:
    names = authors.select("author_key", F.col("name").alias("author"), "is_self")
    return (
        works.join(excess_index(style), "work_key")
        .join(names, "author_key")
        .select(
            "work_key",
            "work_id",
            "title",
            "genre",
            "prose_type",
            "word_count",
            "is_translation",
            "is_juvenile",
            "is_play",
            "is_poetry",
            "issue_date",
            "ingested_at",
            "author_key",
            "author",
            "is_self",
            "excess",
            "series_measured",
        )
    )


def mart_author(mart_works: DataFrame, authors: DataFrame) -> DataFrame:
    """Corpus rollups per author: summed first, then joined once per author."""
    totals = mart_works.groupBy("author_key", "author", "is_self").agg(
        F.count(F.lit(1)).alias("works"), F.sum("word_count").alias("total_words")
    )
    dates = authors.select("author_key", "birth_date", "death_date")
    return totals.join(dates, "author_key").select(
        "author_key", "author", "is_self", "birth_date", "death_date", "works", "total_words"
    )
