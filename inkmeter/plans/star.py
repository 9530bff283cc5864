"""Conformed dimensions and facts.

The metric dimension is a fixed handful of rows and is broadcast by hint.
Works and authors grow with the corpus: their joins carry no hint, so
adaptive execution broadcasts a side only when its measured size allows and
otherwise shuffles, splitting a skewed author's partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.functions import catalog as c
from inkmeter.functions.keys import surrogate_key


def dim_metric(concepts: DataFrame) -> DataFrame:
    return concepts.select(
        surrogate_key("metric_name").alias("metric_key"), *fixed.METRIC_COLUMNS
    )


def dim_author(works: DataFrame, manual_works: DataFrame) -> DataFrame:
    """Catalog primary authors, then manually loaded ones off the lookup."""
    catalog_authors = (
        works.groupBy("author_name")
        .agg(F.max("birth_year").alias("birth_year"), F.max("death_year").alias("death_year"))
        .select(
            surrogate_key("author_name").alias("author_key"),
            F.col("author_name").alias("name"),
            c.january_first(F.col("birth_year")).alias("birth_date"),
            c.january_first(F.col("death_year")).alias("death_date"),
            F.lit(0).alias("is_self"),
        )
    )
    manual = (
        manual_works.select("author", "is_self")
        .distinct()
        .select(
            surrogate_key("author").alias("author_key"),
            F.col("author").alias("name"),
            F.lit(None).cast("date").alias("birth_date"),
            F.lit(None).cast("date").alias("death_date"),
            "is_self",
        )
    )
    return catalog_authors.unionByName(manual)


def dim_work(works: DataFrame, manual_works: DataFrame, measurements: DataFrame) -> DataFrame:
    """Measured works: catalog and manual ones, with their size and load time."""
    flags = ("is_translation", "is_juvenile", "is_play", "is_poetry")
    listed = works.select(
        F.col("catalog_id").cast("string").alias("work_id"),
        "title",
        "author_name",
        "genre",
        *flags,
        F.col("issued").alias("issue_date"),
    ).unionByName(
        manual_works.select(
            "work_id",
            "title",
            F.col("author").alias("author_name"),
            F.lit("Undetermined").alias("genre"),
            *[F.lit(0).alias(f) for f in flags],
            F.lit(None).cast("date").alias("issue_date"),
        )
    )
    measured = (
        measurements.filter(F.col("metric_name") == "word_count")
        .groupBy("work_id")
        .agg(
            F.max("value").cast("bigint").alias("word_count"),
            F.min("loaded_at").alias("ingested_at"),
        )
    )
    return listed.join(measured, "work_id").select(
        surrogate_key("work_id").alias("work_key"),
        surrogate_key("author_name").alias("author_key"),
        "work_id",
        "title",
        "genre",
        *flags,
        "word_count",
        c.prose_type(F.col("word_count")).alias("prose_type"),
        "issue_date",
        "ingested_at",
    )


def dim_date(
    spark: SparkSession,
    start: str = fixed.CALENDAR_START,
    end: str = fixed.CALENDAR_END,
) -> DataFrame:
    """One row per day, both ends included."""
    days = F.explode(
        F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("INTERVAL 1 DAY"))
    )
    return describe_days(spark.range(1).select(days.alias("date_day")))


def describe_days(days: DataFrame) -> DataFrame:
    """Calendar attributes of a ``date_day`` column; weeks start on Sunday as 0."""
    day = F.col("date_day")
    weekday = F.dayofweek(day) - 1
    return days.select(
        surrogate_key("date_day").alias("date_key"),
        "date_day",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        weekday.isin(0, 6).cast("int").alias("is_weekend"),
    )


def normalized_measurements(measurements: DataFrame, metrics: DataFrame) -> DataFrame:
    """Style series with their concept's key.

    A left join: a series without a concept keeps a null key for the not-null
    check to find.
    """
    concepts = metrics.select("metric_key", F.col("metric_name").alias("_concept"))
    return (
        measurements.filter(F.col("metric_name") != "word_count")
        .join(concepts, c.concept_of(F.col("metric_name")) == F.col("_concept"), "left")
        .select("work_id", "metric_key", "metric_name", "value", "loaded_at")
    )


def fact_style_measurement(normalized: DataFrame, works: DataFrame) -> DataFrame:
    """One row per measured work and style series."""
    loaded_date = F.col("loaded_at").cast("date")
    return normalized.join(works.select("work_id", "work_key", "author_key"), "work_id").select(
        surrogate_key("work_id", "metric_name").alias("measurement_key"),
        "work_key",
        "author_key",
        "metric_key",
        "metric_name",
        surrogate_key(loaded_date).alias("loaded_date_key"),
        loaded_date.alias("loaded_date"),
        "value",
    )


def author_vocabulary(vocab: DataFrame, works: DataFrame, authors: DataFrame) -> DataFrame:
    """(author_key, is_self, term, loaded_at): distinct terms, freshest load.

    Works and authors are joined first, at work grain, so the vocabulary is
    joined once and a prolific author never gathers on one task: the terms are
    deduplicated map-side and spread by (author, term).
    """
    owned = works.select("work_id", "author_key").join(
        authors.select("author_key", "is_self"), "author_key"
    )
    return (
        vocab.join(owned, "work_id")
        .groupBy("author_key", "is_self", "term")
        .agg(F.max("loaded_at").alias("loaded_at"))
    )


def vocab_jaccard(author_terms: DataFrame) -> DataFrame:
    """Vocabulary overlap of every other author with the self author.

    ``author_terms`` is read twice; hand over a written table at scale.
    """
    mine = author_terms.filter("is_self = 1").select("term")
    theirs = author_terms.filter("is_self = 0")
    my_size = mine.agg(F.count(F.lit(1)).alias("my_vocab_size")).scalar()
    in_mine = mine.distinct().withColumn("_shared", F.lit(1))
    shared = F.col("shared_terms")
    union_size = F.col("my_vocab_size") + F.col("their_vocab_size") - shared
    # One pass gives sizes, overlap and freshness; an author sharing nothing stays
    return (
        theirs.join(in_mine, "term", "left")
        .groupBy("author_key")
        .agg(
            F.count(F.lit(1)).alias("their_vocab_size"),
            F.count("_shared").alias("shared_terms"),
            F.max("loaded_at").alias("loaded_at"),
        )
        .withColumn("my_vocab_size", my_size)
        .select(
            "author_key",
            "my_vocab_size",
            "their_vocab_size",
            "loaded_at",
            "shared_terms",
            (shared.cast("double") / union_size.cast("double")).alias("jaccard"),
        )
    )


def fact_vocab_overlap(overlap: DataFrame, authors: DataFrame) -> DataFrame:
    """One row per (self author, other author).

    There is one self author by definition; several yield a row each, which the
    uniqueness check of the other author reports.  Without one there is no overlap.
    """
    selves = authors.select(F.col("author_key").alias("author_key_a"), F.col("is_self").alias("_self"))
    loaded_date = F.col("loaded_at").cast("date")
    # The self authors, a handful, meet every row of the overlap by their mark
    paired = overlap.withColumn("_self", F.lit(1)).join(selves.filter("_self = 1"), "_self")
    return paired.select(
        surrogate_key("author_key_a", "author_key").alias("overlap_key"),
        "author_key_a",
        F.col("author_key").alias("author_key_b"),
        surrogate_key(loaded_date).alias("loaded_date_key"),
        loaded_date.alias("loaded_date"),
        "my_vocab_size",
        "their_vocab_size",
        "shared_terms",
        "jaccard",
    )
