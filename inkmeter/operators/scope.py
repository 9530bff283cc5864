"""Catalog rows to the roster: scope, genre, one row per work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter.functions import catalog as c


def scoped(catalog: DataFrame) -> DataFrame:
    return catalog.filter(c.in_scope()).withColumn("genre", c.genre())


def keep_first(df: DataFrame, keys: dict, order_by: str) -> DataFrame:  # type: ignore[type-arg]
    """The row of the lowest ``order_by`` per key.

    A minimum over whole rows instead of ``row_number``: it combines map-side,
    so a key that holds a third of the rows reaches the reducer as one row per
    task, where a window would sort that third in a single task.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    return (
        df.groupBy(*[k.alias(f"_key_{n}") for n, k in keys.items()])
        .agg(F.min_by(row, F.col(order_by)).alias("_row"))
        .select("_row.*")
    )


def roster(catalog: DataFrame, id_name: str = "catalog_id") -> DataFrame:
    """In-scope works; re-releases of one title by one author keep the lowest id."""
    return keep_first(
        scoped(catalog), {"title": c.title_key(), "author": c.first_author_key()}, id_name
    )


def dedup_count(catalog: DataFrame) -> DataFrame:
    """One row: works in scope, kept, and dropped as re-releases."""
    groups = (
        scoped(catalog)
        .groupBy(c.title_key().alias("t"), c.first_author_key().alias("a"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("scoped"),
        F.count(F.lit(1)).alias("kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("deduped"),
    )


def genre_census(works: DataFrame) -> DataFrame:
    return works.groupBy("genre").agg(F.count(F.lit(1)).alias("works")).orderBy("genre")
