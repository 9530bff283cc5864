"""Data checks: each returns the violating rows, none meaning a pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed


def not_unique(df: DataFrame, *columns: str) -> DataFrame:
    """Non-null keys that occur more than once."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return unique_combination(df.filter(present), *columns)


def unique_combination(df: DataFrame, *columns: str) -> DataFrame:
    """Column combinations that occur more than once."""
    return (
        df.groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .filter(F.col("occurrences") > 1)
    )


def is_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unaccepted_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the list, with how often they occur."""
    return (
        df.filter(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def unrelated(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose key has no parent."""
    keys = parent.select(F.col(parent_column).alias("_parent"))
    return df.filter(F.col(column).isNotNull()).join(
        keys, F.col(column) == F.col("_parent"), "left_anti"
    )


def out_of_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:  # noqa: ANN001
    """Values outside the inclusive range."""
    bad = F.lit(False)
    if low is not None:
        bad = bad | (F.col(column) < low)
    if high is not None:
        bad = bad | (F.col(column) > high)
    return df.filter(bad)


def incomplete_concepts(fact: DataFrame, expected: int = fixed.CONCEPTS_PER_WORK) -> DataFrame:
    """Works that do not carry every metric concept."""
    return (
        fact.groupBy("work_key")
        .agg(F.countDistinct("metric_key").alias("concept_count"))
        .filter(F.col("concept_count") != expected)
    )


def stale_source(
    df: DataFrame, column: str, now: str, hours: int = fixed.FRESHNESS_HOURS
) -> DataFrame:
    """One row with the newest load when it is older than allowed, or missing."""
    newest = df.agg(F.max(column).alias("newest"))
    limit = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {int(hours)} HOURS")
    return newest.filter(F.col("newest").isNull() | (F.col("newest") < limit))


def suite(checks: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(check_name, table_name, violations, status), one row per check.

    ``checks`` maps (check, table) to the check's violating rows.  The checks
    run as one job of counts.
    """
    counts = [
        rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(check).alias("check_name"), F.lit(table).alias("table_name"), "violations"
        )
        for (check, table), rows in checks.items()
    ]
    return reduce(DataFrame.unionByName, counts).withColumn(
        "status", F.when(F.col("violations") == 0, "pass").otherwise("fail")
    )
