"""Statistics of series, kept between runs: counts, means and squared deviations.

A kept table has one row per series.  A run that replaces some works takes
their old values' moments away and adds the new ones', so it reads the changed
rows and not the fact.  Taking away loses digits where little is left of a
series (an outlier goes, most rows go); such series, and only they, are counted
again from the values that stay.

Null values count for nothing, as in the standard aggregates; a null series is
a series like others.  A series of which nothing is left has no row, and a
value whose series has no row, or does not vary, has no z-score.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter.plans.marts import standardised

#: Share of a sum below which what is left of it has lost too many digits
LOST = 1e-5
#: The same for a mean, in units of the spread
BLUR = 1e-9
_EPSILON = 2.0**-52
_KEPT = ("n", "mean", "squares")


def moments(df: DataFrame, value: str, series: str) -> DataFrame:
    """series, n, mean, squares (summed squared deviations) of the rows of ``df``."""
    x = F.col(value).cast("double")
    return (
        df.groupBy(F.col(series).alias("series"))
        .agg(
            F.count(x).alias("n"),
            F.avg(x).alias("mean"),
            (F.var_pop(x) * F.count(x)).alias("squares"),
        )
        .where("n > 0")
    )


def _sides(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    a = left.select(F.col("series").alias("a"), *[F.col(c).alias(f"a_{c}") for c in _KEPT])
    b = right.select(F.col("series").alias("b"), *[F.col(c).alias(f"b_{c}") for c in _KEPT])
    none = {f"{side}_{c}": F.coalesce(f"{side}_{c}", F.lit(0)) for side in "ab" for c in _KEPT}
    both = a.join(b, F.col("a").eqNullSafe(F.col("b")), how)
    return both.withColumns({"series": F.coalesce("a", "b"), **none})


def added(left: DataFrame, right: DataFrame) -> DataFrame:
    """The moments of the rows of both."""
    a_n, b_n, apart = F.col("a_n"), F.col("b_n"), F.col("b_mean") - F.col("a_mean")
    n = a_n + b_n
    return _sides(left, right, "full").select(
        "series",
        n.alias("n"),
        (F.col("a_mean") + apart * (b_n / n)).alias("mean"),
        (F.col("a_squares") + F.col("b_squares") + apart * apart * (a_n / n * b_n)).alias(
            "squares"
        ),
    )


def taken_away(whole: DataFrame, part: DataFrame) -> DataFrame:
    """The moments of the rows of ``whole`` that are not in ``part``, and whether they are ``blurred``."""
    a_n, b_n = F.col("a_n"), F.col("b_n")
    less = _sides(whole, part, "left").withColumn("n", a_n - b_n).where("n > 0")
    less = less.withColumn(
        "mean",
        F.when(b_n > 0, F.col("a_mean") + (F.col("a_mean") - F.col("b_mean")) * (b_n / F.col("n")))
        .otherwise(F.col("a_mean")),
    )
    apart = F.col("b_mean") - F.col("mean")
    taken = F.col("b_squares") + apart * apart * (F.col("n") / a_n * b_n)
    left = F.greatest(F.lit(0.0), F.col("a_squares") - taken)
    error = _EPSILON * F.greatest(F.abs("a_mean"), F.abs("b_mean")) * (a_n / F.col("n"))
    spread = F.sqrt(F.col("squares") / F.col("n"))
    return less.withColumn("squares", left).select(
        "series",
        "n",
        "mean",
        "squares",
        (
            (b_n > 0)
            & ((F.col("squares") <= LOST * F.col("a_squares")) | (error > BLUR * spread))
        ).alias("blurred"),
    )


def refreshed(
    kept: DataFrame, gone: DataFrame, come: DataFrame, now: DataFrame, value: str, series: str
) -> DataFrame:
    """``kept`` after the rows ``gone`` were taken from the fact and ``come`` put in.

    ``now`` is the fact after the change; it is read only for series whose
    digits were lost.
    """
    less = taken_away(kept, moments(gone, value, series))
    after = added(less.where("NOT blurred"), moments(come, value, series))
    blurred = less.where("blurred").select(F.col("series").alias("lost"))
    if blurred.isEmpty():
        return after
    again = now.join(blurred, F.col(series).eqNullSafe(F.col("lost")), "left_semi")
    sure = after.join(blurred, F.col("series").eqNullSafe(F.col("lost")), "left_anti")
    return sure.unionByName(moments(again, value, series))


def zscore_of(
    df: DataFrame, value: str, series: str, kept: DataFrame, into: str = "zscore"
) -> DataFrame:
    """Adds how many population stdevs a value sits from its series' kept mean."""
    x = F.col(value).cast("double")
    spread: Column = F.sqrt(F.col("_squares") / F.col("_n"))
    stats = kept.select(F.col("series").alias("_series"), *[F.col(c).alias(f"_{c}") for c in _KEPT])
    return (
        df.join(stats, F.col(series).eqNullSafe(F.col("_series")), "left")
        .withColumn(into, standardised(x, F.col("_mean"), spread))
        .drop("_series", *[f"_{c}" for c in _KEPT])
    )
