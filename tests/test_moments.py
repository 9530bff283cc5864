"""Statistics brought up to date by a change against statistics of the whole."""

import random

import pytest
from pyspark.sql import functions as F

from inkmeter.plans import marts, moments

SCHEMA = "work_id long, metric string, value double"


def _table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def _rows(seed, works):
    rng = random.Random(seed)
    for w in works:
        yield (w, "near", rng.gauss(1e5, 1.0))
        yield (w, "wide", rng.gauss(0.0, 1e3) if w % 5 else None)
        yield (w, None, float(w % 3))
        yield (w, "flat", 2.5)


def _unread(df):
    """The same columns, but reading a row fails."""
    return df.withColumn("value", F.raise_error(F.lit("the fact was read")).cast("double"))


def _same(got, want):
    left = {(r.work_id, r.metric): r.zscore for r in got.collect()}
    right = {(r.work_id, r.metric): r.zscore for r in want.collect()}
    assert left.keys() == right.keys()
    for key, z in right.items():
        assert left[key] == (None if z is None else pytest.approx(z, abs=1e-9)), key


def test_a_change_is_carried_over_without_reading_the_fact(spark):
    old = list(_rows(1, range(400)))
    gone = [r for r in old if r[0] % 9 == 0]
    come = list(_rows(2, range(0, 500, 9))) + [(7, "new", 1.0), (8, "new", 3.0)]
    now = _table(spark, [r for r in old if r[0] % 9] + come)
    fact = now.where("metric IS NULL OR metric <> 'flat'")
    kept = moments.moments(_table(spark, [r for r in old if r[1] != "flat"]), "value", "metric")
    change = [_table(spark, [r for r in rows if r[1] != "flat"]) for rows in (gone, come)]
    new = moments.refreshed(kept, *change, _unread(fact), "value", "metric")
    _same(moments.zscore_of(fact, "value", "metric", new), marts.zscore(fact, "value", "metric"))


def test_only_series_that_lost_digits_are_counted_again(spark):
    rest = list(_rows(3, range(100)))
    gone = [(1000, "near", 1e15), (1000, "wide", 3.0), (1000, "flat", 4.0), (1000, "last", 1.0)]
    now = _table(spark, rest)
    kept = moments.moments(_table(spark, rest + gone), "value", "metric")
    less = moments.taken_away(kept, moments.moments(_table(spark, gone), "value", "metric"))
    assert {r.series: r.blurred for r in less.collect()} == {
        "near": True, "flat": True, "wide": False, None: False,
    }
    new = moments.refreshed(kept, _table(spark, gone), _table(spark, []), now, "value", "metric")
    _same(moments.zscore_of(now, "value", "metric", new), marts.zscore(now, "value", "metric"))


def test_empty_tables(spark):
    none, some = _table(spark, []), _table(spark, list(_rows(4, range(9))))
    nothing = moments.moments(none, "value", "metric")
    assert moments.refreshed(nothing, none, none, none, "value", "metric").count() == 0
    first = moments.refreshed(nothing, none, some, _unread(some), "value", "metric")
    _same(moments.zscore_of(some, "value", "metric", first), marts.zscore(some, "value", "metric"))
    whole = moments.moments(some, "value", "metric")
    assert moments.refreshed(whole, some, none, none, "value", "metric").count() == 0
    assert moments.zscore_of(some, "value", "metric", nothing).where("zscore IS NOT NULL").count() == 0
