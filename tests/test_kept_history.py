"""Type-2 history kept between runs in open and closed rows."""

import os

import pytest
from pyspark.sql import functions as F

from inkmeter.operators import history
from inkmeter.sources import keyed

DAYS = [f"2024-01-0{d} 00:00:00" for d in range(1, 8)]
STATES = [
    [(1, "a"), (2, "b"), (3, None), (5, "e")],
    [(1, "a"), (2, "B"), (4, "d"), (5, "e")],
    [(1, "a"), (2, "B"), (3, ""), (4, "d"), (5, "e")],
    [(1, "A"), (2, "B"), (3, None), (5, "e")],
]


def state(spark, rows):
    return spark.createDataFrame(rows, "k int, v string")


def fresh(spark, name):
    spark.sql("CREATE SCHEMA IF NOT EXISTS lab")
    for part in ("open", "closed"):
        spark.sql(f"DROP TABLE IF EXISTS {name}_{part}")


def kept(spark, name):
    return sorted((tuple(r) for r in history.read_history(spark, name).collect()), key=repr)


def expected(spark, days=4):
    versions = history.first_snapshot(state(spark, STATES[0]), DAYS[0])
    for rows, day in list(zip(STATES, DAYS))[1:days]:
        versions = history.snapshot(versions, state(spark, rows), "k", day)
    return sorted((tuple(r) for r in versions.collect()), key=repr)


def test_kept_history_equals_the_compared_one(spark):
    fresh(spark, "lab.kept")
    for rows, day in zip(STATES, DAYS):
        history.snapshot_table(spark, "lab.kept", state(spark, rows), "k", day, buckets=4)
        history.snapshot_table(spark, "lab.kept", state(spark, rows), "k", day, buckets=4)
    assert kept(spark, "lab.kept") == expected(spark)
    with pytest.raises(ValueError):
        history.snapshot_table(spark, "lab.kept", state(spark, STATES[0]), "k", DAYS[0])


def closed_files(spark, name):
    root = spark.catalog.getDatabase("lab").locationUri.removeprefix("file:")
    return {
        (folder, f): os.stat(os.path.join(folder, f)).st_mtime_ns
        for folder, _, names in os.walk(f"{root}/{name.split('.')[1]}_closed")
        for f in names
        if f.endswith(".parquet")
    }


def test_closed_files_are_never_touched_again(spark):
    fresh(spark, "lab.still")
    before = {}
    for rows, day in zip(STATES, DAYS):
        history.snapshot_table(spark, "lab.still", state(spark, rows), "k", day, buckets=4)
        after = closed_files(spark, "lab.still")
        assert before.items() <= after.items()
        before = after
    assert before


def test_unchanged_keys_are_not_written(spark):
    fresh(spark, "lab.few")
    many = spark.range(400).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    history.snapshot_table(spark, "lab.few", many, "k", DAYS[0], buckets=32)

    def files():
        found = spark.table("lab.few_open").select(F.input_file_name().alias("f")).distinct()
        return {r.f for r in found.collect()}

    first = files()
    one = many.withColumn("v", F.when(F.col("k") == 7, "y").otherwise(F.col("v")))
    history.snapshot_table(spark, "lab.few", one, "k", DAYS[1])
    assert len(first - files()) == 1


@pytest.mark.parametrize("dies_at", ["closed", "open", "mark", "clear"])
@pytest.mark.parametrize("next_day", [1, 2])
def test_a_run_that_died_is_finished(spark, monkeypatch, dies_at, next_day):
    name = f"lab.died_{dies_at}_{next_day}"
    fresh(spark, name)
    history.snapshot_table(spark, name, state(spark, STATES[0]), "k", DAYS[0], buckets=4)
    before = kept(spark, name)

    class Died(Exception):
        pass

    real, swap = history._carry_out, keyed.replace_keys

    def dying(*args):
        def swapped(*a):
            if dies_at == "closed":
                raise Died
            # half of the keys only, as when a run dies between buckets
            rows, keys = a[2].where("k < 3"), a[3].where("_key < 3")
            swap(a[0], a[1], *((rows, keys) if dies_at == "open" else a[2:4]), a[4])
            if dies_at in ("open", "mark"):
                raise Died

        monkeypatch.setattr(keyed, "replace_keys", swapped)
        if dies_at == "clear":
            monkeypatch.setattr(history, "_folder", _no_delete(history._folder))
        real(*args)
        raise Died

    def _no_delete(folder):
        class Files:
            def __init__(self, files):
                self.exists = files.exists

            def delete(self, *_):
                raise Died

        return lambda *a: (folder(*a)[0], Files(folder(*a)[1]))

    with monkeypatch.context() as patched:
        patched.setattr(history, "_carry_out", dying)
        with pytest.raises(Died):
            history.snapshot_table(spark, name, state(spark, STATES[1]), "k", DAYS[1])
    monkeypatch.undo()
    if dies_at == "closed":
        assert kept(spark, name) == before
    for rows, day in list(zip(STATES, DAYS))[next_day:]:
        history.snapshot_table(spark, name, state(spark, rows), "k", day)
    assert kept(spark, name) == expected(spark)
