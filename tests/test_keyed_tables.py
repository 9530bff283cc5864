"""Tables that are replaced a bucket at a time."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from inkmeter.sources import keyed, tables

SCHEMA = "k bigint, v string"


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), SCHEMA)


def content(spark, name):
    return sorted(((r.k, r.v) for r in keyed.read_keyed(spark, name).collect()), key=repr)


def live_files(spark, name):
    """File of each bucket the table reads now."""
    found = spark.table(name).select("bucket_no", F.input_file_name().alias("f")).distinct().collect()
    return {r.bucket_no: r.f for r in found}


def filled(spark, name, n=200, buckets=16):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keyed.create_keyed(spark, name, SCHEMA, "k", buckets)
    start = spark.range(n).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    keyed.replace_keys(spark, name, start, start.select("k"))
    return start


def test_only_touched_buckets_are_written(spark):
    filled(spark, "lab.keyed")
    before = live_files(spark, "lab.keyed")
    assert len(before) == 16
    written = keyed.replace_keys(spark, "lab.keyed", rows(spark, (3, "new"), (500, "new")), rows(spark, (3, ""), (4, "")))
    after = live_files(spark, "lab.keyed")
    assert 1 <= len(written) <= 3
    assert {b: f for b, f in after.items() if b not in written} == {
        b: f for b, f in before.items() if b not in written
    }
    assert all(after[b] != before[b] for b in written if b in after)
    want = [(k, "old") for k in range(200) if k not in (3, 4)] + [(3, "new"), (500, "new")]
    assert content(spark, "lab.keyed") == sorted(want, key=repr)


def test_replacing_twice_is_replacing_once(spark):
    filled(spark, "lab.twice")
    for _ in range(2):
        keyed.replace_keys(spark, "lab.twice", rows(spark, (1, "a"), (1, "b")), rows(spark, (1, "")))
    assert [p for p in content(spark, "lab.twice") if p[0] == 1] == [(1, "a"), (1, "b")]


def test_an_emptied_bucket_is_empty_and_fills_again(spark):
    filled(spark, "lab.emptied", n=1, buckets=4)
    keyed.replace_keys(spark, "lab.emptied", None, rows(spark, (0, "")))
    assert content(spark, "lab.emptied") == []
    keyed.replace_keys(spark, "lab.emptied", rows(spark, (0, "again")), rows(spark))
    assert content(spark, "lab.emptied") == [(0, "again")]
    assert keyed.replace_keys(spark, "lab.emptied", None, rows(spark)) == []


def test_old_versions_of_a_bucket_go_but_one(spark):
    filled(spark, "lab.versions", n=8, buckets=2)
    for i in range(5):
        keyed.replace_keys(spark, "lab.versions", rows(spark, (1, f"v{i}")), rows(spark, (1, "")))
    root = spark.catalog.getDatabase("lab").locationUri.removeprefix("file:")
    folders = [os.path.basename(p) for p in glob.glob(f"{root}/versions/version=*/bucket_no=*")]
    assert max(folders.count(f) for f in folders) <= 2
    assert len(content(spark, "lab.versions")) == 8


def test_a_reader_keeps_what_it_started_with(spark):
    start = filled(spark, "lab.reader")
    reader = spark.table("lab.reader")
    files = reader.inputFiles()
    keyed.replace_keys(spark, "lab.reader", None, start.select("k"))
    assert spark.read.parquet(*files).count() == 200


def test_null_and_hot_keys(spark):
    spark.sql("DROP TABLE IF EXISTS lab.hot")
    keyed.create_keyed(spark, "lab.hot", SCHEMA, "k", 4)
    hot = spark.range(3000).select(F.lit(7).cast("bigint").alias("k"), F.col("id").cast("string").alias("v"))
    more = hot.union(rows(spark, (None, "null"), (None, "null")))
    keyed.replace_keys(spark, "lab.hot", more, rows(spark, (7, "")))
    keyed.replace_keys(spark, "lab.hot", None, rows(spark, (None, ""), (7, "")))
    assert content(spark, "lab.hot") == [(None, "null"), (None, "null")]


def test_keys_of_another_type_find_their_bucket(spark):
    filled(spark, "lab.typed")
    keys = spark.createDataFrame([("5",), ("6",)], "name string")
    assert keyed.rows_of(spark, "lab.typed", keys, "name").count() == 2
    keyed.replace_keys(spark, "lab.typed", None, keys, "name")
    assert keyed.read_keyed(spark, "lab.typed").count() == 198


def test_reading_keys_scans_their_buckets_only(spark):
    filled(spark, "lab.pruned")
    found = keyed.rows_of(spark, "lab.pruned", rows(spark, (5, "")))
    assert len(found.inputFiles()) == 1 or "PartitionFilters: [" in found._jdf.queryExecution().toString()
    assert [r.k for r in found.collect()] == [5]


def test_table_functions_take_keyed_tables(spark):
    start = filled(spark, "lab.synced")
    tables.delete_where(spark, "lab.synced", rows(spark, (1, ""), (2, "")), "k")
    before = live_files(spark, "lab.synced")
    fresh = rows(spark, (3, "new"))
    tables.sync_table(spark, "lab.synced", fresh, fresh, start.where("k = 9"), "k")
    assert len(set(before.values()) & set(live_files(spark, "lab.synced").values())) >= 13
    want = {(k, "old") for k in range(200)} - {(k, "old") for k in (1, 2, 3, 9)} | {(3, "new")}
    assert set(content(spark, "lab.synced")) == want
    assert set(tables.read_table(spark, "lab.synced").columns) == {"k", "v"}
    tables.write_table(rows(spark, (900, "more")), "lab.synced", mode="append")
    assert (900, "more") in content(spark, "lab.synced")
    with pytest.raises(ValueError):
        tables.write_table(fresh, "lab.synced")


def test_sync_creates_a_keyed_table(spark):
    spark.sql("DROP TABLE IF EXISTS lab.born")
    fresh = rows(spark, (1, "a"), (2, "b"))
    tables.sync_table(spark, "lab.born", fresh, fresh, fresh.where("false"), "k")
    assert keyed.layout_of(spark, "lab.born") == keyed.Layout("k", keyed.BUCKETS)
    assert content(spark, "lab.born") == [(1, "a"), (2, "b")]


def test_bad_layouts_are_refused(spark):
    with pytest.raises(ValueError):
        keyed.create_keyed(spark, "lab.bad", SCHEMA, "none")
    with pytest.raises(ValueError):
        keyed.replace_keys(spark, "lab.plain_one", None, _plain(spark), "k")


def _plain(spark):
    df = rows(spark, (1, "a"))
    tables.write_table(df, "lab.plain_one")
    return df
