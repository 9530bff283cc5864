"""The nightly run over tables: a delta, a repeated run, a night without changes."""

import os

from pyspark.sql import functions as F

from inkmeter.operators import tokens
from inkmeter.plans import nightly
from inkmeter.sources import keyed
from inkmeter.sources.catalog import stamp

FEED = (
    "catalog_id bigint, type string, issued string, title string, language string, "
    "authors string, subjects string, locc string, bookshelves string"
)


def feed(spark, titles, run_ts):
    rows = [
        (i, "Text", "1999-01-01", t, "en", f"Writer {i}, 1800-1850", "Fiction", "PS", "Science Fiction")
        for i, t in titles.items()
    ]
    return stamp(spark.createDataFrame(rows, FEED), run_ts)


def corpus(spark, texts):
    rows = [(str(i), 0, t) for i, t in texts.items()]
    return spark.createDataFrame(rows, "work_id string, is_self int, text string")


def files(spark, schema):
    root = spark.catalog.getDatabase(schema).locationUri.removeprefix("file:")
    return {
        os.path.join(folder, n)
        for folder, _, names in os.walk(root)
        for n in names
        if n.endswith(".parquet") and "ingest_audit" not in folder
    }


def rows(spark, name):
    return sorted(map(tuple, keyed.read_keyed(spark, name).collect()), key=str)


def test_nights(spark, tmp_path):
    names = nightly.Tables("nights")
    spark.sql("DROP SCHEMA IF EXISTS nights CASCADE")
    manifest = spark.createDataFrame([], "work_id string, loaded_at timestamp")
    landing = tmp_path / "landing"
    landing.mkdir()
    titles = {1: "One", 2: "Two", 3: "Three"}
    texts = {1: "A cat sat. It slept.", 2: "Dogs bark at cats.", 3: "Rain fell."}
    for i, t in texts.items():
        (landing / f"{i}.txt").write_text(t)

    def night(number, run_titles, run_texts):
        run_ts = f"2024-01-0{number} 00:00:00"
        nightly.nightly_run(
            spark, names, feed(spark, run_titles, run_ts), corpus(spark, run_texts), manifest, run_ts,
            f"{tmp_path}/run{number}", str(landing), str(tmp_path / "checkpoint"),
        )

    def all_rows():
        held = (names.catalog, names.roster, names.ledger, names.measurements, names.vocabulary)
        return {n: rows(spark, n) for n in held}

    def audit(number):
        found = keyed.read_keyed(spark, names.audit).where(F.dayofmonth("run_ts") == number)
        return {r.run_type: tuple(r)[3:] for r in found.collect()}

    night(1, titles, texts)
    assert audit(1) == {"catalog_refresh": (3, 3, 0, 0, 0), "text_ingest": (3, 3, 0, 3, 0)}
    first = all_rows()
    assert {r[0] for r in first[names.measurements]} == {"1", "2", "3"}
    assert ("1", "cat", 1) in {r[:3] for r in first[names.vocabulary]}

    # A repeated run leaves what it left, its audit rows too
    night(1, titles, texts)
    assert all_rows() == first
    assert audit(1) == {"catalog_refresh": (3, 3, 0, 0, 0), "text_ingest": (3, 3, 0, 3, 0)}

    # A night without changes writes no data file
    before = files(spark, "nights")
    night(2, titles, texts)
    assert files(spark, "nights") == before and all_rows() == first
    assert audit(2) == {"catalog_refresh": (3, 0, 0, 0, 0), "text_ingest": (3, 0, 0, 0, 0)}

    # One title changed and its text fetched again, one work gone, one new without a text
    (landing / "third").mkdir()
    (landing / "third" / "2.txt").write_text("Dogs bark at cats and cars.")
    night(3, {1: "One", 2: "Two again", 4: "Four"}, {1: texts[1], 2: "Dogs bark at cats and cars."})
    assert audit(3)["catalog_refresh"] == (3, 1, 1, 0, 0)
    last = all_rows()
    assert {r[0] for r in last[names.catalog]} == {1, 2, 4}
    assert {r[0] for r in last[names.measurements]} == {"1", "2"}
    kept = [r for r in first[names.measurements] if r[0] == "1"]
    assert [r for r in last[names.measurements] if r[0] == "1"] == kept
    assert ("2", "cars", 1) in {r[:3] for r in last[names.vocabulary]}
    assert not any(r[0] == "3" for r in last[names.vocabulary])
    assert len(rows(spark, names.audit)) == 6


def test_a_night_reads_its_feed_once_and_tokenises_a_text_once(spark, tmp_path, monkeypatch):
    """The feed's rows were worked out anew for every look at them, and each text twice."""
    names = nightly.Tables("one_night")
    spark.sql("DROP SCHEMA IF EXISTS one_night CASCADE")
    manifest = spark.createDataFrame([], "work_id string, loaded_at timestamp")
    run_ts = "2024-01-01 00:00:00"
    looked = spark.sparkContext.accumulator(0)
    read = spark.sparkContext.accumulator(0)

    def seen(counter):
        def batches(found):
            for batch in found:
                counter.add(batch.num_rows)
                yield batch

        return batches

    def counting(df, counter):
        return df.mapInArrow(seen(counter), df.schema)

    titles, texts = {1: "One", 2: "Two"}, {1: "A cat sat. A cat slept.", 2: "Dogs bark at cats."}
    made = tokens.text_units
    monkeypatch.setattr(tokens, "text_units", lambda *a, **b: counting(made(*a, **b), read))
    nightly.nightly_run(
        spark, names, counting(feed(spark, titles, run_ts), looked), corpus(spark, texts), manifest, run_ts, f"{tmp_path}/run"
    )
    assert (looked.value, read.value) == (2, 2)
    assert {r[:3] for r in rows(spark, names.vocabulary)} >= {("1", "cat", 2), ("2", "dogs", 1)}
    audit = keyed.read_keyed(spark, names.audit).select("run_type", "books_in_catalog", "candidate_new")
    assert [tuple(r) for r in audit.collect()] == [("catalog_refresh", 2, 2)]
