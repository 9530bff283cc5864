"""Catalog feed, change capture, history, tables, checks and plan shape."""

import contextlib
import io

import os

import pytest
from pyspark.sql import functions as F

from checks import bindings as b
from inkmeter.functions import catalog as c
from inkmeter.operators import cdc, history, metrics, quality, scope
from inkmeter.operators import tokens as tok
from inkmeter.plans import marts
from inkmeter.sources import corpus, lookups, tables
from inkmeter.sources import catalog as feed

SF = "/root/testdata/sf0.001"


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


HEADER = "Text#,Type,Issued,Title,Language,Authors,Subjects,LoCC,Bookshelves\n"


def test_catalog_csv(spark, tmp_path):
    path = write(
        tmp_path / "feed.csv",
        HEADER
        + '1,Text,2001-01-01,"Two\nlines",en,"Doe, J","Science fiction; ""Robots""",PS,\n'
        + "2,Sound,,Song,en,,,,\n",
    )
    rows = feed.read_catalog(spark, path, "2024-05-06 07:08:09").orderBy("catalog_id").collect()
    assert [r.catalog_id for r in rows] == [1, 2]
    assert rows[0].title == "Two\nlines" and rows[0].subjects == 'Science fiction; "Robots"'
    assert rows[0].snapshot_date == "2024-05-06" and str(rows[0].loaded_at) == "2024-05-06 07:08:09"
    assert rows[1].authors is None and len(rows[1].catalog_row_hash) == 64
    assert feed.normalize_column("Text#") == "text" and feed.normalize_column(" Lo CC!") == "lo_cc"


def test_catalog_fails_loudly(spark, tmp_path):
    bad_id = write(tmp_path / "bad.csv", HEADER + "x1,Text,,T,en,,,,\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feed.read_catalog(spark, bad_id, "2024-01-01 00:00:00").collect()
    no_id = write(tmp_path / "none.csv", "Title,Type\nT,Text\n")
    with pytest.raises(KeyError):
        feed.read_catalog(spark, no_id, "2024-01-01 00:00:00")


def test_display_author(spark):
    cases = {
        "Smythe, Clark Ashton, 1893-1961": "Clark Ashton Smythe",
        "Doe, Jane [Editor]; Roe, R. (Richard), 1900?-": "R. Roe",
        "Doe, Jane [Editor]": "Jane Doe",
        "Homeros, 8th cent. BC": "Homeros",
        "": "Unknown",
        None: "Unknown",
    }
    rows = spark.createDataFrame(list(cases.items()), "authors string, want string")
    for r in rows.withColumn("got", c.display_author()).collect():
        assert r.got == r.want, r.authors


def test_slug_folds_accents(spark):
    row = (
        spark.createDataFrame([("L'Île — Mystérieuse: ½ Œuvre",), ("---",)], "t string")
        .select(c.title_slug(F.col("t")).alias("s"))
        .collect()
    )
    assert [r.s for r in row] == ["l-ile-mysterieuse", "untitled"]


def test_keep_first_survives_a_hot_key(spark):
    """A third of all rows under one key: one row per key, none lost."""
    df = spark.range(30_000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    )
    kept = scope.keep_first(df, {"k": F.col("k")}, "id")
    assert kept.count() == 20_001
    assert kept.filter("k = 'hot'").first().id == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


LEDGER = [
    (1, "same", "t1", "ingested"),
    (2, "old", "t2", "ingested"),
    (3, "same", None, "failed"),
    (4, "same", None, "copyrighted"),
    (9, "gone", "t9", "ingested"),
]


def ledger(spark):
    return spark.createDataFrame(LEDGER, "catalog_id bigint, catalog_row_hash string, text_hash string, status string").select(
        "catalog_id", "catalog_row_hash", "text_hash",
        F.lit("2023-01-01").cast("timestamp").alias("first_seen"),
        F.lit("2023-01-01").cast("timestamp").alias("last_changed"),
        "status",
    )


def test_change_capture(spark):
    works = spark.createDataFrame(
        [(1, "same"), (2, "new"), (3, "same"), (4, "same"), (5, "new")], "catalog_id bigint, catalog_row_hash string"
    )
    counts = cdc.diff_counts(works, ledger(spark)).first()
    assert (counts.roster_size, counts.candidate_new, counts.candidate_changed) == (5, 1, 1)
    pending = cdc.backlog(works, ledger(spark))
    assert sorted(r.catalog_id for r in pending.collect()) == [2, 3, 5]
    assert [r.catalog_id for r in cdc.next_batch(pending, 2).collect()] == [2, 3]
    done = spark.createDataFrame(
        [(2, "new", "n2", "ingested"), (5, "new", None, "failed")],
        "catalog_id bigint, catalog_row_hash string, text_hash string, status string",
    )
    once = cdc.upsert_ledger(ledger(spark), done, "2024-01-01 00:00:00")
    twice = cdc.upsert_ledger(once, done, "2024-01-01 00:00:00")
    rows = {r.catalog_id: r for r in once.collect()}
    assert {r.catalog_id: r for r in twice.collect()} == rows and len(rows) == 6
    assert (rows[2].text_hash, str(rows[2].first_seen), str(rows[2].last_changed)) == (
        "n2", "2023-01-01 00:00:00", "2024-01-01 00:00:00",
    )
    assert str(rows[5].first_seen) == "2024-01-01 00:00:00" and rows[9].text_hash == "t9"


def test_snapshot_history(spark):
    def rows(*values):
        return spark.createDataFrame(list(values), "k int, v string")

    first = history.first_snapshot(rows((1, "a"), (2, "b"), (3, None)), "2024-01-01 00:00:00")
    second = history.snapshot(first, rows((1, "a"), (2, "B"), (4, "d")), "k", "2024-01-02 00:00:00")
    replay = history.snapshot(second, rows((1, "a"), (2, "B"), (4, "d")), "k", "2024-01-03 00:00:00")
    shown = sorted((r.k, r.v or "", str(r.valid_from)[8:10], str(r.valid_to)[8:10]) for r in second.collect())
    assert shown == [
        (1, "a", "01", ""), (2, "B", "02", ""), (2, "b", "01", "02"), (3, "", "01", "02"), (4, "d", "02", ""),
    ]
    assert sorted(map(tuple, replay.collect()), key=str) == sorted(map(tuple, second.collect()), key=str)
    back = history.snapshot(replay, rows((1, "a"), (3, ""), (4, "d")), "k", "2024-01-04 00:00:00")
    assert back.filter("k = 3").count() == 2 and back.filter("k = 3 AND valid_to IS NULL").count() == 1


def test_tables(spark):
    with pytest.raises(tables.TableMissing):
        tables.read_table(spark, "lab.missing")
    tables.ensure_table(spark, "lab.t", "id bigint, v string")
    assert tables.read_table(spark, "lab.t").count() == 0
    tables.write_table(spark.createDataFrame([("a", 1)], "v string, id bigint"), "lab.t", mode="append")
    tables.write_table(spark.createDataFrame([("b", 2)], "v string, id bigint"), "lab.t", mode="append")
    assert {(r.id, r.v) for r in spark.table("lab.t").collect()} == {(1, "a"), (2, "b")}
    # Reading the table while overwriting it
    tables.delete_where(spark, "lab.t", spark.createDataFrame([(1,)], "id bigint"), "id")
    assert [(r.id, r.v) for r in tables.read_table(spark, "lab.t", ["id", "v"]).collect()] == [(2, "b")]
    tables.delete_where(spark, "lab.t", spark.createDataFrame([], "id bigint"), "id")
    fresh = spark.createDataFrame([(3, "c"), (2, "B")], "id bigint, v string")
    none = spark.createDataFrame([], "id bigint")
    tables.sync_table(spark, "lab.t", fresh, fresh.select("id"), none, "id")
    assert {(r.id, r.v) for r in spark.table("lab.t").collect()} == {(2, "B"), (3, "c")}
    # Measured again without a row: the old row goes
    tables.sync_table(spark, "lab.t", fresh.where("id = 9"), fresh.where("id = 3"), none, "id")
    assert [(r.id, r.v) for r in spark.table("lab.t").collect()] == [(2, "B")]
    for i in range(5):
        tables.write_table(spark.createDataFrame([(i, "x")], "id bigint, v string"), "lab.t")
    root = spark.catalog.getDatabase("lab").locationUri.removeprefix("file:")
    assert sum(n.startswith("version=") for n in os.listdir(f"{root}/t")) == 2
    tables.write_table(spark.createDataFrame([(1.5,)], "x double"), "lab.t")
    assert spark.table("lab.t").columns == ["x"]


def test_corpus_files(spark, tmp_path):
    (tmp_path / "own").mkdir()
    (tmp_path / "Other").mkdir()
    write(tmp_path / "own" / "my-story.md", "mine")
    write(tmp_path / "Other" / "12-a-tale.md", "theirs")
    write(tmp_path / "Other" / "13.txt", "raw")
    got = {r.work_id: (r.is_self, r.text) for r in corpus.read_corpus(spark, str(tmp_path), "own").collect()}
    assert got == {"my-story": (1, "mine"), "12": (0, "theirs")}
    texts = corpus.read_texts(spark, str(tmp_path / "Other"))
    assert [(r.work_id, bytes(r.content)) for r in texts.collect()] == [("13", b"raw")]
    roster = spark.createDataFrame([("13",), ("14",)], "work_id string")
    assert [r.work_id for r in corpus.missing_texts(roster, texts).collect()] == ["14"]
    landed = spark.createDataFrame([("7",), ("007",), ("8",), ("notes",)], "stem string")
    kept = spark.createDataFrame([(7,)], "catalog_id bigint")
    assert [r.stem for r in corpus.orphan_texts(kept, landed).collect()] == ["8"]


def test_manifest_and_run_log(spark, tmp_path):
    path = write(tmp_path / "m.csv", "work_id,loaded_at\nmine,2024-01-02 03:04:05\n")
    row = lookups.read_manifest(spark, path).first()
    assert (row.work_id, str(row.loaded_at)) == ("mine", "2024-01-02 03:04:05")
    log = history.run_log(spark, "run-1", "2024-01-01 00:00:00", "build", [("dim_work", "model", "success", 1.23456)])
    assert log.first().execution_time == 1.235 and log.columns == [
        "invocation_id", "run_started_at", "command", "node", "resource_type", "status", "execution_time",
    ]


def test_quality_ignores_null_keys(spark):
    df = spark.createDataFrame([(1,), (1,), (None,), (None,), (2,)], "k int")
    assert [tuple(r) for r in quality.not_unique(df, "k").collect()] == [(1, 2)]
    assert quality.unrelated(df, "k", df.filter("k = 1"), "k").count() == 1
    assert quality.stale_source(df.select(F.lit(None).cast("timestamp").alias("t")), "t", "2024-01-01").count() == 1


# --- Invariants of the built marts --------------------------------------------


def test_mart_invariants(spark, tmp_path):
    wh = b.warehouse(spark, SF)
    style = wh.mart_style_long
    stats = style.groupBy("metric_name").agg(F.avg("zscore").alias("m"), F.stddev_pop("zscore").alias("s")).collect()
    assert len(stats) == 63
    for r in stats:
        assert r.m is None or (abs(r.m) < 1e-9 and abs(r.s - 1) < 1e-9)
    mixes = style.filter("concept_name = 'sentence_type_mix'").groupBy("work_key").agg(F.sum("value").cast("double").alias("s"))
    assert mixes.filter("s > 0 AND abs(s - 1) > 0.00001").count() == 0
    assert quality.out_of_range(wh.fact_vocab_overlap, "jaccard", 0, 1).count() == 0
    assert quality.incomplete_concepts(wh.fact_style_measurement).count() == 0
    tables.export_tables(wh.tables(), str(tmp_path / "export"))
    assert spark.read.parquet(str(tmp_path / "export" / "mart_work")).count() == wh.mart_work.count()


# --- Plan shape ------------------------------------------------------------------


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def test_zscore_moves_only_statistics(spark):
    events = b.table(spark, SF, "events")
    plan = plan_of(marts.zscore(events, "value", "event_type"))
    assert "Window" not in plan and "BroadcastHashJoin" in plan
    assert "CartesianProduct" not in plan


def test_report_filter_reaches_the_scan(spark):
    from inkmeter.plans import reports

    plan = plan_of(reports.signature(b.warehouse(spark, SF), "1"))
    assert "PushedFilters: [IsNotNull(work_id), IsNotNull(is_multivalue), EqualTo(work_id,1)" in plan or (
        "EqualTo(work_id,1)" in plan
    )


def test_one_author_reports_match_the_whole(spark):
    from inkmeter.plans import reports

    wh = b.warehouse(spark, SF)
    author = wh.mart_author.orderBy(F.desc("works")).first().author
    work = wh.mart_work.filter(F.col("author") == author).first().work_id
    for report in (reports.author_distinctive, reports.author_function_words, reports.author_works):
        one = report(wh, author).collect()
        assert one and one == [r for r in report(wh).collect() if r.author == author]
    for report in (reports.deviation, reports.signature, reports.work_function_words):
        one, every = report(wh, work).collect(), [r for r in report(wh).collect() if r.work_id == work]
        assert [tuple(r)[:2] for r in one] == [tuple(r)[:2] for r in every] and one
