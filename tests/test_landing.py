"""The nightly run over a landing folder."""

import os
import re

import pytest

from inkmeter.operators import cdc
from inkmeter.sources import keyed, tables
from inkmeter.streaming import landing as stream
from inkmeter.streaming.landing import ingest_landed


def make_ledger(spark, name, by_key):
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if by_key:
        keyed.create_keyed(spark, name, cdc.LEDGER_SCHEMA, "catalog_id", 8)
    else:
        tables.ensure_table(spark, name, cdc.LEDGER_SCHEMA)


def works(spark, n):
    return spark.createDataFrame(
        [(i, f"h{i}") for i in range(1, n + 1)], "catalog_id bigint, catalog_row_hash string"
    )


def rows(spark, name):
    return {r.catalog_id: r for r in tables.read_table(spark, name).collect()}


@pytest.mark.parametrize("by_key", [True, False])
def test_each_run_reads_what_landed_since(spark, tmp_path, by_key):
    landing, checkpoint = tmp_path / "texts", str(tmp_path / "checkpoint")
    landing.mkdir()
    name = f"lab.ledger_{'keyed' if by_key else 'plain'}"
    make_ledger(spark, name, by_key)

    def run(ts):
        ingest_landed(spark, str(landing), works(spark, 5), name, checkpoint, ts, files_per_batch=2)
        return rows(spark, name)

    for n, body in ((1, b"one"), (2, b"two"), (3, b"Copyrighted Project Gutenberg eBook")):
        (landing / f"{n}.txt").write_bytes(body)
    (landing / "notes.txt").write_bytes(b"no work")
    first = run("2024-01-01 00:00:00")
    assert {k: r.status for k, r in first.items()} == {1: "ingested", 2: "ingested", 3: "copyrighted"}
    assert first[3].text_hash is None and len(first[1].text_hash) == 64

    (landing / "4.txt").write_bytes(b"four")
    second = run("2024-01-02 00:00:00")
    assert {k: r for k, r in second.items() if k != 4} == first
    assert str(second[4].first_seen) == "2024-01-02 00:00:00"
    assert run("2024-01-03 00:00:00") == second


def ledger_files(spark, name):
    root = spark.catalog.getDatabase("lab").locationUri.removeprefix("file:")
    found = {}
    for folder, _, names in os.walk(f"{root}/{name.split('.')[1]}"):
        for n in names:
            if n.endswith(".parquet"):
                found[os.path.join(folder, n)] = os.path.getsize(os.path.join(folder, n))
    return found


def test_the_ledger_is_written_once_a_run(spark, tmp_path):
    written = []
    for batch in (1, 12):
        name, landing = f"lab.ledger_once_{batch}", tmp_path / f"texts{batch}"
        landing.mkdir()
        make_ledger(spark, name, True)
        for n in range(1, 13):
            (landing / f"{n}.txt").write_bytes(b"text %d" % n)
        ingest_landed(
            spark, str(landing), works(spark, 12), name, str(tmp_path / f"check{batch}"),
            "2024-01-01 00:00:00", files_per_batch=batch,
        )
        assert len(rows(spark, name)) == 12
        written.append(sorted(ledger_files(spark, name).values()))
        root = spark.catalog.getDatabase("lab").locationUri.removeprefix("file:")
        assert len(os.listdir(f"{root}/{name.split('.')[1]}")) == 1  # one version
    assert written[0] == written[1]  # twelve batches of one file, one batch of twelve


def outcomes(spark, *found):
    return spark.createDataFrame(
        [(i, f"h{i}", text, status) for i, text, status in found],
        "catalog_id bigint, catalog_row_hash string, text_hash string, status string",
    )


def test_a_replayed_batch_and_a_replayed_merge_change_nothing(spark, tmp_path):
    name, log = "lab.ledger_replay", str(tmp_path / "log")
    make_ledger(spark, name, True)
    ts = "2024-01-01 00:00:00"
    stream.log_outcomes(outcomes(spark, (1, "a", "ingested"), (2, None, "failed")), log, 0, ts)
    stream.log_outcomes(outcomes(spark, (1, "a", "ingested"), (2, None, "failed")), log, 0, ts)
    stream.log_outcomes(outcomes(spark, (2, "b", "ingested")), log, 1, ts)
    stream.merge_log(spark, log, name)
    once = rows(spark, name)
    assert {k: (r.status, r.text_hash) for k, r in once.items()} == {1: ("ingested", "a"), 2: ("ingested", "b")}
    assert not os.path.exists(log)
    # The run died after the ledger was written, before the log was cleared
    stream.log_outcomes(outcomes(spark, (1, "a", "ingested"), (2, None, "failed")), log, 0, ts)
    stream.log_outcomes(outcomes(spark, (2, "b", "ingested")), log, 1, ts)
    stream.merge_log(spark, log, name)
    stream.merge_log(spark, log, name)
    assert rows(spark, name) == once


def test_a_log_left_behind_is_merged_by_the_next_run(spark, tmp_path):
    name, landing, checkpoint = "lab.ledger_left", tmp_path / "texts", str(tmp_path / "checkpoint")
    landing.mkdir()
    make_ledger(spark, name, True)
    stream.log_outcomes(
        outcomes(spark, (9, "x", "ingested")), f"{checkpoint}-outcomes", 0, "2024-01-01 00:00:00"
    )
    ingest_landed(spark, str(landing), works(spark, 1), name, checkpoint, "2024-01-02 00:00:00")
    assert str(rows(spark, name)[9].last_changed) == "2024-01-01 00:00:00"


def test_no_content_reaches_a_join(spark, tmp_path):
    (tmp_path / "1.txt").write_bytes(b"one")
    files = spark.read.format("binaryFile").load(str(tmp_path))
    plan = stream.landed_outcomes(files, works(spark, 3))._jdf.queryExecution().executedPlan().toString()
    above = plan[: re.search("Scan binaryFile|FileScan binaryFile|BatchScan", plan).start()]
    joins = [line for line in above.splitlines() if "Join" in line or "Exchange" in line]
    assert joins and not any("content" in line for line in joins)
    sides = stream.landed_outcomes(files, works(spark, 3))._jdf.queryExecution().optimizedPlan()
    assert "content" not in sides.children().apply(0).children().apply(0).output().toString()
