"""Texts made to break regexes and quadratic rules: huge runs, no breaks, all marks."""

import time

from pyspark.sql import functions as F

from inkmeter.functions import prose
from inkmeter.operators import metrics, prepare
from inkmeter.operators import tokens as tok

SIZE = 60_000
TEXTS = {
    "one word": "a" * SIZE,
    "no stops": "ab " * (SIZE // 3),
    "stars": "*" * SIZE,
    "underscores": "_" * SIZE,
    "quotes": "'\"" * (SIZE // 2),
    "single quotes": "'a " * (SIZE // 3),
    "dots": "." * SIZE,
    "newlines": "\n" * SIZE,
    "blank lines": "x\n\n" * (SIZE // 3),
    "spaces": " " * SIZE,
    "brackets": "[" * SIZE,
    "one per line": "IV\n" * (SIZE // 3),
    "apostrophes": "don't " * (SIZE // 6),
}


def test_measuring(spark):
    docs = spark.createDataFrame(list(TEXTS.items()), "work_id string, text string")
    start = time.time()
    rows = {r.work_id: r for r in metrics.measure_wide(tok.text_view(docs)).collect()}
    assert time.time() - start < 120
    assert rows.keys() == TEXTS.keys()
    assert rows["no stops"].word_count == SIZE // 3
    assert rows["blank lines"].word_count == SIZE // 3
    assert rows["apostrophes"].contraction_rate == 1
    assert rows["one word"].mean_word_length == SIZE


def test_preparing(spark):
    start, end = "*** START OF THE PROJECT GUTENBERG EBOOK ***\n", "\n*** END OF THE PROJECT GUTENBERG EBOOK ***"
    rows = [(k, bytearray((start + v + end).encode()), "Title", "Author") for k, v in TEXTS.items()]
    files = spark.createDataFrame(rows, "work_id string, content binary, title string, authors string")
    begun = time.time()
    got = {r.work_id: r for r in prepare.to_markdown(files).collect()}
    assert time.time() - begun < 240
    assert all(r.status == "ok" for r in got.values())
    assert got["blank lines"].markdown.count("x") == SIZE // 3
    cleaned = files.select("work_id", prose.clean_markdown(F.col("content").cast("string")).alias("v"))
    assert len(cleaned.collect()) == len(TEXTS)


def test_a_hot_work_is_cut(spark):
    """One work with a third of all text is many even units."""
    paragraph = "some words of a paragraph that go on. " * 20
    docs = spark.createDataFrame(
        [("hot", "\n\n".join([paragraph] * 500)), *[(f"w{i}", paragraph) for i in range(1000)]],
        "work_id string, text string",
    )
    units = tok.text_units(docs)
    assert units.filter("work_id = 'hot'").count() >= 4
    assert units.agg(F.max(F.length("text"))).first()[0] <= 100_000
    row = metrics.measure_wide(tok.text_view(docs)).filter("work_id = 'hot'").first()
    assert row.word_count == 500 * 20 * 8
    assert row.mean_sentence_length == 8
