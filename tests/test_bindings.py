"""The given tables in the library's shapes."""

from pyspark.sql import functions as F

from checks import bindings
from inkmeter.operators import metrics
from inkmeter.operators import tokens as tok


def _write_documents(spark, folder, n):
    rows = [(i, f"Word{i} walked. It ended wings's", "en", f"src{i % 5}", 30) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.coalesce(1).write.parquet(f"{folder}/documents.parquet")


def test_a_file_of_one_split_is_parsed_by_many_tasks(spark, tmp_path):
    _write_documents(spark, tmp_path, 400)
    found = bindings.parsed(spark, str(tmp_path))
    files = found.select(F.input_file_name().alias("f"), "work_id")
    assert files.count() == 400
    assert files.select("f").distinct().count() > 1


def test_load_times_are_joined_to_works_not_to_series(spark):
    wide = spark.createDataFrame([("a", 1.0, 2.0), ("b", 3.0, 4.0)], "work_id string, x double, y double")
    loaded = spark.createDataFrame([("a", "t1"), ("a", "t2"), ("b", "t3")], "work_id string, loaded_at string")
    long = metrics.to_long(wide.join(loaded, "work_id"), F.col("loaded_at"), "loaded_at")
    assert long.columns == ["work_id", "metric", "value", "loaded_at"]
    assert sorted(map(tuple, long.collect())) == [
        ("a", "x", 1.0, "t1"), ("a", "x", 1.0, "t2"), ("a", "y", 2.0, "t1"), ("a", "y", 2.0, "t2"),
        ("b", "x", 3.0, "t3"), ("b", "y", 4.0, "t3"),
    ]


def test_a_callers_parser_gets_a_bounded_piece_of_a_batch(spark):
    """A batch of many units is handed over piece by piece, whole and in order."""
    import pandas as pd

    frame = pd.DataFrame({"text": ["x" * n for n in (5, 4, 9, 0, 2, 30, 1)], "unit_no": range(7)})
    found = list(tok.pieces(frame, max_chars=10))
    assert pd.concat(found)["unit_no"].tolist() == list(range(7))
    assert max(p["text"].str.len().iloc[:-1].sum() for p in found) <= 10

    texts = spark.createDataFrame([(str(i), "ab cd " * 2000) for i in range(60)], "work_id string, text string")

    def seen(batch):
        total = sum(map(len, batch))
        for _ in batch:
            yield [[{"text": "x", "stop": False, "lemma": str(total), "pos": "X", "tag": "X", "dep": "ROOT", "head": 0}]]

    rows = tok.annotate(tok.text_units(texts).coalesce(1), seen).select("work_id", "sents").collect()
    assert len(rows) == 60
    largest = max(int(r["sents"][0][0]["lemma"]) for r in rows)
    assert largest <= tok.PIECE_CHARS + 12_000
