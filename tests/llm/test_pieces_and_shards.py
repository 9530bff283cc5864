"""Token ids against the library, shards, and the pipeline against its parts."""

import random

import pytest
from pyspark.sql import functions as F

from inkmeter.llm import sentence, sharding
from inkmeter.llm.queries import QUERIES, SQL, piece_file

TEXTS = [
    None, "", " ", "  a  b ", "\n\t x▁y", "😀 日本語 text", "a" * 300, "x=1;\n\n\n  y  = 2", "\x00\x01",
    "https://example.com/a?b=c&d=%20", "the" * 500, "Ünïcödé Straße", "again", "again",
]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file())


def test_ids_equal_the_library(spark, library):
    rng = random.Random(1)
    pieces = [library.id_to_piece(rng.randrange(300, 31000)) for _ in range(4000)]
    texts = TEXTS + ["".join(pieces[i : i + 12]).replace("▁", " ") for i in range(0, 3600, 12)]
    rows = [(i if i % 7 else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_ids string")
    got = sentence.with_ids(df, piece_file(), check=True)
    found = got.collect()
    assert got.columns == ["doc_id", "text", "n_ids", "ids", "round_trip"]
    assert len(found) == len(rows)
    for r in found:
        assert r.ids == library.encode(r.text or "")
        assert r.n_ids == len(r.ids) and r.round_trip
    back = sentence.decoded(got.select(F.col("text").alias("k"), "ids"), piece_file(), key="k")
    assert all(r.text == (r.k or "").replace("▁", " ") for r in back.collect())
    assert sentence.with_ids(df.limit(0), piece_file()).count() == 0


def test_units_of_different_lengths_advance_together(library, monkeypatch):
    calls = []
    plain = sentence.encode_sorted

    def counted(v, points, lengths, borders):
        calls.append(points.shape)
        return plain(v, points, lengths, borders)

    monkeypatch.setattr(sentence, "encode_sorted", counted)
    rng = random.Random(4)
    words = ["".join(rng.choices("abcdeé日 ", k=n)).replace(" ", "x") for n in range(1, 60)]
    encoder = sentence.Encoder(sentence.load(piece_file()))
    for text in (" ".join(words), " ".join(words[::-1]), "a " + "b" * 63):
        ids, sizes = encoder.encode([text, None])
        assert ids.tolist() == library.encode(text) and sizes.tolist() == [len(ids), 0]
    # The words of all lengths take one call; before, each length took its own
    assert len(calls) <= 3 and calls[0][0] >= 59


def test_endless_units_and_ids_that_are_no_text(spark, library):
    rng = random.Random(2)
    signs = [chr(rng.randrange(0x4E00, 0x9000)) for _ in range(3000)]
    code = "".join(rng.choices("ABCDEFabcdef0123456789+/", k=20000))
    texts = ["".join(rng.choices(signs, k=60000)), code, "é" * 4000, "\U0001f600" * 3000 + "a b"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in sentence.with_ids(df, piece_file(), check=True).collect():
        assert r.ids == library.encode(r.text) and r.round_trip
    lists = [[], None, [200], [200, 131, 300, 3 + 0xE2, 3 + 0x96], [3 + 0xF0, 3 + 0x9F, 5000], [library.piece_to_id("▁")]]
    df = spark.createDataFrame(list(enumerate(lists)), "doc_id long, ids array<int>")
    back = {r.doc_id: r.text for r in sentence.decoded(df, piece_file()).collect()}
    assert back[1] is None and back[0] == back[5] == ""
    for i in (2, 3, 4):
        assert back[i] == library.decode(lists[i])


def test_table_fills_in_turns():
    names = [f"n{i}" for i in range(7)]
    table = sharding.fill_table(names, 251)
    sizes = [table.count(i) for i in range(7)]
    assert sum(sizes) == 251 and max(sizes) - min(sizes) <= 1
    again = sharding.fill_table(names[::-1], 251)
    assert [names[i] for i in table] == [names[::-1][i] for i in again]
    fewer = sharding.fill_table(names[:-1], 251)
    moved = sum(a != b for a, b in zip(table, fewer, strict=True) if a != 6)
    assert moved < 251 * 0.25
    half = sharding.fill_table(["a", "b"], 251, [1.0, 0.5])
    assert abs(half.count(0) - 2 * half.count(1)) <= 2
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill_table(bad, 251)
    with pytest.raises(ValueError):
        sharding.fill_table(["a"], 250)


def test_rows_of_a_key_share_a_shard(spark, tmp_path):
    rows = [(f"k{i % 50}", i, "clash") for i in range(500)] + [(None, i, "n") for i in range(300)]
    df = spark.createDataFrame(rows, "key string, value long, shard string")
    placed = sharding.place(df, "key", shards=["a", "b", "c", "d"], size=1009)
    got = placed.collect()
    assert len(got) == len(rows) and placed.columns == ["key", "value", "slot", "shard"]
    shards = {}
    for r in got:
        if r["key"] is not None:
            assert shards.setdefault(r["key"], r["shard"]) == r["shard"]
    assert len({r["shard"] for r in got if r["key"] is None}) == 4
    sharding.write_shards(placed, str(tmp_path / "out"), 2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert sharding.place(df.limit(0), "key").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = docs
    for name, step in corpus_pipeline.STAGES[:-1]:
        before, kept = kept, step(spark, kept, folder)
        assert kept.columns == docs.columns, name
        if "mixing" not in name:
            assert kept.join(before, ["doc_id", "text"], "left_anti").count() == 0
            assert kept.count() == kept.select("doc_id").distinct().count()
        kept = kept.cache()
    out = corpus_pipeline.run(spark, folder)
    assert sorted(r.doc_id for r in out.select("doc_id").collect()) == sorted(
        r.doc_id for r in kept.select("doc_id").collect()
    )
    assert out.where("NOT round_trip").count() == 0


def test_exact_dedup_agrees_with_its_sql(spark):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    name = "op1_exact_dedup"
    want = con.execute(SQL[name]).fetchall()
    frame = QUERIES[name](spark, folder).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )
    assert sorted(tuple(r) for r in frame.collect()) == sorted(want)
