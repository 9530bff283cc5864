"""Works that are cut inside paragraphs measure as uncut ones."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from checks import bindings as b
from inkmeter.operators import metrics
from inkmeter.operators import tokens as tok

WORDS = "the old man of thou it's don't and Room upon she dog".split()


def prose_of(rng, n, sentence_ends=0.12):
    out = []
    for _ in range(n):
        out.append(rng.choice(WORDS))
        out.append(rng.choices(["", '"', "“", "”", ",", "...", "\n"], [30, 2, 2, 2, 3, 1, 1])[0])
        out.append(rng.choice([". ", "! ", '?" ', ".” "]) if rng.random() < sentence_ends else " ")
    return "".join(out)


def same(one, other):
    assert one.keys() == other.keys()
    for name, value in one.items():
        assert other[name] == pytest.approx(value, abs=1e-12), name


def measured(spark, texts, max_chars):
    docs = spark.createDataFrame([(f"w{i}", t) for i, t in enumerate(texts)], "work_id string, text string")
    rows = metrics.measure_wide(tok.text_view(docs, max_chars=max_chars)).collect()
    return {r.work_id: r.asDict() for r in rows}


def test_a_paragraph_beyond_the_bound_is_cut_and_measures_the_same(spark):
    rng = random.Random(1)
    text = prose_of(rng, 65_000)
    assert len(text) > 300_000 and "\n\n" not in text
    docs = spark.createDataFrame([("w0", text)], "work_id string, text string")
    units = tok.text_units(docs).collect()
    assert len(units) > 3 and all(len(u.text) <= 100_000 for u in units)
    assert "".join(u.text for u in sorted(units, key=lambda u: u.unit_no)) == text
    same(measured(spark, [text], 10_000_000)["w0"], measured(spark, [text], 100_000)["w0"])


@pytest.mark.parametrize("max_chars", [30, 90])
@pytest.mark.parametrize("sentence_ends", [0.0, 0.02, 0.3])
def test_random_texts_measure_the_same_however_cut(spark, max_chars, sentence_ends):
    rng = random.Random(max_chars)
    texts = [prose_of(rng, rng.randint(1, 150), sentence_ends) for _ in range(40)]
    texts += ["\n\n".join(texts[:4]), "a " * 200, '"' + "b " * 100 + '" c.']
    whole, cut = measured(spark, texts, 10_000_000), measured(spark, texts, max_chars)
    for work, row in whole.items():
        same(row, cut[work])


def test_parsed_units_carry_quotations_too(spark):
    rng = random.Random(3)
    texts = [prose_of(rng, 400, 0.3) for _ in range(6)]
    docs = spark.createDataFrame([(f"w{i}", t) for i, t in enumerate(texts)], "work_id string, text string")

    def measure(max_chars):
        parsed = b.rule_parse(tok.text_units(docs, max_chars=max_chars))
        return {r.work_id: r.asDict() for r in metrics.measure_wide(tok.parsed_view(parsed)).collect()}

    whole, cut = measure(10_000_000), measure(300)
    assert len(whole["w0"]) == 65
    for work, row in whole.items():
        same(row, cut[work])


def test_a_document_without_an_id_is_refused(spark):
    docs = spark.createDataFrame([("w", "a"), (None, "b")], "work_id string, text string")
    with pytest.raises(Exception, match="no work_id"):
        tok.text_units(docs).collect()


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_no_text_and_no_token_is_exchanged(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").cast("string").alias("work_id"), "text"
    )
    view = tok.text_view(docs)
    assert "Exchange" not in plan_of(metrics.token_counts(tok.View(view.rows, view.long_rows.limit(0), view.sums, False)).where("n > 0")).split("Union")[0]
    plan = plan_of(metrics.measure_wide(view))
    details = [block for block in plan.split("\n\n") if ") Exchange" in block]
    assert details
    for block in details:
        taken = block.split("Input", 1)[1].split("\n", 1)[0]
        assert "text#" not in taken and "types#" not in taken and "tokens#" not in taken, taken
    by_work = [d for d in details if "token#" not in d]
    assert len(by_work) >= 3
