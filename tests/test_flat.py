"""Tokens laid flat give what the expressions over nested arrays give."""

import contextlib
import io
import random

import pyarrow as pa
from pyspark.sql import functions as F

from checks import all_checks, bindings
from inkmeter import fixed_values as fixed
from inkmeter.operators import flat, metrics
from inkmeter.operators import tokens as tok
from inkmeter.sources import tables


def plan_of(df):
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def odd_parse(spark, works=30):
    """Parses with loops, heads outside the sentence, nulls, and empty sentences and units."""
    rng = random.Random(5)

    def token():
        text = rng.choice(["Wolf", "wolf", "İs", "ΟΔΟΣ", "x1", "word\n", "“", "”", '"', "\n", "'s", "’S", "--", "a b"])
        return (
            text, rng.choice([True, False, False, None]), rng.choice(["Lemma", "lemma", "ΣΑΣ", None]),
            rng.choice(["NOUN", "VERB", "AUX", "ADJ", "ADV", None]), rng.choice(["POS", "X", None]),
            rng.choice(["ROOT", "conj", "advcl", "dep", "dep", "dep", None]), rng.choice([None, -1, *range(8), 99]),
        )

    rows = [
        (f"w{i}", 0, 1, 0, "", [[token() for _ in range(rng.randint(0, 9))] for _ in range(rng.randint(0, 5))])
        for i in range(works)
    ]
    return spark.createDataFrame(rows, tok.PARSED_COLUMNS)


def test_plain_spellings_are_not_asked_about_one_by_one(monkeypatch):
    odd = ["", "Wolf", "wolf9", "İs", "ΟΔΟΣ", "word\n", "word\r\n", "é", "a b", "'s", "\n", "²", "ª", "ǅ", "\u0301"]
    plain = [f"W{chr(65 + i % 26)}{chr(97 + i // 26 % 26)}" for i in range(600)]
    values = pa.array(odd + plain, pa.string())
    assert flat.words(values).tolist() == [flat.is_word(v) for v in odd + plain]
    for of in (flat.fold, str.lower):
        assert flat.lowered(values, of).to_pylist() == [of(v) for v in odd + plain]
    asked = []
    is_word = flat.is_word
    monkeypatch.setattr(flat, "is_word", lambda v: asked.append(v) or is_word(v))
    row = (["w"], [0], [1], [0], [""], [[[{"text": t, "lemma": t, "pos": "NOUN"} for t in odd + plain + [None]]]])
    token = pa.struct([(n, {"stop": pa.bool_(), "head": pa.int32()}.get(n, pa.string())) for n in bindings.TOKEN_FIELDS])
    types = [pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.list_(token))]
    names = ["work_id", "unit_no", "units", "entry", "text", "sents"]
    batch = pa.record_batch([pa.array(v, t) for v, t in zip(row, types, strict=True)], names)
    (out,) = tok.described_batches(iter([batch]))
    got = {t["token"]: (t["n"], t["alpha"]) for t in out.column("types").to_pylist()[0]}
    folded = [flat.fold(v) for v in odd + plain]
    assert got == {v: (folded.count(v), is_word(v)) for v in folded}
    assert not set(asked) & set(plain) and len(asked) < 3 * len(odd)


def test_flat_tokens_agree_with_the_expressions_on_odd_parses(spark):
    parsed = odd_parse(spark)
    got = {r.work_id: r for r in tok.describe(parsed).collect()}
    sentences = tok.parsed_sentences(parsed).groupBy("work_id").agg(
        F.sum("depth").alias("depths"), F.sum("words").alias("words"),
        *[F.count_if(F.col("kind") == k).alias(f"kind_{k}") for k in fixed.SENTENCE_TYPES],
    )
    seen = {r.work_id: r for r in sentences.collect()}
    flatten = F.transform(F.flatten("sents"), lambda t: t["text"])
    letters = {r.work_id: r for r in parsed.select("work_id", tok.quote_letters(flatten).alias("letters")).collect()}
    folded = parsed.select("work_id", F.explode(F.transform(flatten, tok.fold_case)).alias("token"))
    types = folded.groupBy("work_id", "token").agg(F.count("*").alias("n")).withColumn("alpha", tok.is_alpha(F.col("token")))
    terms = (
        parsed.select("work_id", F.explode(F.flatten("sents")).alias("t"))
        .filter(tok.is_alpha(F.col("t.text")) & ~F.col("t.stop") & F.col("t.pos").isin(*fixed.CONTENT_POS))
        .groupBy("work_id", F.lower("t.lemma").alias("term")).count().filter("term IS NOT NULL")
    )
    assert len(got) == 30
    for work, row in got.items():
        if work in seen:
            assert (row.depths, sum(row["_words"])) == (seen[work].depths, seen[work].words), work
            assert all(row[f"kind_{k}"] == seen[work][f"kind_{k}"] for k in fixed.SENTENCE_TYPES)
        assert row["_letters"] == letters[work].letters
    assert sorted((w, *t) for w, r in got.items() for t in r.types) == sorted(map(tuple, types.collect()))
    assert sorted((w, *t) for w, r in got.items() for t in r.terms) == sorted(map(tuple, terms.collect()))


def test_a_parse_described_where_it_is_made_measures_as_a_written_one(spark):
    rng = random.Random(7)
    words = "the wolves walked. \" It 'isn''t' here! ” “ more gently\n\n and they'll upon 12 ore ß İ".split(" ")
    texts = [(f"w{i}", " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(20)] + [("null", None)]
    units = tok.text_units(spark.createDataFrame(texts, "work_id string, text string"), max_chars=90)
    parsed, described = bindings.rule_parse(units), bindings.rule_described(units)
    one = metrics.measure_wide(tok.parsed_view(parsed)).collect()
    other = metrics.measure_wide(tok.described_view(described)).collect()
    assert len(one) == 21 and sorted(map(tuple, one)) == sorted(map(tuple, other))
    assert sorted(map(tuple, metrics.vocabulary(parsed).collect())) == sorted(
        map(tuple, metrics.described_vocabulary(described).collect())
    )


def test_terms_are_counted_where_they_are_parsed(spark, monkeypatch, tmp_path):
    rng = random.Random(5)
    words = "the wolves walked. \" It 'isn''t' here! ” “ more gently\n\n and they'll upon 12 ore ß İ".split(" ")
    texts = [(f"w{i}", " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(20)] + [("null", None)]
    units = tok.text_units(spark.createDataFrame(texts, "work_id string, text string"), max_chars=90)
    want = sorted(map(tuple, metrics.vocabulary(bindings.rule_parse(units)).collect()))
    tokens, parser = bindings.rule_tokens(units), bindings.annotated_batches
    kept = []

    def keep(terms):
        kept.append(tables.stage_table(terms, str(tmp_path / "terms")))
        return kept[-1]

    assert want and sorted(map(tuple, metrics.vocabulary(tokens, parser).collect())) == want
    assert sorted(map(tuple, metrics.vocabulary(tokens, parser, keep).collect())) == want
    # A unit's terms are all that is written, and the check does not write the parse either
    assert [k.columns for k in kept] == [["work_id", "units", "terms"]]
    monkeypatch.setattr(bindings, "parsed", None)
    assert all_checks()["vocab_terms"](spark, "/root/testdata/sf0.001").count() > 0


def test_units_added_up_where_they_are_parsed_measure_as_described_ones(spark, monkeypatch):
    rng = random.Random(11)
    words = "the wolves walked. \" It 'isn''t' here! ” “ thou thee -- ; upon\n\n and they'll ... 12 ore ß İ der’s".split(" ")
    texts = [(f"w{i}", " ".join(rng.choices(words, k=rng.randint(0, 60)))) for i in range(20)] + [("null", None)]
    units = tok.text_units(spark.createDataFrame(texts, "work_id string, text string"), max_chars=90)
    described, summed = bindings.rule_described(units), bindings.rule_summed(units)
    one = metrics.measure_wide(tok.described_view(described)).collect()
    other = metrics.measure_wide(tok.summed_view(summed)).collect()
    assert len(one) == 21 and sorted(map(tuple, one)) == sorted(map(tuple, other))
    terms = [sorted(map(tuple, metrics.described_vocabulary(d).collect())) for d in (described, summed)]
    assert terms[0] and terms[0] == terms[1]
    # The types of a work of one unit were read by lambdas, one by one; now they do not leave the task
    assert summed.filter("units = 1 AND size(types) > 0").count() == 0
    assert summed.filter("units > 1 AND size(types) > 0").count() > 0
    monkeypatch.setattr(metrics, "unit_sums", None)
    assert metrics.measure_wide(tok.summed_view(summed)).count() == 21


def test_odd_parses_are_added_up_alike_and_a_sum_of_ones_own_is_kept(spark):
    parsed = odd_parse(spark)
    reg = metrics.builtin_registry(function_words=("wolf", "a b"))
    reg.register("long_rate", F.col("long").cast("double"), token_sums={"long": lambda t: F.when(F.length(t["token"]) > 3, t["n"])})
    one = metrics.measure_wide(tok.parsed_view(parsed), reg).collect()
    other = metrics.measure_wide(tok.summed_view(metrics.summed(parsed, registry=reg)), reg).collect()
    assert sum(r.long_rate for r in one) > 0 and sorted(map(tuple, one)) == sorted(map(tuple, other))


def test_no_token_meets_a_lambda_and_no_term_a_join(spark):
    """What made the build's time: expressions over nested tokens, and a join of every term."""
    parsed = odd_parse(spark)
    assert "lambdafunction" not in plan_of(metrics.vocabulary(parsed))
    loaded = spark.createDataFrame([(f"w{i}", i) for i in range(30)], "work_id string, loaded_at int")
    terms = metrics.described_vocabulary(tok.describe(parsed), loaded)
    assert terms.columns == ["work_id", "term", "term_count", "loaded_at"]
    short = plan_of(terms.filter("term_count > 0")).split("Generate", 2)
    assert "Join" not in short[0] and "Join" in short[1]


def test_pieces_are_bounded_and_whole():
    import pyarrow as pa

    sents = [[["a"] * n] for n in (5, 4, 9, 0, 2, 30, 1)]
    batch = pa.RecordBatch.from_arrays([pa.array(sents), pa.array(range(7))], names=["sents", "n"])
    found = [p.column("n").to_pylist() for p in flat.pieces(iter([batch]), "sents", most=10)]
    assert sum(found, []) == list(range(7))
    assert max(sum(len(sents[n][0]) for n in f[:-1]) for f in found) <= 10


def test_words_are_those_of_the_pattern(spark):
    texts = ["", "a", "é", "ß1", "a\n", "a\r\n", "a\n\n", "\n", "a ", "a\x85", "ʰ", "١", "中", "a b", "é", "ª"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", tok.is_alpha(F.col("t")), tok.fold_case(F.col("t")))
    assert [(r[0], flat.is_word(r[0]), flat.fold(r[0])) for r in rows.collect()] == [tuple(r) for r in rows.collect()]
