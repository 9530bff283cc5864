"""Every metric on hand-computed texts."""

import math
import random

import pytest
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.operators import metrics
from inkmeter.operators import tokens as tok
from inkmeter.sources import tables


def measure(spark, texts, max_chars=100_000):
    docs = spark.createDataFrame(list(texts.items()), "work_id string, text string")
    rows = metrics.measure_wide(tok.text_view(docs, max_chars=max_chars)).collect()
    return {r["work_id"]: r.asDict() for r in rows}


def parse(spark, sentences, work_id="w"):
    """Parsed units from sentences given as (text, pos, tag, dep, head, lemma, stop) tuples."""
    sents = [
        [dict(zip(("text", "pos", "tag", "dep", "head", "lemma", "stop"), t)) for t in s]
        for s in sentences
    ]
    return spark.createDataFrame([(work_id, 0, 1, 0, "", sents)], tok.PARSED_COLUMNS)


def word(text, pos="NOUN", tag="NN", dep="dep", head=0, lemma=None, stop=False):
    return (text, pos, tag, dep, head, lemma or text.lower(), stop)


def test_text_series(spark):
    got = measure(
        spark,
        {
            "two": "The cat saw the dog. Thou sawest!",
            "empty": "",
            "one": "Word",
            "hapax": "every word here differs",
            "digits": "Room 101 and abc123 count two words: no, four.",
        },
    )
    two = got["two"]
    assert two["word_count"] == 7
    assert two["mean_word_length"] == pytest.approx(25 / 7)
    # the occurs twice: squares 4 + 5, N 7
    assert two["yules_k"] == pytest.approx(10_000 * (9 - 7) / 49)
    assert two["archaic_word_rate"] == pytest.approx(1 / 7)
    assert two["honore_r"] == pytest.approx(100 * math.log(7) / (1 - 5 / 6))
    assert two["funcword_the"] == pytest.approx(2 / 7)
    assert two["mean_sentence_length"] == pytest.approx(3.5)
    assert two["sentence_length_stdev"] == pytest.approx(1.5)
    assert two["punct_period"] == pytest.approx(1 / 7)
    assert two["punct_exclamation"] == pytest.approx(1 / 7)
    assert set(got["empty"].values()) == {"empty", 0.0}
    assert got["one"]["word_count"] == 1 and got["one"]["honore_r"] == 0
    assert got["one"]["sentence_length_stdev"] == 0
    assert got["hapax"]["honore_r"] == 0 and got["hapax"]["yules_k"] == 0
    # Room and count two words no four
    assert got["digits"]["word_count"] == 7


def test_contractions_and_punctuation(spark):
    got = measure(
        spark,
        {
            "c": "I don't know; they’ll say it's Tom's. We've -- well... (no) — 'tis DON'T",
        },
    )["c"]
    # I do know they say it Tom We well no tis DO, and six clitics
    words = got["word_count"]
    assert words == 12
    assert got["contraction_rate"] == pytest.approx(6 / words)
    assert got["punct_dash"] == pytest.approx(2 / words)
    assert got["punct_ellipsis"] == pytest.approx(1 / words)
    assert got["punct_parenthesis"] == pytest.approx(2 / words)
    assert got["punct_period"] == pytest.approx(1 / words)


def test_dialogue(spark):
    got = measure(
        spark,
        {
            "straight": 'He said "go now" and left',
            "curly": "He said “go now” and left",
            "newline": 'He said "go\nnow and left',
            "paragraph": 'He said "go\n\nnow and left',
            "nested": "“one “two” three” four",
            "none": "nothing said",
        },
    )
    share = {k: v["dialogue_narration_ratio"] for k, v in got.items()}
    assert share["straight"] == pytest.approx(2 / 6)
    assert share["curly"] == pytest.approx(2 / 6)
    assert share["newline"] == share["paragraph"] == pytest.approx(1 / 6)
    assert share["nested"] == pytest.approx(2 / 4)
    assert share["none"] == 0


def test_long_works_match_whole_ones(spark):
    """A work cut into units measures as it does in one piece."""
    paragraph = 'The old man did not say "never" to me. Who knows? '
    text = "\n\n".join(f"{paragraph} Item number{chr(97 + i % 7)} the {i % 5}." for i in range(60))
    whole = measure(spark, {"w": text})["w"]
    cut = measure(spark, {"w": text}, max_chars=300)["w"]
    assert cut.keys() == whole.keys()
    for name, value in whole.items():
        assert cut[name] == pytest.approx(value), name


def test_word_counts_merge_units(spark):
    docs = spark.createDataFrame([("w", "a b\n\nb c\n\nc a"), ("s", "a a")], "work_id string, text string")
    view = tok.text_view(docs, max_chars=6)
    got = {(r.work_id, r.word): r.n for r in metrics.word_counts(view).collect()}
    assert got == {("w", "a"): 2, ("w", "b"): 2, ("w", "c"): 2, ("s", "a"): 2}


@pytest.mark.parametrize(
    ("heads", "depth"),
    [([1, 1, 3, 1, 3], 2), ([0], 0), ([0, 0, 1, 2], 3), ([0, *range(99)], 99), ([5, 5, 5, 5, 5, 5], 1)],
)
def test_tree_depth(spark, heads, depth):
    sentence = [word(f"t{i}", head=h) for i, h in enumerate(heads)]
    rows = tok.parsed_sentences(parse(spark, [sentence])).collect()
    assert [r.depth for r in rows] == [depth]


def test_parsed_series(spark):
    sentences = [
        [word("They", "PRON", head=1), word("ran", "VERB", dep="ROOT", head=1)],
        [
            word("He", "PRON", head=1),
            word("sat", "VERB", dep="ROOT", head=1),
            word("and", "CCONJ", head=1),
            word("ate", "VERB", dep="conj", head=1),
        ],
        [word("Go", "VERB", dep="ROOT", head=0), word("when", "ADV", dep="advcl", head=0)],
        [
            word("Big", "ADJ", head=1),
            word("Tom", "PROPN", dep="ROOT", head=1),
            word("'s", "PART", tag="POS", head=1),
            word("'s", "AUX", tag="VBZ", head=1),
        ],
    ]
    got = metrics.measure_wide(tok.parsed_view(parse(spark, sentences))).first().asDict()
    assert got["word_count"] == 10
    assert got["senttype_simple"] == 0.5
    assert got["senttype_compound"] == got["senttype_complex"] == 0.25
    assert got["adjective_density"] == pytest.approx(0.1)
    assert got["adverb_density"] == pytest.approx(0.1)
    assert got["contraction_rate"] == pytest.approx(0.1)
    assert got["mean_parse_tree_depth"] == 1
    assert len(got) == 65  # 63 series, word_count, work_id


def test_vocabulary(spark):
    sentence = [
        word("Dogs", lemma="Dog"),
        word("dog", lemma="dog"),
        word("the", "DET", stop=True),
        word("be", "VERB", stop=True),
        word("Tom", "PROPN"),
        word("x1", "NOUN"),
    ]
    rows = metrics.vocabulary(parse(spark, [sentence])).collect()
    assert [(r.term, r.term_count) for r in rows] == [("dog", 2)]


def test_registry_extension(spark):
    reg = metrics.builtin_registry()
    reg.register(
        "upon_rate",
        metrics.share(F.col("upons"), F.col("words")),
        token_sums={"upons": metrics.count_of(["upon"])},
    )
    docs = spark.createDataFrame([("w", "upon a time upon")], "work_id string, text string")
    row = metrics.measure_wide(tok.text_view(docs), reg).first()
    assert row.upon_rate == 0.5
    with pytest.raises(ValueError):
        reg.register("upon_rate", F.lit(0.0))


def test_annotate_runs_the_callers_parser(spark):
    def annotator(texts):
        for text in texts:
            yield [
                [dict(text=w, stop=False, lemma=w, pos="NOUN", tag="NN", dep="ROOT", head=0) for w in text.split()]
            ]

    docs = spark.createDataFrame([("w", "one two three")], "work_id string, text string")
    parsed = tok.annotate(tok.text_units(docs), annotator)
    assert metrics.measure_wide(tok.parsed_view(parsed)).first().word_count == 3


def test_sixty_three_series():
    families = len(fixed.FUNCTION_WORDS) + len(fixed.PUNCTUATION_MARKS) + len(fixed.SENTENCE_TYPES)
    single = sum(1 for row in fixed.METRIC_ROWS if not row[7]) - 1  # jaccard has its own fact
    assert families + single == 63


def test_texts_summed_in_their_task_measure_as_the_view_of_them(spark, tmp_path):
    rng = random.Random(3)
    words = (
        "the wolves walked. \" It isn't here! ” “ thou -- ... --- they’ll DON'T upon 12 abc123 a1's ß İ I’M "
        "dog's e\u0301a \u00a0 \u2028 \t 中文 \U0001f600 x\x85y \n \n\n \r\n '' ’s n't ( ) ; — _ ؟ ١ ʰ ª"
    ).split(" ")
    texts = [(f"w{i}", " ".join(rng.choices(words, k=rng.randint(0, 80)))) for i in range(40)]
    texts += [("null", None), ("empty", ""), ("blank", "  "), ("mark", "."), ("twice", "a b."), ("twice", "a c")]
    docs = spark.createDataFrame(texts, "work_id string, text string")
    reg = metrics.builtin_registry(function_words=("the", "wolves"))
    reg.register("long_rate", F.col("long").cast("double"), token_sums={"long": lambda t: F.when(F.length(t["token"]) > 3, t["n"])})
    for max_chars in (60, 100_000):
        plain = tok.text_view(docs, max_chars=max_chars)
        written = tables.stage_table(metrics.summed_text(docs, reg, max_chars=max_chars), f"{tmp_path}/{max_chars}")
        view = tok.spelt_view(written)
        for of in (metrics.word_counts, lambda v: metrics.measure_wide(v, reg)):
            want, got = of(plain), of(view)
            assert got.columns == want.columns and want.count() > 40
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        # What made the time: lambdas over the types of every unit
        plan = metrics.word_counts(view)._jdf.queryExecution().executedPlan().toString()
        assert "lambdafunction" not in plan
