"""Exact and near dedup and passages, against brute force on hostile rows."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkmeter.llm import exact, near, substring
from inkmeter.llm.components import components

SCHEMA = "doc_id long, text string, kept string, source string"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")
BASE = " ".join(f"w{i}" for i in range(120))


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def edited(n):
    words = BASE.split()
    for i in range(n):
        words[(i * 37 + 11) % len(words)] = f"x{i}n{n}"
    return " ".join(words)


def rows():
    texts = [
        None, "", "  \n", "One", "one", "ÉA b c d e f", "Éa B c d e f", "éa b c d e f",
        BASE, BASE.upper(), *[edited(n) for n in range(1, 8)],
        "a " * 100, "b c " * 40, "long " + "tail " * 30000, BASE + " " + "other words " * 3,
    ]
    out = [(i, t, "clash", "s") for i, t in enumerate(texts)]
    return out + [(3, "One", "again", "s"), (3, "One", "again", "s"), (None, "One", "n", None)] + [
        (200 + i, BASE, "copy", "hot") for i in range(40)
    ]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def test_exact_marks_every_row(docs):
    got = exact.mark_exact(docs).collect()
    groups = {}
    for i, t, *_ in rows():
        groups.setdefault(fold(t), []).append(i)
    keep = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter(
        (i, keep[fold(t)], len(groups[fold(t)]), hashlib.sha256(fold(t).encode()).hexdigest())
        for i, t, *_ in rows()
    )
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_keeps_one_row_of_each_text(docs):
    kept = exact.keep_exact(docs)
    assert kept.columns == docs.columns
    assert sorted(fold(r.text) for r in kept.collect()) == sorted({fold(t) for _, t, *_ in rows()})


def test_exact_with_a_full_filter_stays_right(docs):
    small = exact.mark_exact(docs, max_bits=1024).groupBy("kept").count().collect()
    assert {r["kept"]: r["count"] for r in small} == {
        r["kept"]: r["count"] for r in exact.mark_exact(docs).groupBy("kept").count().collect()
    }


def shingles(text):
    w = WORDS.findall(fold(text))
    if len(w) >= 5:
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
    return {tuple(w)} if w else set()


def brute_components(table):
    sets = [(i, shingles(t)) for i, t, *_ in table]
    label = list(range(len(sets)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                label[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return Counter(
        (i, len(s), least.get(find(x)) if s else i) for x, (i, s) in enumerate(sets)
    )


def test_near_equals_brute_force(docs):
    got = near.mark_near(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows())
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_keeps_one_of_each_group(docs):
    kept = near.keep_near(docs)
    assert kept.columns == docs.columns
    ids = {i for i, _, c in brute_components(rows()) if i == c}
    assert {r.doc_id for r in kept.collect()} == ids


def test_near_in_small_blocks(docs, monkeypatch):
    monkeypatch.setattr(near, "BLOCK_NODES", 3)
    got = near.mark_near(docs).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_components(rows())


def test_components_of_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 50)]
    got = components(spark.createDataFrame(chain + star + [(7, 7)], "a long, b long")).collect()
    assert {(r.node, r.root) for r in got} == {(i, 0) for i in range(41)} | {
        (100 + i, 100) for i in range(50)
    }


def brute_removed(table, window):
    words = [WORDS.findall(t or "") for _, t, *_ in table]
    count = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = Counter()
    for (i, *_), w in zip(table, words, strict=True):
        keep = [True] * len(w)
        for a in range(len(w) - window + 1):
            if count[tuple(w[a : a + window])] > 1:
                keep[a : a + window] = [False] * window
        kept = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        out[i, len(w), len(w) - sum(keep), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("hot_places", [substring.HOT_PLACES, 2])
def test_removed_passages_equal_brute_force(docs, hot_places):
    got = substring.remove_repeats(docs, hot_places=hot_places).collect()
    assert Counter(tuple(r) for r in got) == brute_removed(rows(), 35)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact.mark_exact(empty).count() == 0
    assert exact.keep_exact(empty).count() == 0
    assert near.mark_near(empty).count() == 0
    assert near.keep_near(empty).count() == 0
    assert substring.remove_repeats(empty).count() == 0


def test_kept_text_is_returned_on_request(spark):
    df = spark.createDataFrame([(1, "x  y\n" + BASE), (2, BASE + "\tz")], "doc_id long, text string")
    got = substring.remove_repeats(df, texts=True).orderBy("doc_id").select("kept_text").collect()
    assert [r.kept_text for r in got] == ["x y", "z"]
    assert df.select(F.max("doc_id")).first()[0] == 2


def thue_morse(n, signs="ab"):
    word, other = signs[0], signs[1]
    for _ in range(n):
        word, other = word + other, other + word
    return word, other


def test_words_that_collide_under_any_polynomial_stay_apart(spark):
    first, second = thue_morse(10)
    shared = [f"w{i}" for i in range(17)]
    texts = [" ".join([*shared, x, *shared]) for x in (first, second)]
    rows = [(1, texts[0], "", ""), (2, texts[1], "", ""), (3, first, "", ""), (4, second, "", "")]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r.component_id for r in near.mark_near(docs).collect()}
    assert got[3] == 3 and got[4] == 4
    removed = substring.remove_repeats(docs).select("n_removed").distinct().collect()
    assert [r[0] for r in removed] == [0]
