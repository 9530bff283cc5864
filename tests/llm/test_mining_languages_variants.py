"""Hard negatives, language identification and spelling variants against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkmeter.llm import langid, mining, queries, variants

# --- hard negatives ----------------------------------------------------------


def vectors():
    rng = np.random.default_rng(5)
    rows = []
    for i in range(240):
        centre = np.zeros(6)
        centre[i % 3] = 1.0
        rows.append((i, int(i % 4), [float(x) for x in centre + rng.normal(0, 0.3, 6)], "clash"))
    same = [1.0, 0.5, 0.25, 0.0, 0.0, 0.0]
    rows += [(1000 + i, i % 2, same, "copy") for i in range(60)]
    rows += [
        (2000, None, same, "x"), (2100, 1, None, "x"), (2200, 1, [1.0, None], "x"),
        (2300, 1, [float("nan")] * 6, "x"), (2400, 1, [float("inf")] * 6, "x"),
        (2500, 1, [], "x"), (2600, 2, [0.0] * 6, "x"), (2700, 2, [-1.0, 0.5], "short"),
        (None, 3, same, "x"), (2800, 2, [1e5] * 6, "x"), (2800, 2, [1e5] * 6, "x"),
        (2900, 7, same, "alone"), (3000, 1, [1e30] * 6, "x"), (3100, 1, [3e6, -3e6], "large"),
    ]
    return rows


VECTORS = "vec_id long, label int, embedding array<double>, score string"


def brute_negatives(rows):
    whole = []
    for k, (i, label, v, _) in enumerate(rows):
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * x) for x in v]
        if sum(x * x for x in q) < 2**62:
            whole.append((k, i, label, q))

    def order(item):
        return (-item[0], item[1] is None, item[1] or 0, item[2])

    out = []
    for k, i, label, q in whole:
        if i is None or i % 100:
            continue
        scored = [
            (sum(a * b for a, b in zip(q, o)), oi, ok, ol)
            for ok, oi, ol, o in whole if ok != k
        ]
        alike = sorted((s for s in scored if s[3] == label), key=order)[:5]
        for p, pid, *_ in alike:
            fits = [s for s in scored if s[3] != label and 30 * p <= 100 * s[0] <= 90 * p]
            for rank, (n, nid, *_) in enumerate(sorted(fits, key=order)[:10], 1):
                out.append((i, pid, rank, nid, p, n))
    return Counter(out)


@pytest.mark.parametrize("block_values", [mining.BLOCK_VALUES, 150])
def test_hard_negatives_match_brute_force(spark, monkeypatch, block_values):
    monkeypatch.setattr(mining, "BLOCK_VALUES", block_values)
    df = spark.createDataFrame(vectors(), VECTORS)
    got = mining.hard_negatives(df, F.col("vec_id") % 100 == 0)
    assert got.columns == [
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    ]
    assert Counter(map(tuple, got.collect())) == brute_negatives(vectors())


def test_bounds_hold_every_score():
    rng = np.random.default_rng(1)
    q = rng.integers(-300, 300, (400, 16))
    q[:40] = q[40] * rng.integers(1, 5, 40)[:, None]  # parallel rows: angles of nearly 0
    q[100:110] = -q[40]
    angles = np.arccos(
        np.clip(q @ q[:8].T / np.outer(np.linalg.norm(q, axis=1), np.linalg.norm(q[:8], axis=1)),
                -1, 1)
    )
    rows = pa.table(
        {
            "row": np.arange(400), "id": np.arange(400), "label": ["a"] * 400,
            "q": q.tolist(), "angles": angles.tolist(),
        }
    )
    block = mining.Block(rows, 16)
    pruned = 0
    for k in (0, 41, 105, 300):
        low, high = block.bounds(mining.Anchor(k, "a", q[k], angles[k]), slice(None))
        scores = q @ q[k]
        assert (low <= scores).all() and (scores <= high).all()
        pruned += (high < scores.max()).sum()
    assert pruned > 100


def test_hard_negatives_of_an_empty_table(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mining.hard_negatives(empty, F.col("vec_id") % 100 == 0).collect() == []


def test_hard_negatives_query_runs(spark):
    got = queries.op11_hard_negatives(spark, "/root/testdata/sf0.001")
    assert got.where("100 * negative_score > 90 * positive_score").isEmpty()
    assert got.agg(F.max("rank")).first()[0] == 10


# --- languages ---------------------------------------------------------------

SYLLABLES = {
    "aa": "the and ing ion ent her for tha",
    "bb": "ein und der sch ich che ung gen",
    "cc": "que les ent ais ait eux tre des",
}


def text_of(rng, lang, words):
    made = SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(made) for _ in range(rng.randint(1, 3))) for _ in range(words))


def labelled(n=90):
    rng = random.Random(3)
    return [(i, text_of(rng, "aabbcc"[2 * (i % 3):][:2], 30), "aabbcc"[2 * (i % 3):][:2], "src") for i in range(n)]


DOCS = "doc_id long, text string, lang string, score string"


def brute_length(texts, text):
    """Code length of a text, byte by byte, from dictionaries of the training texts."""
    seen = [defaultdict(Counter) for _ in range(5)]
    fold = bytes.lower
    for t in texts:
        b = [256] * 4 + list(fold(t.encode()))
        for i in range(4, len(b)):
            for k in range(5):
                seen[k][tuple(b[i - k : i])][b[i]] += 1
    total = 0.0
    b = [256] * 4 + list(fold(text.encode()))
    for i in range(4, len(b)):
        out, p = set(), 1.0
        for k in range(4, -1, -1):
            counts = seen[k].get(tuple(b[i - k : i]))
            if not counts:
                continue
            left = {s: n for s, n in counts.items() if s not in out}
            whole = sum(left.values()) + len(left)
            if b[i] in left:
                p *= left[b[i]] / whole
                break
            if left:
                p *= len(left) / whole
            out |= set(counts)
        else:
            p /= 256 - len(out)
        total -= math.log(p)
    return total


def test_code_lengths_match_brute_force(spark):
    rows = labelled(12)
    df = spark.createDataFrame(rows, DOCS)
    trees = langid.fit(df)
    rng = random.Random(9)
    asked = [text_of(rng, "aa", 6), "zzz qqq", "T", "é一 Wörter", "", rows[0][1], "the" * 50]
    names = sorted(trees)
    got = langid.lengths_of(pa.array(asked), [trees[n] for n in names])
    for k, text in enumerate(asked):
        for j, name in enumerate(names):
            want = brute_length([t for _, t, lang, _ in rows if lang == name], text)
            assert got[k, j] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_slices_do_not_matter(spark, monkeypatch):
    trees = langid.fit(spark.createDataFrame(labelled(30), DOCS))
    texts = pa.array(["", "the and", None, "einund " * 40, "x", "", "que les " * 9])
    whole = langid.lengths_of(texts, list(trees.values()))
    monkeypatch.setattr(langid, "SLICE", 7)
    assert np.allclose(langid.lengths_of(texts, list(trees.values())), whole)


def test_languages_of_hostile_rows(spark):
    rng = random.Random(4)
    rows = labelled(150) + [
        (1000, None, "aa", "s"), (1001, "", "bb", "s"), (1002, "123 456 ٣", "cc", "s"),
        (1003, "the and ing", None, "s"), (None, "der und ich", "bb", "s"),
        (1004, text_of(rng, "cc", 60000), "cc", "s"), (1004, "que les", "cc", "s"),
        (1004, "que les", "cc", "s"),
    ]
    got = langid.identify(spark.createDataFrame(rows, DOCS)).collect()
    assert len(got) == len(rows)
    held = {i: zlib.crc32(str(i).encode()) % 5 == 0 for i, *_ in rows if i is not None}
    assert all(r.held_out == held.get(r.doc_id, True) for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    found = defaultdict(list)
    for r in got:
        found[r.doc_id].append(r.lang_pred)
    assert [found[i] for i in (1000, 1001, 1002)] == [["und"]] * 3
    assert found[1003] == ["aa"] and found[None] == ["bb"] and found[1004] == ["cc"] * 3
    right = [found[i] == [lang] for i, _, lang, _ in labelled(150) if held[i]]
    assert len(right) > 15 and all(right)


def test_prediction_ignores_labels_of_held_out_rows(spark):
    rows = labelled(60)
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    lied = [(i, t, "aa" if r in held else lang, s) for r in rows for i, t, lang, s in [r]]
    one = langid.identify(spark.createDataFrame(rows, DOCS)).orderBy("doc_id").collect()
    two = langid.identify(spark.createDataFrame(lied, DOCS)).orderBy("doc_id").collect()
    assert one == two


def test_fewer_nodes_drop_rare_counts_only(spark):
    df = spark.createDataFrame(labelled(60), DOCS)
    small = langid.fit(df, most_nodes=400)
    assert 0 < sum(len(k) for t in small.values() for k in t.keys) <= 400
    got = langid.predict(df, small).join(df.select("doc_id", "lang"), "doc_id")
    assert got.where("lang_pred <> lang").isEmpty()


def test_sample_is_bounded_a_language(spark):
    df = spark.createDataFrame(labelled(90), DOCS)
    assert {r["count"] for r in langid.sample(df, rows=7).groupBy("lang").count().collect()} == {7}


def test_languages_without_anything_to_learn(spark):
    none = spark.createDataFrame([(1, "the", None, "s"), (2, "und", None, "s")], DOCS)
    assert {(r.lang_pred, r.score) for r in langid.identify(none).collect()} == {("und", 0.0)}
    assert langid.identify(none.limit(0)).collect() == []


def test_language_query_is_right_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = queries.op12_language_id(spark, "/root/testdata/sf0.001")
    both = got.join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    assert both.where("lang = lang_pred").count() >= 0.95 * both.count()


# --- variants ----------------------------------------------------------------

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows):
    counts = Counter()
    for i, text, *_ in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    near = {w: [o for o in words if o != w and one_edit(w, o)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {
        (w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words
    }


def wordy():
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(120)]
    rows = []
    for i in range(150):
        words = [rng.choice(stems[: 1 + int(rng.expovariate(0.05)) % 120]) for _ in range(60)]
        rows.append((i, " ".join(words), "clash", 1))
    chain = "elephant " * 900 + "elephent " * 80 + "elephen " * 7 + "lephent " * 2
    rows += [
        (500, None, "n", 1), (501, "", "w", 1), (None, "Elephant×x elephants", "w", 1),
        (502, chain, "w", 1), (503, "x" * 70000 + " " + "y" * 70000, "w", 1),
        (503, "x" * 70000 + " " + "y" * 69999, "w", 1), (504, "abcdefg1abcdefg", "w", 1),
        (504, "abcdefg1abcdefg", "w", 1), (505, "ÀÉÎ àéî " + "ÀÉÎÀÉÎÀÉÎ " * 3, "w", 1),
        (506, "x" * 70000, "w", 1),
    ]
    return rows


WORDY = "doc_id long, text string, word string, n int"


@pytest.mark.parametrize(("held", "long"), [(variants.HELD, variants.LONG), (5, 10)])
def test_variants_match_brute_force(spark, monkeypatch, held, long):
    monkeypatch.setattr(variants, "HELD", held)
    monkeypatch.setattr(variants, "LONG", long)
    got = variants.spelling_variants(spark.createDataFrame(wordy(), WORDY))
    found = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()]
    want = brute_variants(wordy())
    assert len(found) == len(set(found)) and set(found) == want
    assert sum(f is not None for _, f, *_ in want) > 5
    assert any(r not in (w, f) for w, f, r, *_ in want)  # chains of two and more


def test_variants_of_an_empty_table(spark):
    assert variants.spelling_variants(spark.createDataFrame([], WORDY)).collect() == []


def test_variant_query_matches_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = queries.op13_spelling_variants(spark, "/root/testdata/sf0.001")
    found = {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in got.collect()}
    words = [w for w, *_ in found]
    shown = Counter()
    for w in words:  # every deletion neighbourhood, to spare the brute force its pairs
        shown.update({w} | {w[:k] + w[k + 1 :] for k in range(len(w))})
    assert found and brute_counts(rows) == {(w, n) for w, _, _, n, *_ in found}
    alone = {w for w in words if all(
        shown[v] == 1 for v in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))})}
    assert all(near == 0 for w, _, _, _, near, _ in found if w in alone)


def brute_counts(rows):
    counts = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{i}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {(w, n) for w, n in counts.items() if len(w) >= 7 and n >= 2}
