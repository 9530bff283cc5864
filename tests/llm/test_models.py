"""Fingerprints, language model, mixture, classifier and personal data on small fixtures."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from inkmeter.llm import imatch, importance, mixture, pii, ppm

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = [
    None, "", " \n", "The cat sat on the mat", "the Cat sat on the mat", "a b a b a c",
    "Übung macht 😀 den Meister", "word " * 3000, "the cat ran", "x" * 5000, "the cat sat on the mat",
]
SCHEMA = "doc_id long, text string, source string, score double"


def table():
    out = [(i, t, f"s{i % 3}" if i % 4 else None, 1.0) for i, t in enumerate(TEXTS)]
    return out + [(4, TEXTS[4], "s1", 1.0), (None, "the cat", None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(table(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_fingerprints_of_texts_and_edits(docs, empty):
    got = imatch.fingerprint_edits(docs).collect()
    order = sorted(
        table(), key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or "")
    )
    texts = [r[1] or "" for r in order]
    following = texts[1:] + texts[:1]
    edits = [a[: len(a) - len(a) // 2] + b[: len(a) // 2] for a, b in zip(texts, following, strict=True)]
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == Counter(
        (o[0], len(t), hashlib.sha256(e.encode()).hexdigest())
        for o, t, e in zip(order, texts, edits, strict=True)
    )
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[3] == prints[4] == prints[10] != prints[8]
    assert prints[0] == prints[1]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.fingerprint_edits(empty).count() == 0


def chained(values, seed=42):
    for x in values:
        seed = xxhash.xxh64_intdigest(x, seed=seed)
    return seed


def brute_prints(texts, common, rare):
    """Fingerprints by sets: the band, the lexicons, one hash a lexicon."""
    words = [{w.lower() for w in WORDS.findall(t)} for t in texts]
    often = Counter(w for ws in words for w in ws)
    least, most = math.ceil(rare * len(texts)), max(1, math.floor(common * len(texts)))
    kept = {w for w, n in often.items() if least <= n <= most}

    def signed(h):
        return h - (1 << 64) if h >> 63 else h

    def one(text):
        found = {w.lower() for w in WORDS.findall(text)}
        found = (found & kept) or found
        used = sorted(signed(chained([w.encode()])) for w in found)
        used = used or [signed(chained([text.encode(), b"no words"]))]
        used = [struct.pack("<q", t) for t in used]
        out = []
        for i, bits in enumerate(imatch.LEXICON_BITS):
            seed = struct.pack("<i", imatch.SEED + i)
            held = [t for t in used if chained([t, seed]) % (1 << bits) == 0]
            whole = struct.pack("<Q", chained(used))
            out.append(chained(held) if held else chained([whole, struct.pack("<i", i)]))
        return "".join(f"{h:016X}" for h in out)

    return one


@pytest.mark.parametrize("most_terms", [1 << 17, 3])
def test_fingerprints_equal_brute_force(spark, most_terms):
    rng = random.Random(4)
    base = [" ".join(f"w{int(rng.paretovariate(0.4)) % 900}" for _ in range(60)) for _ in range(80)]
    texts = base + [base[0], base[1] + " another", "", " \n", "  ", "w1 w2"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = imatch.fingerprint_edits(df, common=0.2, rare=0.02, most_terms=most_terms).collect()
    one = brute_prints(texts, 0.2, 0.02)
    assert len(got) == len(texts)

    def alike(a, b):
        return sum(a[i : i + 16] == b[i : i + 16] for i in range(0, len(a), 16)) / (len(a) / 16)

    for r in got:
        text, following = texts[r.doc_id], texts[r.doc_id - 1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert r.fingerprint == one(text) and r.edited_fingerprint == one(edited)
        assert r.near_edited == pytest.approx(alike(one(text), one(edited)))
        assert r.near_next == pytest.approx(alike(one(text), one(following)))
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[0] == prints[80] and alike(prints[1], prints[81]) > 0.5


def test_ranges_find_every_neighbour(spark):
    df = spark.createDataFrame([(i * i, str(i)) for i in range(200)], "doc_id long, text string")
    for ranges in (2, 7, 64):
        rows = imatch.with_next(df, "doc_id", "text", ranges).collect()
        own = [r for r in rows if not r.ghost]
        assert len(own) == 200
        parts = {r.part for r in own}
        assert len(rows) == 200 + len(parts)


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_ppm(training, order):
    counts = [defaultdict(Counter) for _ in range(order + 1)]

    def symbols(text):
        return [257] * order + list(" ".join(WORDS.findall(fold(text))).encode()) + [256]

    for text in training:
        s = symbols(text)
        for k in range(order, len(s)):
            for d in range(order + 1):
                counts[d][tuple(s[k - d : k])][s[k]] += 1

    def share(context, symbol):
        gone, p = set(), 1.0
        for d in range(order, -1, -1):
            full = counts[d].get(tuple(context[order - d :]), {})
            if not full:
                continue
            left = {s: n for s, n in full.items() if s not in gone}
            held = sum(left.values())
            escape = len(full) - len(gone)
            if not held + escape:
                continue
            if symbol in left:
                return p * left[symbol] / (held + escape)
            if escape:
                p *= escape / (held + escape)
            gone |= set(left)
        return p / max(1, 257 - len(gone))

    def score(text):
        s = symbols(text)
        return sum(math.log10(share(s[k - order : k], s[k])) for k in range(order, len(s)))

    return score, share


@pytest.mark.parametrize("most_keys", [60, 1 << 22])
def test_scores_equal_brute_force(docs, empty, most_keys):
    got = ppm.score(docs, most_keys=most_keys, most_head=4).collect()
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, *_ in table()}
    training = [t for i, t, *_ in table() if not held[i]]
    score, share = brute_ppm(training, ppm.ORDER)
    c = Counter(w for t in training for w in WORDS.findall(fold(t)))
    c["</end>"] = len(training)
    n, v = sum(c.values()), len(c)
    want = {}
    for i, t, *_ in table():
        tokens = WORDS.findall(fold(t)) + ["</end>"]
        base = sum(math.log10((c[x] + 1) / (n + v + 1)) for x in tokens)
        want[i] = (held[i], len(tokens), sum(x in c for x in tokens), n, base, score(t))
    assert len(got) == len(table())
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert r.base_score == pytest.approx(w[4], rel=1e-9)
        assert r.score == pytest.approx(w[5], rel=1e-9)
    for context in ((257,) * ppm.ORDER, (32, 116, 104, 101, 32)):
        assert sum(share(list(context), s) for s in range(257)) == pytest.approx(1)
    assert ppm.score(empty).count() == 0


@pytest.mark.parametrize("most_keys", [1, 1 << 21])
def test_rare_contexts_are_known_in_a_large_corpus(spark, most_keys):
    """One occurrence in more than 4,194,304 training symbols counts, on either way to its share."""
    held = [zlib.crc32(str(i).encode()) % 7 == 2 for i in range(100)]
    taught, asked = held.index(False, 60), held.index(True, 60)
    rows = [(i, "tick " * 20000) for i in range(60)] + [(taught, "quack zebra"), (asked, "Quack zebra")]
    # The long texts share with the short ones the beginning only
    short = ["tick tick" if i < 60 else t for i, t in rows if not held[i]]
    score, _ = brute_ppm(short, ppm.ORDER)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in ppm.score(df, most_keys=most_keys).collect()}
    assert got[asked] == got[taught] == pytest.approx(score("quack zebra"), rel=1e-9)


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * left / total > 2 * sizes[s]}
        if not over:
            return target | {s: weight[s] * left / total for s in open_}
        for s in over:
            target[s] = 2.0 * sizes[s]
        left -= sum(target[s] for s in over)
        open_ -= over


def test_mix_meets_targets_and_repeats(spark, empty):
    rows = [(i, " ".join(["w"] * (i * i % 37)), f"s{i % 5}" if i % 9 else None) for i in range(400)]
    rows += [(1000 + i, "hot hot hot", "s0") for i in range(400)] + [(6000, "same row", "s1")] * 5
    rows += [(5000, None, "nothing"), (5001, "", "nothing")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixture.mark_mix(df).collect()
    assert Counter(tuple(r) for r in got) == Counter(tuple(r) for r in mixture.mark_mix(df).collect())
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    target = brute_targets(sizes)
    source = {i: s for i, _, s in rows}
    taken = Counter()
    for r in got:
        assert r.taken % r.size == 0 if r.size else r.taken == 0
        assert r.taken <= 2 * r.size
        assert r.source_size == sizes[source[r.doc_id]]
        assert r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert len(got) == len(rows)
    for s, t in target.items():
        assert t - 2 <= taken[s] <= t
    out = mixture.take_mix(df)
    assert out.columns == df.columns
    assert sum(len(r.text.split()) for r in out.collect()) == sum(taken.values())
    assert mixture.mark_mix(empty).count() == 0
    assert mixture.take_mix(empty).count() == 0


def test_fit_is_as_full_as_can_be():
    for seed in range(30):
        rng = np.random.default_rng(seed)
        lengths = rng.choice(np.arange(1, 60), 6, replace=False)
        counts = rng.integers(1, 5, 6)
        budget = int(rng.integers(0, (lengths * counts).sum() + 1))
        reach = {0}
        for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
            reach = {r + k * length for r in reach for k in range(count + 1)}
        got = mixture.fit(lengths, counts, budget)
        assert (got <= counts).all() and (got >= 0).all()
        filled = int((got * lengths).sum())
        assert filled <= budget
        # Only the last part of the budget is fitted exactly
        assert max(r for r in reach if r <= budget) - filled <= 5


def test_importance_rejects_junk_and_keeps_clean(spark):
    rng = np.random.default_rng(0)
    clean = [" ".join(rng.choice(["alpha", "beta", "gamma", "delta"], 40)) for _ in range(300)]
    junk = [" ".join(w + "***" for w in rng.choice(["alpha", "beta", "zeta"], 40)) for _ in range(100)]
    rows = [(i, t, "x") for i, t in enumerate(clean + junk)] + [(None, None, "x"), (9, clean[9], "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, noise string")
    labels = spark.createDataFrame(
        [(i, int(i < 300), 0) for i in range(0, 400, 2)] + [(2, 1, None), (None, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    model = importance.Importance(df, labels)
    marked = model.marked().collect()
    assert len(marked) == len(rows)
    good = [r.kept for r in marked if r.doc_id is not None and r.doc_id < 300]
    bad = [r.kept for r in marked if r.doc_id is not None and r.doc_id >= 300]
    assert np.mean(good) > 0.95 and np.mean(bad) < 0.05
    kept = model.kept()
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in marked)
    top = importance.top_k(model.marked(), 50, "doc_id").collect()
    assert sorted(r.noisy_weight for r in top) == sorted(r.noisy_weight for r in marked)[-50:]


def test_importance_without_labels_keeps_all(docs, empty, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert importance.Importance(docs, none).kept().count() == len(table())
    assert importance.Importance(empty, none).marked().count() == 0


def brute_spans(t):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(x) for x in reversed(m.group()) if x.isdigit()]
        total = sum(x if i % 2 == 0 else 2 * x - 9 * (x > 4) for i, x in enumerate(d))
        if 12 <= len(d) <= 19 and total % 10 == 0:
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= sum(x.isdigit() for x in m.group()) <= 15:
            out.append((m.start(), 3, m.end()))
    return [f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(out)]


PERSONAL = [
    None, "", "a@b.c_d@e.f ab@cd@ef.gh x@y. é😀 q.r@s-t.u.v.w, ..@-.-",
    "1.2.3.4.5.6.7.8 256.1.1.1 0255.00001.1.1 1.2.3 4.5.6.7", "1 2-3 " * 400,
    "+1 (499) 555-6503 4111 1111 1111 1111 +123 +12345678901234567 +1....9", "9" * 6000,
    "a" * 6000 + "@", "4111111111111111 x +12 345 678 901; " * 300, "7536784127813050 4845168114407329",
]


def test_base_spans_equal_brute_force_and_stay(spark):
    rows = [(i, t, "x") for i, t in enumerate(PERSONAL)] + [(5, PERSONAL[5], "x"), (None, "m@n.o", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, base string")
    got = pii.mark_personal(df).collect()
    want = Counter(
        (i, hashlib.sha256(",".join(brute_spans(t or "")).encode()).hexdigest()) for i, t, _ in rows
    )
    assert Counter((r.doc_id, r.base_sha256) for r in got) == want
    texts = {i: t or "" for i, t, _ in rows}
    for r in got:
        assert set(brute_spans(texts[r.doc_id])) <= set(r.spans.split(","))
    described = pii.describe(df)
    hidden = pii.redact(pii.Finder(described).spans(described)).where("doc_id IN (2, 5)").orderBy("doc_id")
    mail = hidden.first().redacted
    assert mail.startswith("[email][email] ab@[email] x@y. é😀 [email], ")


def test_disguised_spans_are_added_and_other_numbers_are_not(spark):
    """Beside plain addresses and numbers, and beside groups of digits that are neither."""
    rng = random.Random(5)

    def word():
        return "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))

    def some(n):
        return " ".join(word() for _ in range(n))

    rows, want = [], []
    for i in range(600):
        mail = f"{word()}.{word()} [at] {word()} [dot] org"
        phone = f"{rng.randint(200, 999)} {rng.randint(100, 999)} {rng.randint(1000, 9999)}"
        begin = some(6) + " "
        text = begin + mail + (middle := f" {some(4)} ") + phone + f" {some(3)} {word()}@{word()}.com"
        at = len(begin) + len(mail) + len(middle)
        rows.append((i, text))
        want.append({f"email:{len(begin)}:{len(begin + mail)}", f"phone:{at}:{at + len(phone)}"})
    table_rows = [" ".join(str(rng.randint(100, 999)) for _ in range(12)) for _ in range(200)]
    table_rows += [f"{some(3)} {rng.randint(100, 999)} 456 7890 1234 {some(2)} {word()} [at] {word()}" for _ in range(200)]
    table_rows += [f"{some(2)} version 300.1.2.999 {some(2)}" for _ in range(100)]
    rows += [(1000 + i, t) for i, t in enumerate(table_rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii.mark_personal(df).collect()}
    caught = sum(len(w & set(got[i].spans.split(","))) for i, w in enumerate(want))
    assert caught >= 0.9 * 2 * len(want)
    assert sum(got[i].n_added for i in range(600)) <= caught / pii.PRECISION
    assert all(got[i].n_email == 1 and got[i].n_phone == 0 for i in range(600))
    assert sum(got[1000 + i].n_added for i in range(len(table_rows))) <= 0.05 * caught
    assert all(r.n_generated >= r.n_added for r in got.values())


def test_no_personal_data_in_an_empty_table(empty):
    assert pii.mark_personal(empty).count() == 0
