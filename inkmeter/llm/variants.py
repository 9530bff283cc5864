"""Spelling variants of the words of a corpus, by asymmetric q-chunks.

Words are maximal runs of letters, counted over all documents; a planted slip
(a letter lost in one run of 31, chosen by a checksum) gives every corpus some
variants.  Two words are near if one code point inserted, deleted or replaced
turns one into the other.

Of a pair, the shorter word (of equal lengths, either) gives two disjoint
chunks, its front and its back half; one edit leaves one of them whole, in
place or moved by one.  The other word gives its positional grams of that
length at the places where such a chunk can lie, with a shift of at most one:
grams elsewhere meet no chunk.  What lies outside the whole chunk again holds
exactly one edit, so the same step is taken once more on it.  The join key is
thus the whole chunk and the whole half of the rest, three quarters of a word
in all: few words share one however large the vocabulary is.  A pair that meets
under several keys is kept under the first of them, and every pair is verified.

Cases: null text counts as no words, a null id as an empty one; a repeated row
counts again; an empty table gives no rows; other columns are not read.  Ties
of count go to the smaller word in code-point order.  Texts are walked match by
match, and a task holds at most ``HELD`` distinct words at a time.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter.llm.staging import stage
from inkmeter.llm.wordhash import pieces

LEAST_LETTERS = 7
LEAST_SEEN = 2
LOST_ONE_IN = 31
FORM_FACTOR = 10
HELD = 1 << 18
LONG = 1 << 20


def _runs(text: str, pattern: re.Pattern) -> Counter:
    if len(text) <= LONG:
        return Counter(pattern.findall(text))
    return Counter(m.group() for m in pattern.finditer(text))


def word_counts(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LETTERS,
    seen: int = LEAST_SEEN,
    lost_one_in: int = LOST_ONE_IN,
) -> DataFrame:
    """word, n: words of at least ``least`` code points and ``seen`` occurrences."""
    # A shorter run cannot become a longer word, so only long runs are looked at
    pattern = re.compile("[a-zÀ-ÿ]{%d,}" % least)

    def flushed(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())],
            ["word", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for piece in pieces(batch):
                folded = pc.ascii_lower(piece.column(0))
                for value, ident in zip(folded, piece.column(1).to_pylist(), strict=True):
                    whole = value.as_py()
                    if not whole:
                        continue
                    start = zlib.crc32(f"{ident}:".encode())
                    for word, n in _runs(whole, pattern).items():
                        h = zlib.crc32(word.encode(), start)
                        if h % lost_one_in == 0:
                            if len(word) == least:
                                continue
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                        held[word] += n
                    if len(held) >= HELD:
                        yield flushed(held)
                        held = Counter()
        if held:
            yield flushed(held)

    texts = docs.select(
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("ident"),
    ).where("text IS NOT NULL")
    counted = texts.mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= seen)


def _keys(size: Column, partner: Column) -> list[Column]:
    """What a word of ``size`` letters shows of a pair whose shorter word has ``partner``.

    Counted from both ends, so the same slices serve the word that gives the
    chunks (its own length is ``partner``) and the one that gives the grams.
    """
    word = F.col("word")
    chunk = F.floor(partner / 2).cast("int")
    half = F.floor((partner - chunk) / 2).cast("int")

    def first(n: Column) -> Column:
        return word.substr(F.lit(1), n)

    def last(n: Column) -> Column:
        return word.substr((size - n + 1).cast("int"), n)

    nothing = F.lit("")
    shown = [
        (first(chunk + half), nothing),  # front whole, then the next half of the rest
        (first(chunk), last(half)),  # front whole, and the last half of the rest
        (first(half), last(chunk)),  # back whole, and the first half of the rest
        (nothing, last(chunk + half)),  # back whole, and the half before it
    ]
    return [
        F.struct(F.lit(k).alias("kind"), F.xxhash64(F.lit(k), partner, a, b).alias("key"))
        for k, (a, b) in enumerate(shown)
    ]


def near_pairs(words: DataFrame, least: int = LEAST_LETTERS) -> DataFrame:
    """Pairs (word, n, other, other_n) one edit apart, each once; words(word, n) are distinct."""
    sized = words.select("word", "n", F.char_length("word").alias("size"))
    size = F.col("size")
    chunks = sized.select("word", "n", "size", F.explode(F.array(*_keys(size, size))).alias("k"))
    partners = F.filter(F.array(size, size - 1), lambda s: s >= least)
    grams = sized.withColumn("partner", F.explode(partners)).select(
        "word", "n", "size", F.explode(F.array(*_keys(size, F.col("partner")))).alias("k")
    )
    x = chunks.select(
        F.col("k.key"), "word", "n", "size", F.col("k.kind")
    )
    y = grams.select(
        F.col("k.key"),
        F.col("word").alias("other"),
        F.col("n").alias("other_n"),
        F.col("size").alias("other_size"),
    )
    met = x.join(
        y,
        (x.key == y.key)
        & ((F.col("other_size") > F.col("size")) | (F.col("word") < F.col("other")))
        & (F.expr("levenshtein(word, other, 1)") == 1),
    )
    chunk, half = "cast(size div 2 AS int)", "cast((size - size div 2) div 2 AS int)"

    def same(front: str, back: str) -> str:
        return (
            f"left(word, {front}) = left(other, {front})"
            f" AND right(word, {back}) = right(other, {back})"
        )

    both = f"{chunk} + {half}"
    earlier = [same(both, "0"), same(chunk, half), same(half, chunk)]
    first_kind = F.expr(
        "CASE " + " ".join(f"WHEN {c} THEN {k}" for k, c in enumerate(earlier)) + " ELSE 3 END"
    )
    return met.where(F.col("kind") == first_kind).select("word", "n", "other", "other_n")


def _roots(forms: DataFrame) -> DataFrame:
    """word, root: the end of each chain of forms, by pointer doubling.

    A form is at least ``FORM_FACTOR`` times as frequent as its word, so a
    chain has no cycle and at most log10 of the largest count links.
    """
    links = stage(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next_root"))
        jumped = stage(
            links.join(ahead, "root", "left").select(
                "word",
                F.coalesce("next_root", "root").alias("root"),
                F.col("next_root").isNotNull().alias("moved"),
            )
        )
        links = jumped.select("word", "root")
        if jumped.where("moved").isEmpty():
            return links


def spelling_variants(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST_LETTERS,
    seen: int = LEAST_SEEN,
    lost_one_in: int = LOST_ONE_IN,
    factor: int = FORM_FACTOR,
) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word.

    The form is the near word of largest n where that is at least ``factor``
    times the word's own; the root is where following forms ends.
    """
    words = stage(word_counts(docs, doc_id, text, least, seen, lost_one_in))
    pairs = near_pairs(words, least)
    ways = F.array(
        F.struct("word", "n", F.col("other"), F.col("other_n")),
        F.struct(
            F.col("other").alias("word"),
            F.col("other_n").alias("n"),
            F.col("word").alias("other"),
            F.col("n").alias("other_n"),
        ),
    )
    near = (
        pairs.select(F.explode(ways).alias("w"))
        .select("w.*")
        .groupBy("word")
        .agg(
            F.count(F.lit(1)).alias("n_near"),
            F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best"),
        )
    )
    marked = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(-F.col("best.less") >= factor * F.col("n"), F.col("best.other")).alias("form"),
            F.when(-F.col("best.less") >= factor * F.col("n"), -F.col("best.less")).alias(
                "form_n"
            ),
        )
    )
    roots = _roots(marked.where("form IS NOT NULL"))
    return marked.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
