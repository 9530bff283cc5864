"""Documents to units to counted units.

A unit is a run of whole paragraphs, or a piece of a long one, of at most
``max_chars`` characters: ``(work_id, unit_no, units, entry, text)``.  Nearly
every work is one unit; a long one is several, which bounds what a row holds
while it is measured.  ``entry`` says what the unit goes on with: a new
paragraph, the paragraph of the unit before, or its very sentence.

A view of the units holds one row of counts and sums for each: its distinct
tokens with their numbers, found as runs of the sorted tokens, and what
measuring adds up.  All of it is worked out inside the unit's row, where it was
read: no text and no token is exchanged.  ``text_view`` takes it from the text
alone, ``parsed_view`` from a parser's output.

What crosses a cut inside a paragraph is carried: a row of a cut work says how
it would count if a quotation were open at its beginning, whether it leaves
one open, and how many words its first and last sentence have.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.functions.prose import PARAGRAPH, SPACE, cut_text, split_paragraphs
from inkmeter.functions.strings import let, matches_all, text
from inkmeter.operators import flat

TOKEN_TYPE = (
    "struct<text:string,stop:boolean,lemma:string,"
    "pos:string,tag:string,dep:string,head:int>"
)
PARSED_COLUMNS = (
    "work_id string, unit_no int, units int, entry int, text string, "
    f"sents array<array<{TOKEN_TYPE}>>"
)
# What measuring adds up of a parse, beside sentences and quoted words
PARSED_SUMS = (
    "adjectives", "adverbs", "possessives", "depths", *(f"kind_{k}" for k in fixed.SENTENCE_TYPES),
)
SENTENCE_SUMS = ("sentence_count", "sentence_words", "sentence_squares")
SPELT_SUMS = (*SENTENCE_SUMS, "quoted")
VIEW_SUMS = (*SPELT_SUMS, *PARSED_SUMS)
DESCRIBED_NAMES = (
    "work_id", "unit_no", "units", "entry", "types", "terms", "_words", "_letters", *PARSED_SUMS,
)
TYPES = "array<struct<token:string,n:bigint,alpha:boolean>>"
DESCRIBED_COLUMNS = (
    f"work_id string, unit_no int, units int, entry int, types {TYPES}, "
    "terms array<struct<term:string,term_count:bigint>>, _words array<bigint>, _letters string, "
    + ", ".join(f"{c} bigint" for c in PARSED_SUMS)
)

TERM_COLUMNS = "work_id string, units int, terms array<struct<term:string,term_count:bigint>>"

# What the text-only tokeniser takes for a clitic, a sentence, a token
_WORD = r"[\p{L}\p{M}\p{N}]"
CLITIC = rf"(?i)(n['’]t|['’](?:re|ve|ll|m|d|s))(?!{_WORD})"
SENTENCE = r"""[^.!?]+(?:[.!?]+["”’)\]]*)?|[.!?]+["”’)\]]*"""
TOKEN = (
    rf"(?i)n['’]t(?!{_WORD})|['’](?:re|ve|ll|m|d|s)(?!{_WORD})|\.\.\.|--|{_WORD}+"
    r"|\n|[^\p{L}\p{M}\p{N}\s]"
)
ALPHA = r"^\p{L}+$"
WORD = rf"(?<!{_WORD})\p{{L}}++(?!{_WORD})"
QUOTE = '["“]'
QUOTATION = r'["“]([^"”\n]*)["”]?'
# Characters that a caller's parser is handed at once; its tokens are Python objects
PIECE_CHARS = 1 << 18
# Bytes of tokens that are counted at once, and how they are joined
PIECE_BYTES = 1 << 22
TOKEN_BREAK = " "


def text_units(
    documents: DataFrame, text_column: str = "text", max_chars: int = fixed.MAX_CHUNK_CHARS
) -> DataFrame:
    """Units of each document; ``documents`` holds one row per work."""
    work = F.coalesce(
        F.col("work_id").cast("string"), F.raise_error(F.lit("a document has no work_id"))
    )
    chunked = documents.select(
        work.alias("work_id"), cut_text(text(text_column), max_chars).alias("chunks")
    ).select("work_id", F.size("chunks").alias("units"), "chunks")
    entries = F.transform(
        "chunks",
        lambda c, i: F.struct(
            c["chunk"].alias("text"),
            F.coalesce(F.get("chunks", i - 1)["ends"], F.lit(PARAGRAPH)).alias("entry"),
        ),
    )
    # There is always a chunk; the outer form keeps Spark from testing that first
    return chunked.select("work_id", "units", F.posexplode_outer(entries).alias("unit_no", "u")).select(
        "work_id", "unit_no", "units", "u.entry", "u.text"
    )


@dataclass(frozen=True)
class View:
    """Units as measuring reads them, a row each.

    ``rows``: (work_id, unit_no, units, types, sums...); ``types`` holds
    (token, n, alpha) of the unit's distinct case-folded tokens, the sums are
    those named in ``sums``.  ``long_rows``: those of works of several units,
    with what they carry over a cut, as ``carry``.
    """

    rows: DataFrame
    long_rows: DataFrame
    sums: tuple[str, ...]
    parsed: bool
    #: Whether rows hold the sums over their types too; types may then be only those of long works
    summed: bool = False


def runs(values: Column) -> Column:
    """(value, n) of the distinct values of an array of strings.

    What is used more than once is bound by ``let``: the optimizer may copy a
    column's expression into a filter, and into every step of a lambda there.
    """

    def of_sorted(ordered: Column) -> Column:
        size = F.size(ordered)
        indices = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(
            F.array().cast("array<int>")
        )
        starts = F.filter(
            indices, lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1))
        )
        return let(
            starts,
            lambda at: F.transform(
                at,
                lambda s, k: F.struct(
                    F.get(ordered, s).alias("value"),
                    (F.coalesce(F.get(at, k + 1), size) - s).cast("bigint").alias("n"),
                ),
            ),
        )

    return let(F.sort_array(values), of_sorted)


def _types(tokens: Column) -> Column:
    """(token, n, alpha) of the distinct tokens of an array."""
    return F.transform(
        runs(tokens),
        lambda r: F.struct(
            r["value"].alias("token"), r["n"].alias("n"), is_alpha(r["value"]).alias("alpha")
        ),
    )


def _replace_clitics(value: Column, by: str) -> Column:
    """Most texts hold no apostrophe: look for one before searching clitics."""
    any_apostrophe = F.contains(value, F.lit("'")) | F.contains(value, F.lit("’"))
    return F.when(any_apostrophe, F.regexp_replace(value, CLITIC, by)).otherwise(value)


def space_clitics(value: Column) -> Column:
    return _replace_clitics(value, " $1 ")


def sentence_strings(paragraph: Column) -> Column:
    return F.filter(matches_all(paragraph, SENTENCE), lambda s: s.rlike(r"\S"))


def fold_case(value: Column) -> Column:
    """Lower case, one character for one."""
    return F.lower(F.replace(value, F.lit("\u0130"), F.lit("i")))


def token_strings(spaced: Column) -> Column:
    return matches_all(fold_case(spaced), TOKEN)


def word_count(value: Column) -> Column:
    """Alphabetic tokens of a text.

    Only a text with digits or combining marks can hold runs that are not
    words; the others count letter runs, which is several times cheaper.
    """

    def count(plain: Column) -> Column:
        return F.when(
            plain.rlike(r"[\p{M}\p{N}]"), F.regexp_count(plain, F.lit(WORD))
        ).otherwise(F.regexp_count(plain, F.lit(r"\p{L}+")))

    return let(let(value, lambda v: _replace_clitics(v, " ")), count).cast("bigint")


def quoted_text(value: Column) -> Column:
    """What stands inside double quotes; a line end closes an open quotation."""
    return F.array_join(matches_all(value, QUOTATION, 1), "\n")


def is_alpha(token: Column) -> Column:
    """A word: letters only."""
    return token.rlike(ALPHA)


def leaves_open(value: Column) -> Column:
    """Whether the last quotation of a text runs on behind its end."""
    return let(
        matches_all(value, QUOTATION),
        lambda found: F.coalesce(
            let(
                F.get(found, F.size(found) - 1),
                lambda last: value.endswith(last)
                & ~((F.length(last) > 1) & last.rlike(r"[\"”]\z")),
            ),
            F.lit(False),
        ),
    )


def _carry(quoted: Column, opened: Column, shown: Column, count_quoted, words: Column) -> Column:  # noqa: ANN001
    """What a unit of a cut work hands on; ``shown`` is its text for quotation marks."""
    behind_opener = F.concat(F.lit(fixed.OPEN_QUOTE), shown)
    return F.struct(
        F.col("unit_no"),
        F.col("entry"),
        quoted.alias("quoted"),
        count_quoted(behind_opener).alias("quoted_inside"),
        opened.alias("opens"),
        leaves_open(behind_opener).alias("stays_open"),
        F.size(words).alias("sentences"),
        F.coalesce(F.get(words, F.lit(0)), F.lit(0)).cast("bigint").alias("first_words"),
        F.coalesce(F.get(words, F.size(words) - 1), F.lit(0)).cast("bigint").alias("last_words"),
    )


def carried(long_rows: DataFrame) -> DataFrame:
    """(work_id, sentence_count, sentence_squares, quoted): what cuts inside paragraphs cost.

    Added to the sums of the units, they are those of the uncut work.
    """
    zero = F.lit(0).cast("bigint")
    start = F.struct(
        F.lit(False).alias("open"), zero.alias("running"), zero.alias("count"),
        zero.alias("squares"), zero.alias("quoted"),
    )

    def step(acc: Column, u: Column) -> Column:
        inside = (u["entry"] != PARAGRAPH) & acc["open"]
        goes_on = (u["entry"] == SPACE) & (u["sentences"] > 0)
        begun = F.when(u["entry"] == SPACE, acc["running"]).otherwise(0).cast("bigint")
        running = F.when(u["sentences"] == 0, begun).otherwise(
            u["last_words"] + F.when(u["sentences"] == 1, begun).otherwise(0)
        )
        return F.struct(
            F.when(inside, u["stays_open"]).otherwise(u["opens"]).alias("open"),
            running.cast("bigint").alias("running"),
            (acc["count"] - goes_on.cast("bigint")).alias("count"),
            (acc["squares"] + F.when(goes_on, 2 * begun * u["first_words"]).otherwise(0))
            .cast("bigint")
            .alias("squares"),
            (acc["quoted"] + F.when(inside, u["quoted_inside"] - u["quoted"]).otherwise(0))
            .cast("bigint")
            .alias("quoted"),
        )

    units = long_rows.groupBy("work_id").agg(F.sort_array(F.collect_list("carry")).alias("u"))
    return units.select("work_id", F.aggregate("u", start, step).alias("c")).select(
        "work_id",
        F.col("c.count").alias("sentence_count"),
        F.col("c.squares").alias("sentence_squares"),
        F.col("c.quoted").alias("quoted"),
    )


def sentence_table(units: DataFrame) -> DataFrame:
    """(work_id, unit_no, words): one row per sentence of the text."""
    return (
        units.select(
            "work_id",
            "unit_no",
            F.explode(split_paragraphs(space_clitics(F.col("text")))).alias("paragraph"),
        )
        .select(
            "work_id", "unit_no", F.explode(sentence_strings(F.col("paragraph"))).alias("sent")
        )
        .select("work_id", "unit_no", word_count(F.col("sent")).alias("words"))
    )


def _quoted_words(value: Column) -> Column:
    return (
        F.when(value.rlike(QUOTE), word_count(quoted_text(value))).otherwise(0).cast("bigint")
    )


def text_view(
    documents: DataFrame, text_column: str = "text", max_chars: int = fixed.MAX_CHUNK_CHARS
) -> View:
    """View of one-row-per-work documents; no annotation is known."""
    text = F.col("text")

    def counted(units: DataFrame, *carry: Column) -> DataFrame:
        sentences = F.flatten(F.transform(split_paragraphs(F.col("_spaced")), sentence_strings))
        read = units.withColumn("_spaced", space_clitics(text)).select(
            "work_id", "unit_no", "units", "entry", "text",
            _types(token_strings(F.col("_spaced"))).alias("types"),
            F.transform(sentences, word_count).alias("_words"),
            _quoted_words(text).alias("quoted"),
        )
        return read.select(
            "work_id", "unit_no", "units", "types", *_sentence_sums("_words"), "quoted", *carry
        )

    # More than one unit takes more than max_chars characters
    long = documents.filter(F.length(text_column) > max_chars)
    carry = _carry(F.col("quoted"), leaves_open(text), text, _quoted_words, F.col("_words"))
    return View(
        rows=counted(text_units(documents, text_column, max_chars)),
        long_rows=counted(
            text_units(long, text_column, max_chars).filter("units > 1"), carry.alias("carry")
        ),
        sums=SPELT_SUMS,
        parsed=False,
    )


def spelt_units(
    documents: DataFrame, text_column: str = "text", max_chars: int = fixed.MAX_CHUNK_CHARS
) -> DataFrame:
    """Units of one-row-per-work documents as ``typed_batches`` reads them, a row each.

    Tokens are handed over as one string, as no token holds a blank.
    """
    text = F.col("text")
    sentences = F.flatten(F.transform(split_paragraphs(F.col("_spaced")), sentence_strings))
    read = (
        text_units(documents, text_column, max_chars)
        .withColumn("_spaced", space_clitics(text))
        .select(
            "work_id", "unit_no", "units", "entry", "text",
            F.array_join(token_strings(F.col("_spaced")), TOKEN_BREAK).alias("_tokens"),
            F.transform(sentences, word_count).alias("_words"),
            _quoted_words(text).alias("quoted"),
        )
    )
    carry = _carry(F.col("quoted"), leaves_open(text), text, _quoted_words, F.col("_words"))
    return read.select(
        "work_id", "unit_no", "units", "_tokens", "_words", "quoted",
        F.when(F.col("units") > 1, carry).alias("carry"),
    )


def typed_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens of ``spelt_units`` counted: ``types`` in their place, some megabytes at a time."""
    for batch in batches:
        at = batch.schema.get_field_index("_tokens")
        sizes = pc.binary_length(batch.column(at)).to_numpy(zero_copy_only=False).astype("int64")
        place = (np.cumsum(sizes) - sizes) // PIECE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(place)) + 1).tolist(), batch.num_rows]
        for start, end in pairwise(cuts):
            if end > start:
                piece = batch.slice(start, end - start)
                yield piece.set_column(at, "types", _counted_types(piece.column(at)))


def _counted_types(joined: pa.Array) -> pa.ListArray:
    # A unit without tokens is one empty string, not one empty token
    some = pc.replace_with_mask(joined, pc.equal(joined, ""), pa.scalar(None, pa.string()))
    split = pc.split_pattern(some, TOKEN_BREAK)
    spelt = flat.Spellings(split.flatten())
    everything = np.ones(len(spelt.codes), dtype=bool)
    # Their case is folded already
    values, which, n, ends = flat.counted(spelt, str, flat.bounds(flat.lengths(split)), everything)
    types = pa.StructArray.from_arrays(
        [values.take(pa.array(which)), pa.array(n, pa.int64()), pa.array(flat.words(values)[which])],
        ["token", "n", "alpha"],
    )
    return flat.lists(types, ends)


def spelt_view(summed: DataFrame) -> View:
    """View of units that ``metrics.summed_text`` added up; hand over a written table, which is read three times."""
    return View(summed, summed.filter("units > 1"), SPELT_SUMS, parsed=False, summed=True)


def _sentence_sums(words: str) -> list[Column]:
    def total(value):  # noqa: ANN001, ANN202
        return F.aggregate(words, F.lit(0).cast("bigint"), lambda acc, w: acc + value(w))

    return [
        F.size(words).cast("bigint").alias("sentence_count"),
        total(lambda w: w).alias("sentence_words"),
        total(lambda w: w * w).alias("sentence_squares"),
    ]


def tree_depth(sentence: Column) -> Column:
    """Most hops from any token to its root, by pointer doubling.

    Every round doubles the distance each token has looked up, so a sentence
    of n tokens takes log2(n) rounds of n steps however deep the tree is.
    """
    start = F.struct(
        F.transform(
            sentence, lambda t, i: (F.coalesce(t["head"], i) != i).cast("int")
        ).alias("hops"),
        F.transform(sentence, lambda t, i: F.coalesce(t["head"], i)).alias("up"),
    )
    rounds = F.ceil(F.log2(F.greatest(F.size(sentence), F.lit(2)))).cast("int")
    doubled = F.aggregate(
        F.sequence(F.lit(1), rounds),
        start,
        lambda acc, _: F.struct(
            F.zip_with(
                acc["hops"], acc["up"], lambda h, u: h + F.get(acc["hops"], u)
            ).alias("hops"),
            F.transform(acc["up"], lambda u: F.get(acc["up"], u)).alias("up"),
        ),
        lambda acc: acc["hops"],
    )
    return F.coalesce(F.array_max(doubled), F.lit(0)).cast("bigint")


def sentence_kind(sentence: Column) -> Column:
    """complex over compound over simple, by dependency labels."""
    subordinate = F.exists(
        sentence, lambda t: F.coalesce(t["dep"].isin(*fixed.SUBORDINATE_DEPS), F.lit(False))
    )
    coordinated = F.exists(
        sentence,
        lambda t: F.coalesce(
            (t["dep"] == "conj")
            & t["pos"].isin(*fixed.CLAUSE_HEAD_POS)
            & (F.get(sentence, t["head"])["dep"] == "ROOT"),
            F.lit(False),
        ),
    )
    return F.when(subordinate, "complex").when(coordinated, "compound").otherwise("simple")


def parsed_sentences(parsed: DataFrame) -> DataFrame:
    """(work_id, unit_no, words, depth, kind): one row per parsed sentence."""
    sent = F.col("sent")
    return parsed.select("work_id", "unit_no", F.explode("sents").alias("sent")).select(
        "work_id",
        "unit_no",
        F.size(F.filter(sent, lambda t: is_alpha(t["text"]))).cast("bigint").alias("words"),
        tree_depth(sent).alias("depth"),
        sentence_kind(sent).alias("kind"),
    )


def quote_letters(tokens: Column) -> Column:
    """One letter per token: w a word, a newline and quotes as themselves, o any other."""
    quotes = (fixed.OPEN_QUOTE, fixed.CLOSE_QUOTE, fixed.STRAIGHT_QUOTE)
    return F.array_join(
        F.transform(
            tokens,
            lambda t: F.when(is_alpha(t), "w")
            .when(t.isin(*quotes), t)
            .when(F.contains(t, F.lit("\n")), "\n")
            .otherwise("o"),
        ),
        "",
    )


def _quoted_letters(letters: Column) -> Column:
    return F.regexp_count(quoted_text(letters), F.lit("w")).cast("bigint")


def quoted_tokens(tokens: Column) -> Column:
    """Words inside double quotes; a quotation runs to the next closer, newline or end."""
    return _quoted_letters(quote_letters(tokens))


def described_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parsed units to ``DESCRIBED_COLUMNS``: what measuring reads of their tokens.

    ``types`` are the unit's distinct case-folded tokens, ``terms`` its content
    lemmas (alphabetic, no stop word, open-class), ``_words`` the words of each
    sentence, ``_letters`` the tokens as ``quote_letters`` gives them.  A parser
    that works on Arrow batches can be put before it in the same task, so that
    its tokens never leave it.
    """
    quotes = (fixed.OPEN_QUOTE, fixed.CLOSE_QUOTE, fixed.STRAIGHT_QUOTE)

    def letter_of(spelt: pa.Array) -> np.ndarray:
        letter = np.full(len(spelt), ord("o"), dtype="uint32")
        letter[pc.match_substring(spelt, "\n").to_numpy(zero_copy_only=False)] = ord("\n")
        for q in quotes:
            letter[pc.equal(spelt, q).to_numpy(zero_copy_only=False)] = ord(q)
        letter[flat.words(spelt)] = ord("w")
        return letter

    for piece in flat.pieces(batches, "sents"):
        parsed = flat.Parsed(piece.column("sents"))
        texts, pos, dep = (parsed.spellings(c) for c in ("text", "pos", "dep"))
        in_sentence, in_unit = parsed.sentence_ends, parsed.unit_ends
        everything = np.ones(len(parsed.flat), dtype=bool)
        values, which, n, ends = flat.counted(texts, flat.fold, in_unit, everything)
        types = pa.StructArray.from_arrays(
            [
                values.take(pa.array(which)),
                pa.array(n, pa.int64()),
                pa.array(flat.words(values)[which]),
            ],
            ["token", "n", "alpha"],
        )
        letters = texts.tokens(letter_of(texts.dictionary), ord("o"))
        head = parsed.heads()
        size = np.repeat(np.diff(in_sentence), np.diff(in_sentence))
        first = np.repeat(in_sentence[:-1], np.diff(in_sentence))
        inside = (head >= 0) & (head < size)
        at_root = inside & dep.isin("ROOT")[np.where(inside, first + head, 0)]
        coordinated = dep.isin("conj") & pos.isin(*fixed.CLAUSE_HEAD_POS) & at_root
        is_complex = flat.sums(dep.isin(*fixed.SUBORDINATE_DEPS), in_sentence) > 0
        is_compound = ~is_complex & (flat.sums(coordinated, in_sentence) > 0)
        kinds = {"complex": is_complex, "compound": is_compound, "simple": ~is_complex & ~is_compound}
        possessive = texts.isin("'s", "’s", "'S", "’S") & parsed.spellings("tag").isin("POS")
        columns = [
            *(piece.column(c) for c in ("work_id", "unit_no", "units", "entry")),
            flat.lists(types, ends),
            _content_terms(parsed, pos, letters == ord("w")),
            flat.lists(pa.array(flat.sums(letters == ord("w"), in_sentence)), parsed.unit_sentences),
            pa.array(
                [letters[a:b].tobytes().decode("utf-32-le") for a, b in pairwise(in_unit.tolist())],
                pa.string(),
            ),
            flat.sums(pos.isin("ADJ"), in_unit),
            flat.sums(pos.isin("ADV"), in_unit),
            flat.sums(possessive, in_unit),
            flat.sums(flat.depths(head, in_sentence), parsed.unit_sentences),
            *(flat.sums(kinds[k], parsed.unit_sentences) for k in fixed.SENTENCE_TYPES),
        ]
        yield pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=DESCRIBED_NAMES
        )


def _content_terms(parsed: flat.Parsed, pos: flat.Spellings, is_word: np.ndarray) -> pa.ListArray:
    """(term, term_count) of each unit's content lemmas: alphabetic, no stop word, open-class."""
    # A token whose stop mark is unknown is none of the content
    content = pos.isin(*fixed.CONTENT_POS) & is_word
    content &= ~pc.fill_null(parsed.field("stop"), True).to_numpy(zero_copy_only=False)
    lemmas, which, n, ends = flat.counted(
        parsed.spellings("lemma"), str.lower, parsed.unit_ends, content
    )
    terms = pa.StructArray.from_arrays(
        [lemmas.take(pa.array(which)), pa.array(n, pa.int64())], ["term", "term_count"]
    )
    return flat.lists(terms, ends)


def term_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parsed units to ``TERM_COLUMNS``: the ``terms`` of ``described_batches`` alone."""
    for piece in flat.pieces(batches, "sents"):
        parsed = flat.Parsed(piece.column("sents"))
        texts = parsed.spellings("text")
        is_word = texts.tokens(flat.words(texts.dictionary), False)
        terms = _content_terms(parsed, parsed.spellings("pos"), is_word)
        yield pa.RecordBatch.from_arrays(
            [piece.column("work_id"), piece.column("units"), terms], names=["work_id", "units", "terms"]
        )


def describe(parsed: DataFrame) -> DataFrame:
    """Units as measuring and vocabulary read them (``DESCRIBED_COLUMNS``), a row each."""
    return parsed.select(
        "work_id", "unit_no", "units", "entry", "sents"
    ).mapInArrow(described_batches, DESCRIBED_COLUMNS)


def parsed_view(parsed: DataFrame) -> View:
    """View of parsed units (``PARSED_COLUMNS``).

    A parse of a unit that begins or ends inside a sentence takes that part for
    a sentence: its depth and kind are those of the part.
    """
    return _view(describe(parsed), describe(parsed.filter("units > 1")))


def described_view(described: DataFrame) -> View:
    """View of described units; hand over a written table, which is read three times."""
    return _view(described, described.filter("units > 1"))


def with_quoted(described: DataFrame) -> DataFrame:
    """Quoted words are counted in a step of their own, as what is carried reads them too."""
    return described.withColumn("quoted", _quoted_letters(F.col("_letters")))


def letters_carry() -> Column:
    """What a described unit with its ``quoted`` words hands on."""
    letters = F.col("_letters")
    return _carry(F.col("quoted"), leaves_open(letters), letters, _quoted_letters, F.col("_words"))


def _view(described: DataFrame, long: DataFrame) -> View:
    def counted(units: DataFrame, *carry: Column) -> DataFrame:
        return with_quoted(units).select(
            "work_id", "unit_no", "units", "types", *_sentence_sums("_words"), "quoted", *PARSED_SUMS, *carry
        )

    return View(counted(described), counted(long, letters_carry().alias("carry")), VIEW_SUMS, parsed=True)


def summed_view(summed: DataFrame) -> View:
    """View of units that ``metrics.summed`` added up; hand over a written table, which is read three times."""
    return View(summed, summed.filter("units > 1"), VIEW_SUMS, parsed=True, summed=True)


def token_table(parsed: DataFrame) -> DataFrame:
    """One row per token of parsed units, for ad-hoc queries."""
    rows = parsed.select("work_id", "unit_no", F.posexplode("sents").alias("sent_no", "sent"))
    return rows.select(
        "work_id", "unit_no", "sent_no", F.posexplode("sent").alias("tok_no", "token")
    ).select("work_id", "unit_no", "sent_no", "tok_no", "token.*")


Annotator = Callable[[list[str]], Iterable[list[list[dict]]]]


def annotate(units: DataFrame, annotator: Annotator) -> DataFrame:
    """Parsed units from a caller's parser.

    ``annotator`` takes a batch of unit texts and yields, per text, its
    sentences as lists of token dicts (the fields of ``TOKEN_TYPE``).  It runs
    on Arrow batches inside the tasks, a bounded number of characters at a time
    (see ``pieces``); write the result as a table before measuring so the
    parser runs once.
    """

    def batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for piece in pieces(frame):
                parsed = list(annotator(piece["text"].tolist()))
                yield piece.assign(sents=pd.Series(parsed, index=piece.index, dtype=object))

    return units.select("work_id", "unit_no", "units", "entry", "text").mapInPandas(
        batches, PARSED_COLUMNS
    )


def pieces(frame: pd.DataFrame, max_chars: int = PIECE_CHARS) -> Iterator[pd.DataFrame]:
    """The rows of a batch in runs whose texts begin within ``max_chars`` characters.

    A batch holds thousands of units, and a token takes a hundred times its text
    as an object: a run is parsed and handed on before the next one is.
    """
    sizes = frame["text"].str.len()
    place = (sizes.cumsum() - sizes) // max_chars
    for _, piece in frame.groupby(place.to_numpy(), sort=True):
        yield piece
