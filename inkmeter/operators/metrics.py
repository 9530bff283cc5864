"""Style series per work.

A unit's tokens are counted inside its row, and every token sum is taken there
over its distinct tokens, so what is shuffled to the works is one row of sums
per unit.  Three sums do not add up across units (distinct types, hapaxes,
squared type counts): works that span several units get those from counts
merged by (work, token), combined map-side and spread by token, so one huge
work is many small groups.

A series is a name and an expression over the sums, so a new one joins the
same pass instead of adding its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.operators import flat
from inkmeter.operators.tokens import (
    DESCRIBED_COLUMNS,
    SENTENCE_SUMS,
    SPELT_SUMS,
    TERM_COLUMNS,
    TYPES,
    VIEW_SUMS,
    View,
    carried,
    described_batches,
    letters_carry,
    spelt_units,
    term_batches,
    typed_batches,
    with_quoted,
)

TEXT, SYNTAX = "text", "syntax"

TokenSum = tuple[str, ...] | Callable[[Column], Column]


# --- Token counts -----------------------------------------------------------


def _types(rows: DataFrame) -> DataFrame:
    """(work_id, token, n, alpha): the distinct tokens of each unit."""
    # The outer form keeps Spark from counting once more to see whether there are any
    return (
        rows.select("work_id", F.explode_outer("types").alias("t"))
        .select("work_id", "t.*")
        .filter("token IS NOT NULL")
    )


def merged_counts(long_rows: DataFrame) -> DataFrame:
    """(work_id, token, n, alpha) of works that span several units."""
    return (
        _types(long_rows)
        .groupBy("work_id", "token", "alpha")
        .agg(F.sum("n").alias("n"))
        .select("work_id", "token", "n", "alpha")
    )


def token_counts(view: View) -> DataFrame:
    """(work_id, token, n, alpha); short works are counted where they lie."""
    return _types(view.rows.filter("units = 1")).unionByName(merged_counts(view.long_rows))


def word_counts(view: View) -> DataFrame:
    """The bag of words: (work_id, word, n), case-folded."""
    return token_counts(view).filter("alpha").select("work_id", F.col("token").alias("word"), "n")


Parser = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def vocabulary(
    units: DataFrame,
    parser: Parser | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Content lemmas per work: alphabetic, no stop word, open-class.

    ``parser`` is that of ``summed``: it shares a task with the counting, so that
    no token leaves it.  Without one the units are parsed already.  ``keep`` writes
    what is counted of each unit and returns its reader; without it, works of one
    unit and of several are read and parsed by themselves.
    """

    def counted(some: DataFrame) -> DataFrame:
        needed = some if parser else some.select("work_id", "units", "sents")
        return needed.mapInArrow(
            lambda found: term_batches(parser(found) if parser else found), TERM_COLUMNS
        )

    if keep is not None:
        return described_vocabulary(keep(counted(units)))
    return _work_terms(counted(units.filter("units = 1")), counted(units.filter("units > 1")))


def described_vocabulary(described: DataFrame, of_work: DataFrame | None = None) -> DataFrame:
    """``vocabulary`` of described units.

    ``of_work`` holds columns by ``work_id`` that the rows get, joined while a
    work is one row a unit rather than one a term.
    """
    units = described.select("work_id", "units", "terms")
    return _work_terms(units.filter("units = 1"), units.filter("units > 1"), of_work)


def _work_terms(
    short_units: DataFrame, long_units: DataFrame, of_work: DataFrame | None = None
) -> DataFrame:
    """(work_id, term, term_count, ...) from units of short works and of works of several units."""

    def known(rows: DataFrame) -> DataFrame:
        return rows if of_work is None else rows.join(of_work, "work_id")

    more = [c for c in of_work.columns if c != "work_id"] if of_work is not None else []
    # The outer form keeps Spark from counting once more to see whether there are any
    short = (
        known(short_units)
        .select("work_id", *more, F.explode_outer("terms").alias("t"))
        .filter("t.term IS NOT NULL")
        .select("work_id", "t.term", "t.term_count", *more)
    )
    long = (
        long_units.select("work_id", F.explode("terms").alias("t"))
        .groupBy("work_id", "t.term")
        .agg(F.sum("t.term_count").alias("term_count"))
    )
    return short.unionByName(known(long))


# --- Series -----------------------------------------------------------------


@dataclass(frozen=True)
class Series:
    """One measured series: an expression over the per-work sums."""

    name: str
    value: Column
    needs: str = TEXT


@dataclass
class Registry:
    """The token sums measuring takes, and the series read off all sums.

    A token sum is what ``count_of`` gives, or a function of a type (token, n,
    alpha) whose results are added up.
    """

    token_sums: dict[str, TokenSum] = field(default_factory=dict)
    series: list[Series] = field(default_factory=list)

    def register(
        self,
        name: str,
        value: Column,
        needs: str = TEXT,
        token_sums: dict[str, TokenSum] | None = None,
    ) -> None:
        """Add a series, with whatever token sums it needs beyond those present."""
        if any(s.name == name for s in self.series):
            raise ValueError(f"series {name!r} is already registered")
        self.token_sums.update(token_sums or {})
        self.series.append(Series(name, value, needs))


def count_of(tokens: Iterable[str]) -> tuple[str, ...]:
    """Occurrences of any of the tokens."""
    return tuple(dict.fromkeys(tokens))


def share(part: Column, whole: Column) -> Column:
    """part / whole as a double; 0 when the whole is 0."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(
        part.cast("double") / whole.cast("double")
    )


def _clitics() -> list[str]:
    straight = [*fixed.CONTRACTION_CLITICS, "'s"]
    return straight + [c.replace("'", "’") for c in straight]


def _words_of(t: Column) -> Column:
    return F.when(t["alpha"], t["n"])


def _letters_of(t: Column) -> Column:
    return F.when(t["alpha"], t["n"] * F.length(t["token"]))


# The same over types laid flat: (token, n, alpha) arrays to what each type adds
_FLAT_SUMS = {
    _words_of: lambda token, n, alpha: n * alpha,
    _letters_of: lambda token, n, alpha: n * alpha * _characters(token),
}


def _characters(token: pa.Array) -> np.ndarray:
    return pc.utf8_length(token).to_numpy(zero_copy_only=False).astype("int64")


def builtin_registry(
    function_words: tuple[str, ...] = fixed.FUNCTION_WORDS,
    archaic_words: tuple[str, ...] = fixed.ARCHAIC_WORDS,
    punctuation: dict[str, tuple[str, ...]] = fixed.PUNCTUATION_MARKS,
) -> Registry:
    """The 63 style series plus word_count."""
    reg = Registry(
        token_sums={
            "words": _words_of,
            "letters": _letters_of,
            "archaic": count_of(archaic_words),
            "clitics": count_of(_clitics()),
        }
    )
    words, count = F.col("words"), F.col("sentence_count")
    sentence_words = F.col("sentence_words").cast("decimal(18,0)")
    total = words.cast("double")
    spread = (
        count.cast("decimal(18,0)") * F.col("sentence_squares").cast("decimal(19,0)")
        - sentence_words * sentence_words
    ).cast("double")

    reg.register("word_count", total)
    reg.register("mean_word_length", share(F.col("letters"), words))
    reg.register(
        "yules_k",
        F.when(words == 0, F.lit(0.0)).otherwise(
            10_000 * (F.col("squares") - words).cast("double") / (total * total)
        ),
    )
    reg.register("archaic_word_rate", share(F.col("archaic"), words))
    reg.register(
        "honore_r",
        F.when((words == 0) | (F.col("hapaxes") == F.col("distinct")), F.lit(0.0)).otherwise(
            100 * F.log(total) / (1 - share(F.col("hapaxes"), F.col("distinct")))
        ),
    )
    for w in function_words:
        reg.register(
            f"funcword_{w}", share(F.col(f"word_{w}"), words), TEXT, {f"word_{w}": count_of([w])}
        )
    reg.register("mean_sentence_length", share(words, count))
    reg.register(
        "sentence_length_stdev",
        F.when(count < 2, F.lit(0.0)).otherwise(F.sqrt(spread) / count.cast("double")),
    )
    reg.register("mean_parse_tree_depth", share(F.col("depths"), count), SYNTAX)
    for k in fixed.SENTENCE_TYPES:
        reg.register(f"senttype_{k}", share(F.col(f"kind_{k}"), count), SYNTAX)
    for name, marks in punctuation.items():
        mark = f"mark_{name}"
        reg.register(f"punct_{name}", share(F.col(mark), words), TEXT, {mark: count_of(marks)})
    reg.register(
        "contraction_rate", share(F.col("clitics") - F.col("possessives"), words)
    )
    reg.register("dialogue_narration_ratio", share(F.col("quoted"), words))
    reg.register("adjective_density", share(F.col("adjectives"), words), SYNTAX)
    reg.register("adverb_density", share(F.col("adverbs"), words), SYNTAX)
    return reg


REPETITION = ("distinct", "hapaxes", "squares")


def _total(of: Column | str, value: Callable[[Column], Column]) -> Column:
    zero = F.lit(0).cast("bigint")
    return F.aggregate(of, zero, lambda acc, t: acc + F.coalesce(value(t), zero))


def unit_sums(rows: DataFrame, reg: Registry, kept: Iterable[str]) -> DataFrame:
    """(work_id, kept..., token sums, repetition) of each unit, from its own row.

    Of a unit's types the few that any sum asks for by name are singled out
    once, by a hash set, so that looking one up is a short search.
    """
    zero = F.lit(0).cast("bigint")
    named = sorted({w for s in reg.token_sums.values() if isinstance(s, tuple) for w in s})

    def number(word: str) -> Column:
        # A word that does not occur has the place before the first, which holds nothing
        return F.coalesce(F.get("_numbers", F.array_position("_names", word).cast("int") - 1), zero)

    def token_sum(spec: TokenSum) -> Column:
        if not isinstance(spec, tuple):
            return _total("types", spec)
        return reduce(lambda a, b: a + b, [number(w) for w in spec], zero)

    found = rows.withColumn("_named", F.filter("types", lambda t: t["token"].isin(*named)))
    found = found.withColumns(
        {
            "_names": F.transform("_named", lambda t: t["token"]),
            "_numbers": F.transform("_named", lambda t: t["n"]),
            "_words": F.filter("types", lambda t: t["alpha"]),
        }
    )
    once = F.filter("_words", lambda t: t["n"] == 1)
    return found.select(
        "work_id",
        *kept,
        *[token_sum(s).alias(name) for name, s in reg.token_sums.items()],
        F.size("_words").cast("bigint").alias("distinct"),
        F.size(once).cast("bigint").alias("hapaxes"),
        _total("_words", lambda t: t["n"] * t["n"]).alias("squares"),
    )


def summed_batches(
    batches: Iterator[pa.RecordBatch], sums: dict[str, tuple[str, ...] | Callable], keep_types: bool
) -> Iterator[pa.RecordBatch]:
    """Described units with what measuring adds up of them, in the task that described them.

    Types leave the task only for works of several units, which merge them, or
    where ``keep_types`` says that somebody else reads them.
    """
    named = sorted({w for s in sums.values() if isinstance(s, tuple) for w in s})
    place = {w: i for i, w in enumerate(named)}
    for batch in batches:
        types, words = batch.column("types"), batch.column("_words")
        sizes = flat.lengths(types)
        ends, in_sentences = flat.bounds(sizes), flat.bounds(flat.lengths(words))
        each = types.flatten()
        token = pc.struct_field(each, "token")
        n = pc.struct_field(each, "n").to_numpy(zero_copy_only=False)
        alpha = pc.struct_field(each, "alpha").to_numpy(zero_copy_only=False)
        which = pc.fill_null(pc.index_in(token, pa.array(named, token.type)), -1)
        which = which.to_numpy(zero_copy_only=False)
        found = np.flatnonzero(which >= 0)
        numbers = np.zeros((batch.num_rows, len(named)), dtype="int64")
        numbers[np.repeat(np.arange(batch.num_rows), sizes)[found], which[found]] = n[found]
        of_sentence = words.flatten().to_numpy(zero_copy_only=False)
        added = [
            np.diff(in_sentences),
            flat.sums(of_sentence, in_sentences),
            flat.sums(of_sentence * of_sentence, in_sentences),
            *(
                numbers[:, [place[w] for w in s]].sum(axis=1)
                if isinstance(s, tuple)
                else flat.sums(s(token, n, alpha), ends)
                for s in sums.values()
            ),
            flat.sums(alpha, ends),
            flat.sums(alpha & (n == 1), ends),
            flat.sums(n * n * alpha, ends),
        ]
        if not keep_types:
            several = batch.column("units").to_numpy(zero_copy_only=False) > 1
            left = each.filter(pa.array(np.repeat(several, sizes)))
            left = flat.lists(left, flat.bounds(np.where(several, sizes, 0)))
            batch = batch.set_column(batch.schema.get_field_index("types"), "types", left)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, *(pa.array(a, pa.int64()) for a in added)],
            names=[*batch.schema.names, *SENTENCE_SUMS, *sums, *REPETITION],
        )


def _flat_and_other_sums(reg: Registry) -> tuple[dict, list[Column]]:
    """Token sums by what a task takes of flat types, and those that only Spark knows how to take."""
    sums = {
        name: s if isinstance(s, tuple) else _FLAT_SUMS[s]
        for name, s in reg.token_sums.items()
        if isinstance(s, tuple) or s in _FLAT_SUMS
    }
    # The others read the types outside the task
    return sums, [_total("types", s).alias(name) for name, s in reg.token_sums.items() if name not in sums]


def summed(
    units: DataFrame, parser: Parser | None = None, registry: Registry | None = None
) -> DataFrame:
    """Units as ``measure_wide`` with that registry and ``described_vocabulary`` read them, a row each.

    ``parser`` turns the Arrow batches of ``units`` into such with the tokens of
    ``PARSED_COLUMNS``; it, the description of the units and their sums share
    a task, so that neither tokens nor the types of short works leave it.  Without one
    the units are parsed already.  Write the result and hand it to ``tokens.summed_view``.
    """
    sums, others = _flat_and_other_sums(registry or builtin_registry())
    keep_types = bool(others)

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summed_batches(described_batches(parser(found) if parser else found), sums, keep_types)

    added = [*SENTENCE_SUMS, *sums, *REPETITION]
    schema = ", ".join([DESCRIBED_COLUMNS, *(f"`{c}` bigint" for c in added)])
    several = F.col("units") > 1
    types = F.when(several, F.col("types")) if keep_types else F.col("types")
    return with_quoted(units.mapInArrow(batches, schema)).select(
        "work_id", "unit_no", "units", types.alias("types"), "terms", *VIEW_SUMS,
        *sums, *others, *REPETITION, F.when(several, letters_carry()).alias("carry"),
    )


def summed_text(
    documents: DataFrame,
    registry: Registry | None = None,
    text_column: str = "text",
    max_chars: int = fixed.MAX_CHUNK_CHARS,
) -> DataFrame:
    """Units of unparsed documents as ``measure_wide`` with that registry and ``word_counts`` read them, a row each.

    A text is tokenised once and its tokens are counted and added up in the task
    that read it.  Write the result and hand it to ``tokens.spelt_view``.
    """
    units = spelt_units(documents, text_column, max_chars)
    sums, others = _flat_and_other_sums(registry or builtin_registry())
    kinds = {f.name: f.dataType.simpleString() for f in units.schema}
    handed = ", ".join(
        f"types {TYPES}" if c == "_tokens" else f"{c} {kinds[c]}" for c in units.columns
    )
    schema = ", ".join([handed, *(f"`{c}` bigint" for c in (*SENTENCE_SUMS, *sums, *REPETITION))])
    added = units.mapInArrow(
        lambda found: summed_batches(typed_batches(found), sums, keep_types=True), schema
    )
    return added.select(
        "work_id", "unit_no", "units", "types", *SPELT_SUMS, *sums, *others, *REPETITION, "carry"
    )


def _merged_repetition(long_rows: DataFrame) -> DataFrame:
    """Distinct words, hapaxes and squared counts of works that span several units."""
    alpha, n = F.col("alpha"), F.col("n")
    return (
        merged_counts(long_rows)
        .groupBy("work_id")
        .agg(
            F.count_if(alpha).alias("_distinct"),
            F.count_if(alpha & (n == 1)).alias("_hapaxes"),
            F.coalesce(F.sum(F.when(alpha, n * n)), F.lit(0)).alias("_squares"),
        )
    )


def work_sums(view: View, reg: Registry) -> DataFrame:
    """Every sum a series may read, one row per work."""
    if view.summed:
        units = view.rows.select("work_id", *view.sums, *reg.token_sums, *REPETITION)
    else:
        units = unit_sums(view.rows, reg, view.sums)
    added = [c for c in units.columns if c != "work_id"]
    per_work = units.groupBy("work_id").agg(*[F.sum(c).alias(c) for c in added])
    cuts = carried(view.long_rows)
    crossing = [c for c in cuts.columns if c != "work_id"]
    joined = per_work.join(_merged_repetition(view.long_rows), "work_id", "left").join(
        cuts.withColumnsRenamed({c: f"_{c}" for c in crossing}), "work_id", "left"
    )
    joined = joined.withColumns({c: F.coalesce(f"_{c}", c) for c in REPETITION}).withColumns(
        {c: F.col(c) + F.coalesce(f"_{c}", F.lit(0)) for c in crossing}
    )
    if not view.parsed:
        # Without a parse no possessive is known and every 's counts
        joined = joined.withColumn("possessives", F.lit(0).cast("bigint"))
    return joined.drop(*[f"_{c}" for c in (*REPETITION, *crossing)])


def measure_wide(view: View, registry: Registry | None = None) -> DataFrame:
    """One row per work, one double column per series.

    A view without a parse yields the series that need only text.
    """
    reg = registry or builtin_registry()
    usable = {TEXT, SYNTAX} if view.parsed else {TEXT}
    return work_sums(view, reg).select(
        "work_id", *[s.value.alias(s.name) for s in reg.series if s.needs in usable]
    )


def to_long(wide: DataFrame, loaded_at: Column, *of_work: str) -> DataFrame:
    """(work_id, metric, value, loaded_at), one row per work and series.

    ``of_work`` names columns of ``wide`` that ``loaded_at`` reads.
    """
    names = [c for c in wide.columns if c not in ("work_id", *of_work)]
    long = wide.unpivot(["work_id", *of_work], names, "metric", "value")
    return long.withColumn("loaded_at", loaded_at).select("work_id", "metric", "value", "loaded_at")
