"""The given tables in the shape of the library's inputs.

``PORTABLE`` holds plain SELECTs that Spark SQL and DuckDB both run, so the
two sides of a check start from the same rows.  Everything after them is
computed independently: by the library on one side, by SQL on the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from inkmeter import fixed_values as fixed
from inkmeter.functions.prose import PARAGRAPH, split_paragraphs
from inkmeter.functions.strings import matches_all
from inkmeter.operators import flat, metrics, scope
from inkmeter.operators.tokens import (
    DESCRIBED_COLUMNS,
    PARSED_COLUMNS,
    TOKEN,
    described_batches,
    sentence_strings,
    space_clitics,
    summed_view,
    text_units,
)
from inkmeter.plans.warehouse import Warehouse, build
from inkmeter.session import apply_settings
from inkmeter.sources.catalog import stamp
from inkmeter.sources.lookups import metric_concepts
from inkmeter.sources.tables import stage_table

RUN_TS = "2024-02-01 00:00:00"

NL = "chr(10)"


def _replaced(column: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        column = f"replace({column}, {old}, {new})"
    return column


# The test texts hold almost no quotes, clitics or rare marks: write some in
PROSE = _replaced(
    "text",
    [
        (NL, f"concat({NL}, {NL})"),
        ("', '", "', \"'"),
        ("'. '", "'.\" '"),
        ("' the '", "' they''ll '"),
        ("' is '", "' isn''t '"),
        ("' and '", "' dog''s '"),
        ("' der '", "' der’s '"),
        ("' la '", "' upon '"),
        ("'! '", "'... '"),
        ("' of '", "' -- of '"),
        ("' en '", "' (en) '"),
        ("' de '", "'; de '"),
        ("' in '", "' in: '"),
        ("' die '", "'? die '"),
    ],
)

WORK_ID = (
    "CASE source WHEN 'src0' THEN concat('own-', CAST(doc_id AS STRING)) "
    "WHEN 'src1' THEN concat('guest-', CAST(doc_id AS STRING)) ELSE CAST(doc_id AS STRING) END"
)
LOADED_AT = (
    "CAST(concat('2024-01-', lpad(CAST(1 + doc_id % 28 AS STRING), 2, '0'), ' 06:00:00') "
    "AS TIMESTAMP)"
)

PORTABLE = {
    "corpus": f"""
        SELECT {WORK_ID} AS work_id, doc_id, source, lang, n_chars,
               CASE WHEN source IN ('src0', 'src1') THEN 1 ELSE 0 END AS is_self,
               {PROSE} AS text, {LOADED_AT} AS loaded_at
        FROM documents""",
    "manual_works": f"""
        SELECT {WORK_ID} AS work_id, substr(text, 1, 24) AS title,
               CASE source WHEN 'src0' THEN 'Own, Hand' ELSE 'Guest, Other' END AS author,
               CASE source WHEN 'src0' THEN 1 ELSE 0 END AS is_self,
               {LOADED_AT} AS loaded_at
        FROM documents WHERE source IN ('src0', 'src1')""",
    "feed": """
        SELECT doc_id AS catalog_id,
               CASE WHEN n_chars < 40 THEN 'Sound' ELSE 'Text' END AS type,
               CASE WHEN n_chars % 9 = 0 THEN '' ELSE concat(
                   '19', CAST(70 + n_chars % 30 AS STRING), '-0', CAST(1 + n_chars % 9 AS STRING),
                   '-1', CAST(n_chars % 10 AS STRING)) END AS issued,
               CASE n_chars % 4 WHEN 0 THEN concat(' ', substr(text, 1, 24), ' ')
                                WHEN 1 THEN concat(substr(text, 1, 24), ': Being a Tale; 2nd')
                                ELSE substr(text, 1, 24) END AS title,
               lang AS language,
               CASE n_chars % 10
                   WHEN 0 THEN ''
                   WHEN 1 THEN 'Mill, Jane'
                   WHEN 2 THEN 'Vane, Jules, 1828-1905'
                   WHEN 3 THEN 'Vane, Jules, 1828-1905; Roth, Édouard, 1830?-1899? [Translator]'
                   WHEN 4 THEN 'Pole, Edgar A. (Edgar Allan), 1809-1849 [Editor]'
                   WHEN 5 THEN 'Anonymous'
                   WHEN 6 THEN 'Ovis, 843-917?'
                   WHEN 7 THEN concat('Author', CAST(n_chars % 37 AS STRING), ', First, 18',
                                      CAST(10 + n_chars % 60 AS STRING), '-1902')
                   WHEN 8 THEN 'Smythe, Clark A., 1893-1961; Jonas, B., 19th cent.'
                   ELSE '  Spaced , Name ; Other' END AS authors,
               CASE n_chars % 12
                   WHEN 0 THEN 'Science fiction; Space flight -- Fiction'
                   WHEN 1 THEN 'Fantasy fiction; Dragons -- Fiction'
                   WHEN 2 THEN 'Horror tales; Ghosts -- Fiction'
                   WHEN 3 THEN 'Science fiction -- History and criticism'
                   WHEN 4 THEN 'Science fiction -- Fiction -- History and criticism; Magic'
                   WHEN 5 THEN 'Fairy tales; Juvenile fiction'
                   WHEN 6 THEN 'Utopias -- Fiction; Fantasy fiction'
                   WHEN 7 THEN 'Love stories'
                   WHEN 8 THEN 'Gothic fiction; Drama'
                   WHEN 9 THEN 'Vampires -- Juvenile fiction; Poetry'
                   WHEN 10 THEN CAST(NULL AS STRING)
                   ELSE 'Short stories -- Translations into English; Robots' END AS subjects,
               CASE n_chars % 5 WHEN 0 THEN 'PS' WHEN 1 THEN 'PR; PZ' WHEN 2 THEN 'PT'
                   WHEN 3 THEN 'XPA; PQ' ELSE CAST(NULL AS STRING) END AS locc,
               CASE n_chars % 7
                   WHEN 0 THEN 'Science Fiction'
                   WHEN 1 THEN 'Category: Science-Fiction & Fantasy; Plays/Films/Dramas'
                   WHEN 2 THEN ''
                   WHEN 3 THEN 'Gothic Fiction; Best Books'
                   WHEN 4 THEN 'Fantasy'
                   WHEN 5 THEN 'Science Fiction by Women; Other'
                   ELSE CAST(NULL AS STRING) END AS bookshelves
        FROM documents WHERE source NOT IN ('src0', 'src1')""",
    # Works with a label were seen before; the label says what became of them
    "ledger": """
        SELECT c.catalog_id,
               CASE WHEN l.quality = 0 THEN 'outdated' ELSE c.catalog_row_hash END AS catalog_row_hash,
               CASE WHEN l.toxic = 1 THEN CAST(NULL AS STRING) ELSE 'seen' END AS text_hash,
               CAST('2023-11-01 00:00:00' AS TIMESTAMP) AS first_seen,
               CASE WHEN l.quality = 0 THEN CAST('2024-01-20 00:00:00' AS TIMESTAMP)
                    ELSE CAST('2023-12-01 00:00:00' AS TIMESTAMP) END AS last_changed,
               CASE WHEN l.toxic = 1 THEN 'failed' ELSE 'ingested' END AS status
        FROM catalog c JOIN labels l ON l.doc_id = c.catalog_id""",
}

# How the tokens of a unit are joined
TOKEN_BREAK, SENTENCE_BREAK = " ", "\t"
TOKEN_FIELDS = ("text", "stop", "lemma", "pos", "tag", "dep", "head")
PLAIN_TYPES = {"stop": pa.bool_(), "head": pa.int32()}

FEED_COLUMNS = (
    "type", "issued", "title", "language", "authors", "subjects", "locc", "bookshelves",
)


# --- Spark side ----------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def portable(spark: SparkSession, sf_dir: str, name: str, **more: DataFrame) -> DataFrame:
    """Run a portable SELECT over the given tables (and derived ones)."""
    view = {"documents": documents(spark, sf_dir), **more}
    query = PORTABLE[name]
    used = {}
    for key, df in view.items():
        marked = query.replace(f"FROM {key}", f"FROM {{{key}}}").replace(
            f"JOIN {key}", f"JOIN {{{key}}}"
        )
        if marked != query:
            used[key] = df
            query = marked
    return spark.sql(query, **used)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(spark, sf_dir, "corpus")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stamp(portable(spark, sf_dir, "feed"), RUN_TS)


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(
        spark,
        sf_dir,
        "ledger",
        catalog=catalog(spark, sf_dir),
        labels=table(spark, sf_dir, "labels"),
    )


def manual_works(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(spark, sf_dir, "manual_works")


def roster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scope.roster(catalog(spark, sf_dir))


def annotated_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Annotations by spelling, worked out once a distinct token, and by place.

    The strings of tokens keep their dictionaries, for whoever reads on in the task.
    """
    for batch in batches:
        joined = batch.column("sents")
        split = pc.split_pattern(pc.replace_with_mask(
            joined, pc.equal(joined, ""), pa.scalar(None, pa.string())
        ), SENTENCE_BREAK)
        in_sents = pc.split_pattern(split.flatten(), TOKEN_BREAK)
        nested = flat.lists(in_sents, flat.bounds(flat.lengths(split)))
        yield from _annotated(batch.set_column(batch.schema.get_field_index("sents"), "sents", nested))


def _annotated(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for piece in flat.pieces(iter([batch]), "sents"):
        in_units = piece.column("sents").flatten()
        texts = in_units.flatten()
        ends = flat.bounds(flat.lengths(in_units))
        place = np.arange(len(texts)) - np.repeat(ends[:-1], np.diff(ends))
        spelt = flat.Spellings(texts)
        codes = pa.array(spelt.codes)
        low = flat.lowered(spelt.dictionary, str.lower)

        def ends_with(*endings: str, low=low) -> pa.Array:  # noqa: ANN001
            return reduce(pc.or_, [pc.ends_with(low, e) for e in endings])

        def is_any(*words: str, low=low) -> pa.Array:  # noqa: ANN001
            return pc.is_in(low, pa.array(words))

        def cut(n: int, low=low) -> pa.Array:  # noqa: ANN001
            return pc.utf8_slice_codeunits(low, 0, -n)

        def first_of(*cases: tuple, otherwise: object) -> pa.Array:
            return pc.case_when(
                pc.make_struct(*[c for c, _ in cases]), *[v for _, v in cases], otherwise
            )

        def of_tokens(values: pa.Array, codes=codes) -> np.ndarray:  # noqa: ANN001
            return values.take(codes).to_numpy(zero_copy_only=False)

        def strings(values: pa.Array, codes=codes) -> pa.Array:  # noqa: ANN001
            return pa.DictionaryArray.from_arrays(codes, values)

        lemma = first_of(
            (ends_with("ed"), cut(2)), (ends_with("ing"), cut(3)), (ends_with("s"), cut(1)),
            otherwise=low,
        )
        pos = first_of(
            (pa.array(~flat.words(spelt.dictionary)), "PUNCT"),
            (ends_with("ly"), "ADV"),
            (ends_with("st", "eux"), "ADJ"),
            (ends_with("ed", "er"), "VERB"),
            (is_any("is", "was", "be", "ist", "est"), "AUX"),
            otherwise="NOUN",
        )
        dep = first_of(
            (ends_with("ore"), "advcl"), (ends_with("elle"), "ccomp"), (ends_with("er"), "conj"),
            otherwise="dep",
        )
        possessive = of_tokens(is_any("'s", "’s")) & (place % 2 == 0)
        head = np.where(of_tokens(ends_with("e")), place // 2, (place - 1) // 3)
        tokens = pa.StructArray.from_arrays(
            [
                strings(spelt.dictionary),
                is_any(*fixed.FUNCTION_WORDS).take(codes),
                strings(lemma),
                strings(pos),
                strings(pa.array(["X", "POS"]), pa.array(possessive.astype("int32"))),
                strings(
                    pa.concat_arrays([dep, pa.array(["ROOT"])]),
                    pa.array(np.where(place == 0, len(dep), spelt.codes), pa.int32()),
                ),
                pa.array(np.where(place == 0, 0, head), pa.int32()),
            ],
            list(TOKEN_FIELDS),
        )
        sents = flat.lists(
            flat.lists(tokens, ends), flat.bounds(flat.lengths(piece.column("sents")))
        )
        yield piece.set_column(piece.schema.get_field_index("sents"), "sents", sents)


def rule_tokens(units: DataFrame) -> DataFrame:
    """Units with the tokens of their sentences, as ``annotated_batches`` reads them.

    No token holds a blank or a tab and no sentence is without a token, so that
    a unit's tokens are handed over as one string.
    """

    def sentences(paragraph: Column, i: Column) -> Column:
        # The leading line end is the token that closes an open quotation
        goes_on = (i == 0) & (F.col("entry") != PARAGRAPH)
        return F.transform(
            sentence_strings(F.concat(F.when(goes_on, "").otherwise("\n"), paragraph)),
            lambda s: F.array_join(matches_all(s, TOKEN), TOKEN_BREAK),
        )

    tokens = F.array_join(
        F.flatten(F.transform(split_paragraphs(space_clitics(F.col("text"))), sentences)),
        SENTENCE_BREAK,
    )
    return units.select("work_id", "unit_no", "units", "entry", "text", tokens.alias("sents"))


def rule_parse(units: DataFrame) -> DataFrame:
    """Stand-in for a parser: annotations by spelling and position."""

    def plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.list_(pa.list_(pa.struct([(n, PLAIN_TYPES.get(n, pa.string())) for n in TOKEN_FIELDS])))
        for piece in annotated_batches(batches):
            at = piece.schema.get_field_index("sents")
            yield piece.set_column(at, "sents", piece.column("sents").cast(schema))

    return rule_tokens(units).mapInArrow(plain, PARSED_COLUMNS)


def rule_described(units: DataFrame) -> DataFrame:
    """The same parse, described where it is made: its tokens do not leave the task."""
    return rule_tokens(units).mapInArrow(
        lambda batches: described_batches(annotated_batches(batches)), DESCRIBED_COLUMNS
    )


@cache
def _run_folder(application_id: str, root: str) -> str:
    """One folder per run on storage all executors share."""
    return f"{root.rstrip('/')}/inkmeter/{application_id}-{uuid.uuid4().hex[:8]}"


def run_folder(spark: SparkSession) -> str:
    return _run_folder(
        spark.sparkContext.applicationId,
        spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir"),
    )


_staged: dict[tuple[str, str, str], object] = {}


def staged(spark: SparkSession, sf_dir: str, name: str, make):  # noqa: ANN001, ANN201
    """A table several checks read: written once per run, then read back."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _staged:
        folder = f"{run_folder(spark)}/{sf_dir.strip('/').replace('/', '-')}/{name}"
        _staged[key] = stage_table(make(), folder)
    return _staged[key]


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly: a file of one row group is read by one task."""
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(tasks, 2 * spark.sparkContext.defaultParallelism))


def spread_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus for work that is heavy on every text: dealt before it is derived."""
    return portable(spark, sf_dir, "corpus", documents=spread(documents(spark, sf_dir)))


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(
        spark, sf_dir, "parsed", lambda: rule_parse(text_units(spread_corpus(spark, sf_dir)))
    )


def rule_summed(units: DataFrame) -> DataFrame:
    """The same parse, described and added up where it is made."""
    return metrics.summed(rule_tokens(units).drop("text"), annotated_batches)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terms of the same parse, counted where it is made; what is written are a unit's terms."""
    units = rule_tokens(text_units(spread_corpus(spark, sf_dir))).drop("text")
    return metrics.vocabulary(
        units, annotated_batches, lambda terms: staged(spark, sf_dir, "terms", lambda: terms)
    )


def summed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staged(
        spark, sf_dir, "summed", lambda: rule_summed(text_units(spread_corpus(spark, sf_dir)))
    )


def raw_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        loaded = corpus(spark, sf_dir).select("work_id", "loaded_at")
        wide = metrics.measure_wide(summed_view(summed(spark, sf_dir)))
        # Joined while a work is one row, not one a series
        return metrics.to_long(wide.join(loaded, "work_id"), F.col("loaded_at"), "loaded_at")

    return staged(spark, sf_dir, "raw_measurements", make)


def raw_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    def make() -> DataFrame:
        loaded = corpus(spark, sf_dir).select("work_id", "loaded_at")
        return metrics.described_vocabulary(summed(spark, sf_dir), loaded)

    return staged(spark, sf_dir, "raw_vocab", make)


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    key = (spark.sparkContext.applicationId, sf_dir, "warehouse")
    if key not in _staged:
        folder = f"{run_folder(spark)}/{sf_dir.strip('/').replace('/', '-')}/marts"
        _staged[key] = build(
            roster(spark, sf_dir),
            manual_works(spark, sf_dir),
            raw_measurements(spark, sf_dir),
            raw_vocab(spark, sf_dir),
            metric_concepts(spark),
            folder,
        )
    return _staged[key]  # type: ignore[return-value]


# --- Shaping results for comparison ---------------------------------------------


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles to comparable digits."""
    return df.withColumns(
        {c: F.round(F.col(c).cast("double"), digits) for c in columns}
    )


def as_text(df: DataFrame, *columns: str) -> DataFrame:
    """Dates and timestamps as text, which both engines spell alike."""
    return df.withColumns({c: F.col(c).cast("string") for c in columns})
